"""The six sample tables of the employee database, as CSV text.

Fixed values: the sample rows exactly as shipped (UTF-8 with a byte-order
mark, CRLF line ends, header row). ``write_samples`` writes them to a folder.
"""

from __future__ import annotations

import os

SAMPLES = {
    "employees": """emp_no,birth_date,first_name,last_name,gender,hire_date
10001,1953-09-02,Georgi,Facello,M,1986-06-26
10002,1964-06-02,Bezalel,Simmel,F,1985-11-21
10003,1959-12-03,Parto,Bamford,M,1986-08-28
10004,1954-05-01,Chirstian,Koblick,M,1986-12-01
10005,1955-01-21,Kyoichi,Maliniak,M,1989-09-12
10006,1953-04-20,Anneke,Preusig,F,1989-06-02
10007,1957-05-23,Tzvetan,Zielinski,F,1989-02-10
10008,1958-02-19,Saniya,Kalloufi,M,1994-09-15
10009,1952-04-19,Sumant,Peac,F,1985-02-18
10010,1963-06-01,Duangkaew,Piveteau,F,1989-08-24
""",
    "salaries": """emp_no,salary,from_date,to_date
10001,60117,1986-06-26,1987-06-26
10001,62102,1987-06-26,1988-06-25
10001,66074,1988-06-25,1989-06-25
10002,65828,1985-11-21,1986-11-21
10002,65909,1986-11-21,1987-11-20
10003,40006,1986-08-28,1987-08-28
10003,43616,1987-08-28,1988-08-27
10004,40054,1986-12-01,1987-11-30
10004,42283,1987-11-30,1988-11-29
10005,78228,1989-09-12,1990-09-12
""",
    "titles": """emp_no,title,from_date,to_date
10001,Senior Engineer,1986-06-26,9999-01-01
10002,Staff,1985-11-21,9999-01-01
10003,Senior Engineer,1986-08-28,9999-01-01
10004,Engineer,1986-12-01,1995-12-01
10004,Senior Engineer,1995-12-01,9999-01-01
10005,Senior Staff,1989-09-12,1996-09-12
10005,Staff,1996-09-12,9999-01-01
10006,Senior Engineer,1989-06-02,9999-01-01
10007,Senior Staff,1989-02-10,1996-02-11
10007,Staff,1996-02-11,9999-01-01
""",
    "departments": """dept_no,dept_name
d001,Marketing
d002,Finance
d003,Human Resources
d004,Production
d005,Development
d006,Quality Management
d007,Sales
d008,Research
d009,Customer Service
""",
    "dept_emp": """emp_no,dept_no,from_date,to_date
10001,d005,1986-06-26,9999-01-01
10002,d007,1985-11-21,9999-01-01
10003,d004,1986-08-28,9999-01-01
10004,d004,1986-12-01,9999-01-01
10005,d003,1989-09-12,9999-01-01
10006,d005,1989-06-02,9999-01-01
10007,d008,1989-02-10,9999-01-01
10008,d005,1994-09-15,9999-01-01
10009,d006,1985-02-18,9999-01-01
10010,d004,1989-08-24,9999-01-01
""",
    "dept_manager": """emp_no,dept_no,from_date,to_date
110022,d001,1985-01-01,1991-10-01
110039,d001,1991-10-01,9999-01-01
110085,d002,1985-01-01,1989-12-17
110114,d002,1989-12-17,9999-01-01
110183,d003,1985-01-01,1992-03-21
110228,d003,1992-03-21,9999-01-01
110303,d004,1985-01-01,1988-09-09
110344,d004,1988-09-09,1992-08-02
110386,d004,1992-08-02,1996-08-30
""",
}


def write_csv(directory: str, name: str, text: str) -> str:
    """Write ``text`` as ``<name>.csv`` with a byte-order mark and CRLF line ends."""
    path = os.path.join(directory, f"{name}.csv")
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        f.write(text.replace("\n", "\r\n"))
    return path


def write_samples(directory: str, names=None) -> str:
    os.makedirs(directory, exist_ok=True)
    for name in names or SAMPLES:
        write_csv(directory, name, SAMPLES[name])
    return directory


def mutate(name: str, old: str, new: str) -> str:
    """The sample text of ``name`` with the first ``old`` replaced by ``new``."""
    text = SAMPLES[name]
    assert old in text, old
    return text.replace(old, new, 1)
