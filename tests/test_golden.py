"""Golden values on the six sample tables (worked out by hand from the sample rows)."""

import os

import pytest

from assay.operators import expectations as X
from assay.operators.checks import verify
from assay.operators.profile import profile
from assay.plans.flows import generate_and_validate
from assay.plans.registry import checks_for, suite_for, suite_name_of
from assay.sources.tables import read_table

TABLES = ["employees", "salaries", "titles", "departments", "dept_emp", "dept_manager"]

# table -> (metrics, check constraints, static expectations, generated expectations, row-count range)
COUNTS = {
    "employees": (27, 6, 7, 14, (9, 11)),
    "salaries": (18, 4, 4, 8, (9, 11)),
    "titles": (17, 3, 3, 8, (9, 11)),
    "departments": (12, 5, 5, 8, (8, 9)),
    "dept_emp": (17, 3, 3, 8, (9, 11)),
    "dept_manager": (17, 4, 4, 8, (8, 9)),
}

# (table, column) -> distinctness, and numeric (min, max, mean, std) or string (minlen, maxlen, uniqueness)
PROFILE = {
    ("employees", "emp_no"): (1.0, (10001, 10010, 10005.5, 2.8722813233)),
    ("employees", "birth_date"): (1.0, None),
    ("employees", "hire_date"): (1.0, None),
    ("employees", "first_name"): (1.0, (5, 9, 1.0)),
    ("employees", "last_name"): (1.0, (4, 9, 1.0)),
    ("employees", "gender"): (0.2, (1, 1, 0.0)),
    ("salaries", "emp_no"): (0.5, (10001, 10005, 10002.6, 1.3564659966)),
    ("salaries", "salary"): (1.0, (40006, 78228, 56421.7, 13016.7415511717)),
    ("salaries", "from_date"): (1.0, None),
    ("salaries", "to_date"): (1.0, None),
    ("titles", "emp_no"): (0.7, (10001, 10007, 10004.4, 1.9078784028)),
    ("titles", "title"): (0.4, (5, 15, 0.1)),
    ("titles", "from_date"): (1.0, None),
    ("titles", "to_date"): (0.4, None),
    ("departments", "dept_no"): (1.0, (4, 4, 1.0)),
    ("departments", "dept_name"): (1.0, (5, 18, 1.0)),
    ("dept_emp", "emp_no"): (1.0, (10001, 10010, 10005.5, 2.8722813233)),
    ("dept_emp", "dept_no"): (0.6, (4, 4, 0.4)),
    ("dept_emp", "from_date"): (1.0, None),
    ("dept_emp", "to_date"): (0.1, None),
    ("dept_manager", "emp_no"): (1.0, (110022, 110386, 110189.3333333333, 126.5859391876)),
    ("dept_manager", "dept_no"): (0.4444444444, (4, 4, 0.0)),
    ("dept_manager", "from_date"): (0.6666666667, None),
    ("dept_manager", "to_date"): (0.7777777778, None),
}


def load(spark, samples_dir, name):
    return read_table(spark, os.path.join(samples_dir, f"{name}.csv"))


@pytest.fixture(scope="module")
def metrics(spark, samples_dir):
    out = {}
    for t in TABLES:
        rows = profile(load(spark, samples_dir, t), t).collect()
        out[t] = rows
    return out


def test_inferred_types(spark, samples_dir):
    df = load(spark, samples_dir, "employees")
    assert df.columns == ["emp_no", "birth_date", "first_name", "last_name", "gender", "hire_date"]
    assert dict(df.dtypes) == {
        "emp_no": "int",
        "birth_date": "date",
        "first_name": "string",
        "last_name": "string",
        "gender": "string",
        "hire_date": "date",
    }


@pytest.mark.parametrize("table", TABLES)
def test_metric_counts(metrics, table):
    assert len(metrics[table]) == COUNTS[table][0]
    assert all(r.status == "Success" for r in metrics[table])


@pytest.mark.parametrize("key", sorted(PROFILE))
def test_profile_values(metrics, key):
    table, column = key
    m = {(r.metric, r.instance): r.value for r in metrics[table]}
    distinct, extra = PROFILE[key]
    assert m[("Completeness", column)] == 1.0
    assert m[("Distinctness", column)] == pytest.approx(distinct, abs=1e-9)
    if extra is None:
        assert ("Minimum", column) not in m and ("MinLength", column) not in m
    elif len(extra) == 4:
        lo, hi, mean, std = extra
        assert m[("Minimum", column)] == lo
        assert m[("Maximum", column)] == hi
        assert m[("Mean", column)] == pytest.approx(mean, abs=1e-9)
        assert m[("StandardDeviation", column)] == pytest.approx(std, abs=1e-9)
        assert ("Uniqueness", column) not in m
    else:
        lo, hi, uniq = extra
        assert m[("MinLength", column)] == lo
        assert m[("MaxLength", column)] == hi
        assert m[("Uniqueness", column)] == pytest.approx(uniq, abs=1e-9)


@pytest.mark.parametrize("table", TABLES)
def test_table_metrics(metrics, table):
    m = {(r.metric, r.instance): r for r in metrics[table]}
    assert m[("Size", "*")].value == (9.0 if table in ("departments", "dept_manager") else 10.0)
    assert m[("Size", "*")].analyzer == "Size()"
    assert m[("Completeness", "*")].value == 1.0
    assert m[("Completeness", "*")].analyzer == "Completeness(*)"


@pytest.mark.parametrize("table", TABLES)
def test_checks_pass(spark, samples_dir, table):
    v = verify(load(spark, samples_dir, table), checks_for(table), table)
    rows = v.constraints.collect()
    assert len(rows) == COUNTS[table][1]
    assert all(r.status == "Success" and r.message == "" for r in rows)
    assert [r.check_name for r in v.checks.collect()] == [f"{table}_checks"]
    assert v.status.collect()[0].overall_status == "Success"


@pytest.mark.parametrize("table", TABLES)
def test_static_suite_passes(spark, samples_dir, table):
    res = X.validate(load(spark, samples_dir, table), suite_for(table), table, suite_name_of(table)).collect()
    assert len(res) == COUNTS[table][2]
    assert all(r.success for r in res)
    assert all(r.partial_unexpected_list == [] for r in res)


@pytest.mark.parametrize("table", TABLES)
def test_generated_suite(spark, samples_dir, table):
    df = load(spark, samples_dir, table)
    rules, results = generate_and_validate(df, table)
    rules = sorted(rules.collect(), key=lambda r: r.seq)
    assert len(rules) == COUNTS[table][3]
    rc = [r for r in rules if r.expectation_type == X.TABLE_ROWS]
    assert [(int(rc[0].min_value), int(rc[0].max_value))] == [COUNTS[table][4]]
    assert rules[-1].expectation_type == X.TABLE_COLUMNS and rules[-1].column_list == df.columns
    res = results.collect()
    assert len(res) == COUNTS[table][3]
    assert all(r.success for r in res)


def test_employees_generated_order(spark, samples_dir):
    df = load(spark, samples_dir, "employees")
    rules, _ = generate_and_validate(df, "employees")
    got = [(r.expectation_type, r.column) for r in sorted(rules.collect(), key=lambda r: r.seq)]
    assert got == [
        (X.TABLE_ROWS, None),
        (X.NOT_NULL, "emp_no"),
        (X.NOT_NULL, "birth_date"),
        (X.NOT_NULL, "first_name"),
        (X.LENGTHS, "first_name"),
        (X.UNIQUE, "first_name"),
        (X.NOT_NULL, "last_name"),
        (X.LENGTHS, "last_name"),
        (X.UNIQUE, "last_name"),
        (X.NOT_NULL, "gender"),
        (X.LENGTHS, "gender"),
        (X.NOT_NULL, "hire_date"),
        (X.BETWEEN, "emp_no"),
        (X.TABLE_COLUMNS, None),
    ]
