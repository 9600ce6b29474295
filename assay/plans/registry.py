"""Rule registries: which checks and which expectation suite apply to a table name.

The built-in entries are the employee-database rule set (six tables). Users
extend or replace them by passing their own mappings to the flows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from assay.operators import expectations as X
from assay.operators.checks import Check

# --- fixed values: the built-in rule set (table -> checks / expectations) ---------
# Every check is at level Error and starts with "size > 0".
EMPLOYEES_COLUMNS = ["emp_no", "birth_date", "first_name", "last_name", "gender", "hire_date"]
SALARIES_COLUMNS = ["emp_no", "salary", "from_date", "to_date"]
TITLES_COLUMNS = ["emp_no", "title", "from_date", "to_date"]
DEPARTMENTS_COLUMNS = ["dept_no", "dept_name"]
DEPT_EMP_COLUMNS = ["emp_no", "dept_no", "from_date", "to_date"]
DEPT_MANAGER_COLUMNS = ["emp_no", "dept_no", "from_date", "to_date"]
GENDERS = ["M", "F"]
EMP_NO_RANGE = (10001, 999999)
SALARY_RANGE = (30000, 200000)

STATIC_CHECKS: dict[str, list[Check]] = {
    "employees": [
        Check("employees_checks")
        .has_size()
        .is_complete("emp_no")
        .is_unique("emp_no")
        .is_complete("first_name")
        .is_complete("last_name")
        .is_contained_in("gender", GENDERS)
    ],
    "salaries": [
        Check("salaries_checks")
        .has_size()
        .is_complete("emp_no")
        .is_complete("salary")
        .satisfies("salary > 0", "Salary should be positive")
    ],
    "titles": [Check("titles_checks").has_size().is_complete("emp_no").is_complete("title")],
    "departments": [
        Check("departments_checks")
        .has_size()
        .is_complete("dept_no")
        .is_unique("dept_no")
        .is_complete("dept_name")
        .is_unique("dept_name")
    ],
    "dept_emp": [Check("dept_emp_checks").has_size().is_complete("emp_no").is_complete("dept_no")],
    "dept_manager": [
        Check("dept_manager_checks").has_size().is_complete("emp_no").is_unique("emp_no").is_complete("dept_no")
    ],
}
DEFAULT_CHECKS: list[Check] = [Check("default_checks").has_size()]

STATIC_SUITES: dict[str, list[X.Expectation]] = {
    "employees": [
        X.expect_table_columns_to_match_ordered_list(EMPLOYEES_COLUMNS),
        X.expect_column_values_to_be_unique("emp_no"),
        X.expect_column_values_to_not_be_null("emp_no"),
        X.expect_column_values_to_not_be_null("first_name"),
        X.expect_column_values_to_not_be_null("last_name"),
        X.expect_column_values_to_be_in_set("gender", GENDERS),
        X.expect_column_values_to_be_between("emp_no", *EMP_NO_RANGE),
    ],
    "salaries": [
        X.expect_table_columns_to_match_ordered_list(SALARIES_COLUMNS),
        X.expect_column_values_to_not_be_null("emp_no"),
        X.expect_column_values_to_not_be_null("salary"),
        X.expect_column_values_to_be_between("salary", *SALARY_RANGE),
    ],
    "titles": [
        X.expect_table_columns_to_match_ordered_list(TITLES_COLUMNS),
        X.expect_column_values_to_not_be_null("emp_no"),
        X.expect_column_values_to_not_be_null("title"),
    ],
    "departments": [
        X.expect_table_columns_to_match_ordered_list(DEPARTMENTS_COLUMNS),
        X.expect_column_values_to_be_unique("dept_no"),
        X.expect_column_values_to_be_unique("dept_name"),
        X.expect_column_values_to_not_be_null("dept_no"),
        X.expect_column_values_to_not_be_null("dept_name"),
    ],
    "dept_emp": [
        X.expect_table_columns_to_match_ordered_list(DEPT_EMP_COLUMNS),
        X.expect_column_values_to_not_be_null("emp_no"),
        X.expect_column_values_to_not_be_null("dept_no"),
    ],
    "dept_manager": [
        X.expect_table_columns_to_match_ordered_list(DEPT_MANAGER_COLUMNS),
        X.expect_column_values_to_not_be_null("emp_no"),
        X.expect_column_values_to_not_be_null("dept_no"),
        X.expect_column_values_to_be_unique("emp_no"),
    ],
}
# --- end of fixed values ------------------------------------------------------------


def checks_for(table_name: str, registry: Mapping[str, Sequence[Check]] = STATIC_CHECKS) -> list[Check]:
    """Checks of a table; unknown tables get the default (row count > 0)."""
    return list(registry.get(table_name, DEFAULT_CHECKS))


def suite_for(
    table_name: str, registry: Mapping[str, Sequence[X.Expectation]] = STATIC_SUITES
) -> list[X.Expectation] | None:
    """Expectation suite of a table, or ``None`` (the table is skipped) when unknown."""
    suite = registry.get(table_name)
    return list(suite) if suite is not None else None


def suite_name_of(table_name: str) -> str:
    return f"{table_name}_suite"
