"""assay - data-quality profiling, checks and expectations on Spark DataFrames.

All data work is expressed with built-in DataFrame operations; only metric
and rule rows (a few per column) ever reach the driver.
"""

from assay.operators.analyzers import (
    Completeness,
    Compliance,
    CountDistinct,
    Distinctness,
    Maximum,
    MaxLength,
    Mean,
    Minimum,
    MinLength,
    Size,
    StandardDeviation,
    Uniqueness,
    run_analyzers,
)
from assay.operators.checks import Check, evaluate_checks, verify
from assay.operators.compare import rule_agreement, threshold_monitor
from assay.operators.expectations import (
    Expectation,
    expect_column_value_lengths_to_be_between,
    expect_column_values_to_be_between,
    expect_column_values_to_be_in_set,
    expect_column_values_to_be_unique,
    expect_column_values_to_not_be_null,
    expect_table_columns_to_match_ordered_list,
    expect_table_row_count_to_be_between,
    suite_outcome,
    validate,
)
from assay.operators.generate import generate_rules, rules_to_expectations
from assay.operators.profile import profile, profile_analyzers
from assay.plans.parallel import compute_metrics, profile_tables

__all__ = [
    "Check",
    "Completeness",
    "Compliance",
    "CountDistinct",
    "Distinctness",
    "Expectation",
    "Maximum",
    "MaxLength",
    "Mean",
    "Minimum",
    "MinLength",
    "Size",
    "StandardDeviation",
    "Uniqueness",
    "compute_metrics",
    "evaluate_checks",
    "expect_column_value_lengths_to_be_between",
    "expect_column_values_to_be_between",
    "expect_column_values_to_be_in_set",
    "expect_column_values_to_be_unique",
    "expect_column_values_to_not_be_null",
    "expect_table_columns_to_match_ordered_list",
    "expect_table_row_count_to_be_between",
    "generate_rules",
    "profile",
    "profile_analyzers",
    "profile_tables",
    "rule_agreement",
    "rules_to_expectations",
    "run_analyzers",
    "suite_outcome",
    "threshold_monitor",
    "validate",
    "verify",
]
