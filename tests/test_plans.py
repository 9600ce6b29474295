"""Physical-plan properties the design relies on (pruning, pushdown, bounded top-k, no Python)."""

import pytest

from assay.operators import expectations as X
from assay.operators.analyzers import Distinctness, Size, run_analyzers
from assay.operators.generate import generate_rules
from assay.operators.profile import profile

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def lineitem(spark):
    return spark.read.parquet(f"{SF}/lineitem.parquet")


def test_size_reads_no_columns(lineitem):
    text = formatted(run_analyzers(lineitem, [Size()], "l"))
    assert "ReadSchema: struct<>" in text


def test_frequency_pass_reads_one_column(lineitem):
    text = formatted(run_analyzers(lineitem, [Distinctness("l_tax")], "l"))
    assert "ReadSchema: struct<l_tax:double>" in text
    assert "PushedFilters: [IsNotNull(l_tax)]" in text


def test_sample_scan_pushes_rule_predicates(lineitem):
    rules = [
        X.expect_column_values_to_be_in_set("l_returnflag", ["A", "N"]),
        X.expect_column_values_to_be_between("l_quantity", 1, 40),
    ]
    text = formatted(X.validate(lineitem, rules, "l"))
    assert "Not(In(l_returnflag, [A,N]))" in text
    assert "GreaterThan(l_quantity,40.0)" in text
    # top-k per rule is limited inside every task before the shuffle
    lines = text.splitlines()
    assert any("Exchange" in a and "WindowGroupLimit" in b for a, b in zip(lines, lines[1:]))


def test_row_count_rules_read_no_columns(lineitem):
    from assay.operators.generate import rule_metrics

    text = formatted(run_analyzers(lineitem, rule_metrics(lineitem.schema, [X.TABLE_ROWS]), "l"))
    assert "ReadSchema: struct<>" in text and "hashpartitioning" not in text


def test_samples_are_limited_at_two_levels(lineitem):
    rules = [X.expect_column_values_to_be_between("l_quantity", 1, 40)]
    lines = formatted(X.validate(lineitem, rules, "l")).splitlines()
    limited = [b for a, b in zip(lines, lines[1:]) if "Exchange" in a and "WindowGroupLimit" in b]
    assert len(limited) >= 2


def test_no_python_in_plans(lineitem):
    plans = [
        plan_of(profile(lineitem, "l")),
        plan_of(X.validate(lineitem, [X.expect_column_values_to_be_unique("l_orderkey")], "l")),
    ]
    for p in plans:
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


@pytest.mark.parametrize(
    "n,lo,hi",
    [(0, 0, 0), (1, 0, 1), (9, 8, 9), (10, 9, 11), (11, 9, 12), (15000, 13500, 16500), (600037, 540033, 660040)],
)
def test_row_count_range_truncates(spark, n, lo, hi):
    metrics = spark.createDataFrame(
        [("t", 0, "Dataset", "*", "Size", "Size()", float(n), "DoubleMetric", "Success", None)],
        "table_name string, seq int, entity string, instance string, metric string, analyzer string, "
        "value double, metric_type string, status string, message string",
    )
    r = [x for x in generate_rules(metrics, {"t": ["a"]}).collect() if x.expectation_type == X.TABLE_ROWS][0]
    assert (int(r.min_value), int(r.max_value)) == (lo, hi)
    assert lo == max(0, int(n * 0.9)) and hi == int(n * 1.1)
