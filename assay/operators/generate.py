"""Derive an expectation suite from a table's own metrics.

Works entirely on the (small) long-form metrics frame, so it is a handful of
filters, a conditional aggregation and a union - no data scan. Rules per
table, in order: metric-driven rules (row count, not-null, unique, min
length) in metric order, then value ranges in column order, then the
ordered column list.

Fixed thresholds of the rule set (they decide which rules are generated):
  row count range      = [max(0, trunc(n * 0.9)), trunc(n * 1.1)]
  completeness >= 0.95 -> strict not-null rule
  completeness >= 0.5  -> not-null rule with mostly = completeness * 0.9
  uniqueness   >= 0.99 -> unique rule
  min length   >  0    -> length rule with that minimum and no maximum
A metric without a value (failed, e.g. an empty table) yields no rule, and
ranges need both Minimum and Maximum of the same column in the same table.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.operators import expectations as X
from assay.operators.analyzers import Analyzer, Completeness, Maximum, Minimum, MinLength, Size, Uniqueness
from assay.operators.profile import SAMPLED

ROW_COUNT_LOW = 0.9
ROW_COUNT_HIGH = 1.1
STRICT_COMPLETENESS = 0.95
MIN_COMPLETENESS = 0.5
MOSTLY_FACTOR = 0.9
MIN_UNIQUENESS = 0.99

RULES_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("suite_name", T.StringType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("expectation_type", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("min_value", T.DoubleType()),
        T.StructField("max_value", T.DoubleType()),
        T.StructField("mostly", T.DoubleType()),
        T.StructField("column_list", T.ArrayType(T.StringType())),
    ]
)


def rule_metrics(schema: T.StructType, kinds: Iterable[str]) -> list[Analyzer]:
    """The metrics that rules of the given expectation types are derived from, and no others."""
    kinds = set(kinds)
    out: list[Analyzer] = [Size()] if X.TABLE_ROWS in kinds else []
    for f in schema.fields:
        if X.NOT_NULL in kinds:
            out.append(Completeness(f.name))
        if isinstance(f.dataType, T.NumericType) and X.BETWEEN in kinds:
            out += [Minimum(f.name), Maximum(f.name)]
        if isinstance(f.dataType, T.StringType):
            out += [MinLength(f.name)] * (X.LENGTHS in kinds) + [Uniqueness(f.name)] * (X.UNIQUE in kinds)
    return out


def suite_name_for(table_name: str) -> str:
    return f"{table_name}_auto_generated_suite"


def _rule(df: DataFrame, group: int, order, etype: str, column, lo=None, hi=None, mostly=None, columns=None):
    null_d = F.lit(None).cast("double")
    return df.select(
        "table_name",
        F.lit(group).alias("_group"),
        order.cast("int").alias("_order"),
        F.lit(etype).alias("expectation_type"),
        (column if column is not None else F.lit(None)).cast("string").alias("column"),
        (lo if lo is not None else null_d).cast("double").alias("min_value"),
        (hi if hi is not None else null_d).cast("double").alias("max_value"),
        (mostly if mostly is not None else null_d).cast("double").alias("mostly"),
        (columns if columns is not None else F.lit(None)).cast("array<string>").alias("column_list"),
    )


def generate_rules(metrics: DataFrame, table_columns: dict[str, Sequence[str]]) -> DataFrame:
    """Rules frame (``RULES_SCHEMA``) for every table in ``table_columns``.

    ``metrics`` is a long-form metrics frame (as from ``profile``), possibly
    holding several tables; bounds never leak between tables.
    """
    spark = metrics.sparkSession
    tables = list(table_columns)
    m = metrics.where(F.col("table_name").isin(tables) & F.col("value").isNotNull())
    # a sample's row count, extremes and repeated values say nothing about the table's
    m = m.where((F.col("metric_type") != SAMPLED) | ~F.col("metric").isin("Size", "Minimum", "Maximum", "MinLength", "Uniqueness"))
    v, metric, inst = F.col("value"), F.col("metric"), F.col("instance")

    size = m.where((metric == "Size") & (inst == "*"))
    n = v.cast("long")
    size_rule = _rule(
        size,
        0,
        F.col("seq"),
        X.TABLE_ROWS,
        None,
        lo=F.greatest(F.lit(0), (n * F.lit(ROW_COUNT_LOW)).cast("long")),
        hi=(n * F.lit(ROW_COUNT_HIGH)).cast("long"),
    )

    comp = m.where((metric == "Completeness") & (inst != "*") & (v >= F.lit(MIN_COMPLETENESS)))
    comp_rule = _rule(
        comp,
        0,
        F.col("seq"),
        X.NOT_NULL,
        inst,
        mostly=F.when(v < F.lit(STRICT_COMPLETENESS), v * F.lit(MOSTLY_FACTOR)),
    )

    # an estimate has to be that high with its lower bound
    sure = F.coalesce(F.col("lower"), v) if "lower" in metrics.columns else v
    uniq = m.where((metric == "Uniqueness") & (sure >= F.lit(MIN_UNIQUENESS)))
    uniq_rule = _rule(uniq, 0, F.col("seq"), X.UNIQUE, inst)

    minlen = m.where((metric == "MinLength") & (v > 0))
    minlen_rule = _rule(minlen, 0, F.col("seq"), X.LENGTHS, inst, lo=v.cast("long"))

    bounds = (
        m.where(metric.isin("Minimum", "Maximum"))
        .groupBy("table_name", "instance")
        .agg(
            F.max(F.when(metric == "Minimum", v)).alias("lo"),
            F.max(F.when(metric == "Maximum", v)).alias("hi"),
            F.min(F.when(metric == "Minimum", F.col("seq"))).alias("first_seq"),
        )
        .where(F.col("lo").isNotNull() & F.col("hi").isNotNull())
    )
    range_rule = _rule(bounds, 1, F.col("first_seq"), X.BETWEEN, inst, lo=F.col("lo"), hi=F.col("hi"))

    cols = spark.createDataFrame(
        [(t, list(c)) for t, c in table_columns.items()],
        "table_name string, columns array<string>",
    )
    cols_rule = _rule(cols, 2, F.lit(0), X.TABLE_COLUMNS, None, columns=F.col("columns"))

    rules = size_rule
    for r in (comp_rule, uniq_rule, minlen_rule, range_rule, cols_rule):
        rules = rules.unionByName(r)
    # at most a few rules per column of one table: a small, bounded window
    order = F.row_number().over(Window.partitionBy("table_name").orderBy("_group", "_order"))
    return rules.select(
        "table_name",
        F.concat(F.col("table_name"), F.lit("_auto_generated_suite")).alias("suite_name"),
        (order - 1).cast("int").alias("seq"),
        "expectation_type",
        "column",
        "min_value",
        "max_value",
        "mostly",
        "column_list",
    )


def rules_to_expectations(rows: Iterable) -> list[X.Expectation]:
    """Turn collected rule rows (ordered by ``seq``) into ``Expectation`` objects."""
    out = []
    for r in sorted(rows, key=lambda r: r["seq"]):
        t = r["expectation_type"]
        if t == X.TABLE_ROWS:
            out.append(X.expect_table_row_count_to_be_between(int(r["min_value"]), int(r["max_value"])))
        elif t == X.NOT_NULL:
            out.append(X.expect_column_values_to_not_be_null(r["column"], mostly=r["mostly"]))
        elif t == X.UNIQUE:
            out.append(X.expect_column_values_to_be_unique(r["column"]))
        elif t == X.LENGTHS:
            out.append(X.expect_column_value_lengths_to_be_between(r["column"], int(r["min_value"]), None))
        elif t == X.BETWEEN:
            out.append(X.expect_column_values_to_be_between(r["column"], r["min_value"], r["max_value"]))
        elif t == X.TABLE_COLUMNS:
            out.append(X.expect_table_columns_to_match_ordered_list(r["column_list"]))
    return out


def generated_suite(spark: SparkSession, metrics: DataFrame, table_name: str, columns: Sequence[str]):
    """Rules of one table, collected (a few rows per column) and converted."""
    rows = generate_rules(metrics, {table_name: columns}).where(F.col("table_name") == table_name).collect()
    return rules_to_expectations(rows)
