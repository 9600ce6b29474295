"""Cross-tool agreement (checks vs expectations) and metric threshold monitoring.

Both inputs of each operator are small result frames (a few rows per rule or
metric), so the joins here never touch table data.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.operators.analyzers import (
    Analyzer,
    Completeness,
    Distinctness,
    Maximum,
    MaxLength,
    Mean,
    Minimum,
    MinLength,
    Size,
    StandardDeviation,
    Uniqueness,
)

from assay.operators import expectations as X

# rule kind shared by a check constraint and an expectation type
CONSTRAINT_KIND = {
    "size": "row_count",
    "completeness": "not_null",
    "uniqueness": "unique",
    "containment": "in_set",
    "compliance": "custom",
}
EXPECTATION_KIND = {
    X.TABLE_ROWS: "row_count",
    X.NOT_NULL: "not_null",
    X.UNIQUE: "unique",
    X.IN_SET: "in_set",
    X.BETWEEN: "range",
    X.LENGTHS: "length",
    X.TABLE_COLUMNS: "columns",
}


def _kind(mapping: dict[str, str], c) -> F.Column:
    expr = F.lit(None).cast("string")
    for k, v in mapping.items():
        expr = F.when(c == k, v).otherwise(expr)
    return expr


def rule_agreement(constraints: DataFrame, expectations: DataFrame) -> DataFrame:
    """Full outer join of check and expectation outcomes on (table, rule kind, column).

    ``agreement`` is ``agree`` / ``disagree`` when both tools test the same
    thing, else ``check_only`` / ``expectation_only``. Several rules of one
    kind on one column are folded with AND first, so the join is one-to-one.
    """
    key = ["table_name", "rule_kind", "column"]
    c = (
        constraints.select(
            "table_name",
            _kind(CONSTRAINT_KIND, F.col("kind")).alias("rule_kind"),
            F.coalesce(F.col("column"), F.lit("")).alias("column"),
            (F.col("status") == "Success").alias("ok"),
        )
        .groupBy(*key)
        .agg(F.bool_and("ok").alias("check_passed"))
    )
    e = (
        expectations.select(
            "table_name",
            _kind(EXPECTATION_KIND, F.col("expectation_type")).alias("rule_kind"),
            F.coalesce(F.col("column"), F.lit("")).alias("column"),
            F.col("success").alias("ok"),
        )
        .groupBy(*key)
        .agg(F.bool_and("ok").alias("expectation_passed"))
    )
    j = c.join(e, key, "full_outer")
    cp, ep = F.col("check_passed"), F.col("expectation_passed")
    return j.select(
        *key,
        cp,
        ep,
        F.when(cp.isNull(), "expectation_only")
        .when(ep.isNull(), "check_only")
        .when(cp == ep, "agree")
        .otherwise("disagree")
        .alias("agreement"),
    )


def threshold_analyzers(thresholds: Iterable, schemas: dict[str, T.StructType]) -> dict[str, list[Analyzer]]:
    """Per table, the analyzers that (table_name, metric, instance, ...) thresholds look at; unknown ones are left out."""
    known = (Size, Completeness, Distinctness, Uniqueness, Minimum, Maximum, Mean, StandardDeviation, MinLength, MaxLength)
    by_name = {a.metric: a for a in known}
    out: dict[str, list[Analyzer]] = {t: [] for t in schemas}
    for table, metric, instance, *_ in thresholds:
        if table in out and metric in by_name:
            column = None if metric == Size.metric else instance
            out[table].append(by_name[metric](column))
    return out


def threshold_monitor(metrics: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Compare metrics with ``thresholds(table_name, metric, instance, min_value, max_value)``.

    A null bound is open. ``status`` is ``ok``, ``breach`` (value outside the
    range) or ``missing`` (no metric value for the threshold).
    """
    key = ["table_name", "metric", "instance"]
    j = thresholds.join(metrics.select(*key, "value"), key, "left")
    v, lo, hi = F.col("value"), F.col("min_value"), F.col("max_value")
    inside = (lo.isNull() | (v >= lo)) & (hi.isNull() | (v <= hi))
    return j.select(
        *key,
        v,
        lo,
        hi,
        F.when(v.isNull(), "missing").when(inside, "ok").otherwise("breach").alias("status"),
    )
