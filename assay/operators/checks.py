"""Checks: named groups of constraints, each an assertion on one metric.

A ``Check`` is a plain builder of constraints. ``verify`` collects the
analyzers every constraint needs, runs them in one plan
(:func:`run_analyzers`), then evaluates all assertions on the small metrics
frame - a join of a few dozen metric rows with a few dozen constraint rows.
When the caller already has the metrics (e.g. from a profile run that
included the check analyzers), :func:`evaluate_checks` skips the data scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.functions.sql import ident, lit
from assay.operators.analyzers import (
    Analyzer,
    Completeness,
    Compliance,
    Size,
    Uniqueness,
    run_analyzers,
)
from assay.plans.parallel import compute_metrics

Assertion = str | Callable[[Column], Column]

@dataclass(frozen=True)
class Constraint:
    kind: str  # size | completeness | uniqueness | containment | compliance
    analyzer: Analyzer
    assertion: Assertion = field(compare=False)
    display: str
    column: str | None = None

    def evaluate(self, value: Column) -> Column:
        """The assertion on the metric: a callable on the value Column, or SQL over ``value``."""
        if callable(self.assertion):
            return self.assertion(value)
        return F.expr(self.assertion)


@dataclass(frozen=True)
class Check:
    """An ordered list of constraints with a level (``Error`` or ``Warning``)."""

    description: str
    level: str = "Error"
    constraints: tuple[Constraint, ...] = ()

    def _add(self, c: Constraint) -> Check:
        return replace(self, constraints=self.constraints + (c,))

    def has_size(self, assertion: Assertion = "value > 0") -> Check:
        a = Size()
        return self._add(Constraint("size", a, assertion, f"SizeConstraint({a.name})"))

    def is_complete(self, column: str) -> Check:
        a = Completeness(column)
        return self._add(
            Constraint("completeness", a, "value = 1.0", f"CompletenessConstraint({a.name})", column)
        )

    def has_completeness(self, column: str, assertion: Assertion) -> Check:
        a = Completeness(column)
        return self._add(
            Constraint("completeness", a, assertion, f"CompletenessConstraint({a.name})", column)
        )

    def is_unique(self, column: str) -> Check:
        a = Uniqueness(column)
        return self._add(
            Constraint("uniqueness", a, "value = 1.0", f"UniquenessConstraint({a.name})", column)
        )

    def is_contained_in(self, column: str, values: Sequence) -> Check:
        """Every row is null or one of ``values``."""
        label = f"{column} contained in {','.join(str(v) for v in values)}"
        c = ident(column)
        known = ", ".join(lit(v) for v in values if v is not None)
        pred = f"{c} IS NULL OR {c} IN ({known})" if known else f"{c} IS NULL"
        a = Compliance.of(label, pred)
        return self._add(
            Constraint("containment", a, "value = 1.0", f"ComplianceConstraint(Compliance({label}))", column)
        )

    def satisfies(self, predicate: str, name: str, assertion: Assertion = "value = 1.0") -> Check:
        """Share of all rows where the SQL ``predicate`` is true passes ``assertion``."""
        a = Compliance.of(name, predicate)
        return self._add(Constraint("compliance", a, assertion, f"ComplianceConstraint(Compliance({name}))"))

    def analyzers(self) -> list[Analyzer]:
        return [c.analyzer for c in self.constraints]


class Verification(NamedTuple):
    constraints: DataFrame  # one row per constraint
    checks: DataFrame  # one row per check
    status: DataFrame  # one row per table: overall_status


_SPEC_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("cid", T.IntegerType()),
        T.StructField("check_seq", T.IntegerType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("constraint", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("instance", T.StringType()),
    ]
)


def evaluate_checks(spark: SparkSession, metrics: DataFrame, plan: dict[str, Sequence[Check]]) -> Verification:
    """Evaluate checks per table on an existing metrics frame (no data scan).

    ``plan`` maps table name -> checks. The constraint list is driver-side
    configuration (bounded by the number of rules), so it becomes a small
    local relation that Spark broadcasts into the join with the metrics.
    """
    specs, asserts = [], []
    for table, checks in plan.items():
        for ci, check in enumerate(checks):
            for si, c in enumerate(check.constraints):
                cid = len(specs)
                specs.append(
                    (table, cid, ci, check.description, check.level, si, c.kind, c.display, c.column)
                    + c.analyzer.key
                )
                asserts.append(c)
    spec = spark.createDataFrame(specs, _SPEC_SCHEMA)

    m = metrics.select("table_name", "metric", "instance", "value", "message")
    joined = spec.join(m, ["table_name", "metric", "instance"], "left")

    value = F.col("value")
    if all(isinstance(c.assertion, str) for c in asserts):
        cases = " ".join(f"WHEN {i} THEN ({c.assertion})" for i, c in enumerate(asserts))
        passed = F.expr(f"CASE cid {cases} END") if asserts else F.lit(None)
    else:
        passed = F.lit(None)
        for i, c in enumerate(asserts):
            passed = F.when(F.col("cid") == i, c.evaluate(value)).otherwise(passed)
    joined = joined.withColumn("_passed", F.coalesce(value.isNotNull() & passed, F.lit(False)))
    constraints = joined.selectExpr(
        "table_name",
        "check_name",
        "level",
        "check_seq",
        "seq",
        "kind",
        "`constraint`",
        "`column`",
        "value AS metric_value",
        "CASE WHEN _passed THEN 'Success' ELSE 'Failure' END AS status",
        "CASE WHEN _passed THEN '' WHEN value IS NULL THEN coalesce(message, 'Missing metric') "
        "ELSE concat('Value: ', CAST(value AS STRING), ' does not meet the constraint requirement!') END AS message",
    )
    return Verification(constraints, *rollup(constraints))


def rollup(constraints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Check status (its level if any constraint failed) and each table's worst status."""
    checks = (
        constraints.groupBy("table_name", "check_seq", "check_name", "level")
        .agg(F.bool_and(F.col("status") == "Success").alias("ok"))
        .select(
            "table_name",
            "check_seq",
            "check_name",
            F.when(F.col("ok"), "Success").otherwise(F.col("level")).alias("status"),
        )
    )
    sev = F.when(F.col("status") == "Error", 2).when(F.col("status") == "Warning", 1).otherwise(0)
    status = (
        checks.groupBy("table_name")
        .agg(F.max(sev).alias("sev"))
        .select(
            "table_name",
            F.when(F.col("sev") == 2, "Error")
            .when(F.col("sev") == 1, "Warning")
            .otherwise("Success")
            .alias("overall_status"),
        )
    )
    return checks, status


def verify(df: DataFrame, checks: Sequence[Check], table_name: str = "", checkpoint: bool = True) -> Verification:
    """Run ``checks`` on ``df``: one aggregation pass plus one frequency pass per unique column.

    With ``checkpoint`` the metrics are computed once and checkpointed, so
    reading all three result frames never rescans ``df``.
    """
    analyzers = [a for c in checks for a in c.analyzers()]
    if checkpoint:
        metrics = compute_metrics({table_name: (df, analyzers)})  # bounded plans, run side by side
    else:
        metrics = run_analyzers(df, analyzers, table_name)
    return evaluate_checks(df.sparkSession, metrics, {table_name: checks})
