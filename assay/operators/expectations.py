"""Expectations: row- and table-level rules validated in one plan.

Rules map to analyzers (:mod:`assay.operators.analyzers`), so a whole suite
costs one aggregation pass (row count, null counts and one ``count_if`` per
rule) plus one frequency pass per column with a uniqueness rule. The small
metrics frame is pivoted back into one result row per rule.

Value samples (``partial_unexpected_list``) come from one extra pass that
reads only rows failing some rule (the OR of the rule predicates is pushed
into the scan, so clean row groups are skipped by Parquet statistics) and
keeps the ``sample_size`` smallest values per rule with a window top-k,
which Spark computes partially in every task before the shuffle; no rule's
failures are ever gathered into one task. When the rule metrics are passed
in precomputed, only rules that actually have unexpected values are
sampled, so a clean suite needs no sample pass at all.

Semantics (per rule): nulls are skipped except by the not-null rule; a rule
succeeds when ``(considered - unexpected) / considered >= mostly`` (default
1.0), and vacuously when nothing is considered.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.functions.sql import RELATION, closed_range, group_key, ident, is_digested, lit, over, percent
from assay.operators.analyzers import (
    Analyzer,
    DuplicateRows,
    MissingCount,
    Size,
    UnexpectedCount,
)

SAMPLE_SIZE = 20
#: Buckets of map tasks whose smallest unexpected values are found first.
SAMPLE_BUCKETS = 256

TABLE_COLUMNS = "expect_table_columns_to_match_ordered_list"
TABLE_ROWS = "expect_table_row_count_to_be_between"
UNIQUE = "expect_column_values_to_be_unique"
NOT_NULL = "expect_column_values_to_not_be_null"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
LENGTHS = "expect_column_value_lengths_to_be_between"


def _kind(v) -> str:
    return "number" if isinstance(v, (int, float)) and not isinstance(v, bool) else "text" if isinstance(v, str) else "other"


@dataclass(frozen=True)
class Expectation:
    expectation_type: str
    column: str | None = None
    value_set: tuple | None = None
    min_value: float | int | str | None = None
    max_value: float | int | str | None = None
    mostly: float | None = None
    column_list: tuple[str, ...] | None = None

    def kwargs(self) -> dict:
        """Rule parameters in the usual ``kwargs`` shape (for reports)."""
        out: dict = {}
        if self.expectation_type == TABLE_COLUMNS:
            out["column_list"] = list(self.column_list or ())
        if self.column is not None:
            out["column"] = self.column
        if self.expectation_type == IN_SET:
            out["value_set"] = list(self.value_set or ())
        if self.expectation_type in (BETWEEN, LENGTHS, TABLE_ROWS):
            out["min_value"] = self.min_value
            out["max_value"] = self.max_value
        if self.mostly is not None:
            out["mostly"] = self.mostly
        return out

    # -- how the rule is measured -------------------------------------------------

    def unexpected(self) -> str | None:
        """SQL condition on a non-null value that makes it unexpected (row rules only)."""
        x = ident(self.column) if self.column else None
        if self.expectation_type == IN_SET:
            # nulls are skipped by the rule, so a null in the set means nothing
            known = ", ".join(lit(v) for v in self.value_set or () if v is not None)
            return f"NOT ({x} IN ({known}))" if known else "true"
        if self.expectation_type == BETWEEN:
            return f"NOT ({closed_range(x, self.min_value, self.max_value)})"
        if self.expectation_type == LENGTHS:
            return f"NOT ({closed_range(f'char_length({x})', self.min_value, self.max_value)})"
        return None

    def analyzers(self) -> list[Analyzer]:
        t = self.expectation_type
        if t in (TABLE_COLUMNS, TABLE_ROWS):
            return [Size()]
        if t == NOT_NULL:
            return [Size(), MissingCount(self.column)]
        if t == UNIQUE:
            return [Size(), MissingCount(self.column), DuplicateRows(self.column)]
        needs = "number" if t == BETWEEN and {_kind(b) for b in (self.min_value, self.max_value) if b is not None} == {"number"} else ""
        needs = "text" if t == LENGTHS else needs
        return [Size(), MissingCount(self.column), UnexpectedCount(self.column, condition=self.unexpected(), needs=needs)]


# ---- rule constructors (the usual expectation names) ---------------------------


def expect_table_columns_to_match_ordered_list(column_list: Sequence[str]) -> Expectation:
    return Expectation(TABLE_COLUMNS, column_list=tuple(column_list))


def expect_table_row_count_to_be_between(min_value=None, max_value=None) -> Expectation:
    return Expectation(TABLE_ROWS, min_value=min_value, max_value=max_value)


def expect_column_values_to_be_unique(column: str, mostly: float | None = None) -> Expectation:
    return Expectation(UNIQUE, column, mostly=mostly)


def expect_column_values_to_not_be_null(column: str, mostly: float | None = None) -> Expectation:
    return Expectation(NOT_NULL, column, mostly=mostly)


def expect_column_values_to_be_in_set(column: str, value_set: Sequence, mostly: float | None = None) -> Expectation:
    return Expectation(IN_SET, column, value_set=tuple(value_set), mostly=mostly)


def expect_column_values_to_be_between(
    column: str, min_value=None, max_value=None, mostly: float | None = None
) -> Expectation:
    if min_value is None and max_value is None:
        raise ValueError("min_value and max_value cannot both be None")
    return Expectation(BETWEEN, column, min_value=min_value, max_value=max_value, mostly=mostly)


def expect_column_value_lengths_to_be_between(
    column: str, min_value=None, max_value=None, mostly: float | None = None
) -> Expectation:
    if min_value is None and max_value is None:
        raise ValueError("min_value and max_value cannot both be None")
    return Expectation(LENGTHS, column, min_value=min_value, max_value=max_value, mostly=mostly)


# ---- validation ---------------------------------------------------------------------

RESULT_FIELDS = [
    ("seq", "int"),
    ("expectation_type", "string"),
    ("column", "string"),
    ("kwargs", "string"),
    ("success", "boolean"),
    ("element_count", "bigint"),
    ("missing_count", "bigint"),
    ("missing_percent", "double"),
    ("unexpected_count", "bigint"),
    ("unexpected_percent", "double"),
    ("unexpected_percent_total", "double"),
    ("observed_value", "string"),
]


def rule_analyzers(rules: Sequence[Expectation]) -> list[Analyzer]:
    """Every analyzer the rules need (duplicates are removed by the runner)."""
    return [a for e in rules for a in e.analyzers()]


def _key(a: Analyzer) -> str:
    return f"{a.metric}|{a.instance}"


def _result_row(i: int, e: Expectation, columns: list[str], m, sample_size: int) -> str:
    """SQL struct of rule ``i``'s result; ``m(analyzer)`` names a metric of the pivoted row."""
    t = e.expectation_type
    rows = f"CAST({m(Size())} AS BIGINT)"
    missing = unexpected = considered = "CAST(NULL AS BIGINT)"
    observed = "CAST(NULL AS STRING)"
    element = rows
    sample = "CAST(NULL AS ARRAY<STRING>)"
    if t == TABLE_COLUMNS:
        ok = lit(list(columns) == list(e.column_list or ()))
        observed = lit(json.dumps(list(columns)))
        element = "CAST(NULL AS BIGINT)"
    elif t == TABLE_ROWS:
        ok = closed_range(rows, e.min_value, e.max_value)
        observed = f"CAST({rows} AS STRING)"
        element = "CAST(NULL AS BIGINT)"
    else:
        missing = f"CAST({m(MissingCount(e.column))} AS BIGINT)"
        if t == NOT_NULL:
            unexpected, considered = missing, rows
            sample = f"array_repeat(CAST(NULL AS STRING), CAST(least({missing}, {max(sample_size, 0)}) AS INT))"
        elif t == UNIQUE:
            unexpected, considered = f"CAST({m(DuplicateRows(e.column))} AS BIGINT)", f"({rows} - {missing})"
        else:
            unexpected, considered = f"CAST({m(e.analyzers()[-1])} AS BIGINT)", f"({rows} - {missing})"
        mostly = 1.0 if e.mostly is None else float(e.mostly)
        ok = (
            f"({considered} = 0 OR try_divide(CAST({considered} - {unexpected} AS DOUBLE), "
            f"CAST({considered} AS DOUBLE)) >= {lit(mostly)})"
        )
    col_sql = lit(e.column) if e.column is not None else "CAST(NULL AS STRING)"
    return (
        f"named_struct('seq', {i}, 'expectation_type', {lit(t)}, 'column', {col_sql}, "
        f"'kwargs', {lit(json.dumps(e.kwargs(), default=str))}, 'success', coalesce({ok}, false), "
        f"'element_count', {element}, 'missing_count', {missing}, "
        f"'missing_percent', {percent(missing, rows)}, 'unexpected_count', {unexpected}, "
        f"'unexpected_percent', {percent(unexpected, considered)}, "
        f"'unexpected_percent_total', {percent(unexpected, rows)}, "
        f"'observed_value', {observed}, 'null_sample', {sample})"
    )


def _sort_keys(x: str, numeric: bool) -> tuple[str, str]:
    """Typed ordering of sampled values: numbers by value, everything else as text."""
    return (f"CAST({x} AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"), f"CAST({x} AS STRING)"


def unexpected_samples(
    df: DataFrame, rules: Sequence[Expectation], size: int = SAMPLE_SIZE, only: set[int] | None = None
) -> DataFrame | None:
    """``seq, partial_unexpected_list``: the ``size`` smallest unexpected values per rule.

    Row rules share one scan; uniqueness rules read the frequency table of
    their column. Null samples of not-null rules need no scan (see ``validate``).
    ``only`` restricts the work to those rule positions (rules known to have
    unexpected values).
    """
    numeric = {f.name: isinstance(f.dataType, T.NumericType) for f in df.schema.fields}
    parts: list[DataFrame] = []
    ordered = "transform(sort_array(collect_list(named_struct('rn', rn, 'v', v))), x -> x.v)"

    present = set(df.columns)  # a rule on a missing column fails on its metrics; it has no sample
    wanted = (lambda i: True) if only is None else (lambda i: i in only)
    row_rules = [(i, e, e.unexpected()) for i, e in enumerate(rules) if e.column in present and wanted(i)]
    row_rules = [(i, e, c) for i, e, c in row_rules if c is not None]
    if row_rules:
        items, any_bad = [], []
        for i, e, cond in row_rules:
            x = ident(e.column)
            k1, k2 = _sort_keys(x, numeric.get(e.column, False))
            bad = f"{x} IS NOT NULL AND ({cond})"
            any_bad.append(f"({bad})")
            items.append(f"CASE WHEN {bad} THEN named_struct('seq', {i}, 'k', {k1}, 'v', {k2}) END")
        # OR of the rule predicates first: clean row groups can be skipped by Parquet statistics
        # two levels: the smallest values of each rule within a bucket of map tasks, then of the
        # buckets; each level ships at most ``size`` rows per rule and task (partial group limit),
        # and the last task of a rule reads at most ``size`` rows per bucket
        top = (
            df.where(" OR ".join(any_bad))
            .selectExpr(f"explode(filter(array({', '.join(items)}), s -> s IS NOT NULL)) AS s")
            .selectExpr("s.*", f"pmod(spark_partition_id(), {SAMPLE_BUCKETS}) AS bucket")
            .selectExpr("seq", "k", "v", "row_number() OVER (PARTITION BY seq, bucket ORDER BY k, v) AS rn")
            .where(f"rn <= {size}")
            .selectExpr("seq", "v", "row_number() OVER (PARTITION BY seq ORDER BY k, v) AS rn")
            .where(f"rn <= {size}")
        )
        parts.append(top.groupBy("seq").agg(F.expr(ordered).alias("partial_unexpected_list")))

    for i, e in enumerate(rules):
        if e.expectation_type != UNIQUE or e.column not in present or not wanted(i):
            continue
        kind = df.schema[e.column].dataType
        c, key = ident(e.column), group_key(e.column, kind)
        # the same grouping as the statistics pass of the column
        repeated = over(
            df, f"SELECT {key} AS value, count(1) AS n FROM {RELATION} WHERE {c} IS NOT NULL GROUP BY {key}"
        ).where("n > 1")
        k1, k2 = _sort_keys("value", numeric.get(e.column, False))
        if is_digested(kind):
            # the smallest repeated digests (top-k per task, then merged: at most ``size`` rows),
            # broadcast to fetch one value of each: wide values are not shuffled for a sample
            few = repeated.orderBy("value").limit(size)
            smallest = (
                over(df, f"SELECT {key} AS value, CAST({c} AS STRING) AS v FROM {RELATION} WHERE {c} IS NOT NULL")
                .join(F.broadcast(few), "value")
                .groupBy("value", "n")
                .agg(F.min("v").alias("v"))
                .selectExpr("CAST(NULL AS DOUBLE) AS k1", "v AS k2", "v", "n")
            )
        else:
            smallest = (
                repeated.selectExpr(f"{k1} AS k1", f"{k2} AS k2", "CAST(value AS STRING) AS v", "n")
                .orderBy("k1", "k2")
                .limit(size)  # top-k per task, then merged: bounded
            )
        listed = (
            "flatten(transform(sort_array(collect_list(named_struct('k1', k1, 'k2', k2, 'v', v, 'n', n))), "
            f"x -> array_repeat(x.v, CAST(least(x.n, {size}) AS INT))))"
        )
        parts.append(smallest.selectExpr(f"{i} AS seq", f"slice({listed}, 1, {size}) AS partial_unexpected_list"))

    if not parts:
        return None
    return reduce(DataFrame.unionByName, parts)


def validate(
    df: DataFrame,
    rules: Sequence[Expectation],
    table_name: str = "",
    suite_name: str = "",
    sample_size: int = SAMPLE_SIZE,
    metrics: DataFrame | None = None,
) -> DataFrame:
    """One result row per rule (``seq`` = position in ``rules``), lazily planned.

    ``metrics`` may carry the rules' metrics already computed; otherwise they are
    computed here by ``assay.plans.parallel.compute_metrics``, which bounds plan width
    and isolates bad rules: a rule on a missing column, of the wrong type or whose
    condition fails while it runs is not successful, and the others keep their results.
    """
    from assay.plans.parallel import compute_metrics

    rules = list(rules)
    columns = df.columns
    analyzers = rule_analyzers(rules)
    only = None
    if metrics is None:
        metrics = compute_metrics({table_name: (df, analyzers)})
    if sample_size > 0:
        # metrics already computed: sample only rules that have unexpected values
        # (a few metric rows come back; clean suites then need no sample pass at all)
        bad = {
            f"{r['metric']}|{r['instance']}"
            for r in metrics.where("metric IN ('UnexpectedCount', 'DuplicateRows') AND value > 0")
            .select("metric", "instance")
            .collect()
        }
        only = {i for i, e in enumerate(rules) if _key(e.analyzers()[-1]) in bad}

    keys = list(dict.fromkeys(_key(a) for a in analyzers))
    name = {k: f"_m{j}" for j, k in enumerate(keys)}
    wide = metrics.selectExpr(
        *[f"max(CASE WHEN concat(metric, '|', instance) = {lit(k)} THEN value END) AS {name[k]}" for k in keys]
    )
    structs = [_result_row(i, e, columns, lambda a: name[_key(a)], sample_size) for i, e in enumerate(rules)]
    results = wide.selectExpr(f"inline(array({', '.join(structs)}))")

    samples = unexpected_samples(df, rules, sample_size, only) if sample_size > 0 else None
    if samples is not None:
        # at most one row per rule on each side: a bounded broadcast
        results = results.join(F.broadcast(samples), "seq", "left")
    else:
        results = results.withColumn("partial_unexpected_list", F.lit(None).cast("array<string>"))
    k = max(sample_size, 0)
    return results.selectExpr(
        f"{lit(table_name)} AS table_name",
        f"{lit(suite_name)} AS suite_name",
        *[f"`{n}`" for n, _ in RESULT_FIELDS],
        "coalesce(partial_unexpected_list, null_sample, array()) AS partial_unexpected_list"
        if k > 0
        else "CAST(array() AS ARRAY<STRING>) AS partial_unexpected_list",
    )


def suite_outcome(results: DataFrame) -> DataFrame:
    """Per table: ``validation_success`` and rule counts (success, total, passed, failed)."""
    return results.groupBy("table_name").agg(
        F.expr("bool_and(success)").alias("validation_success"),
        F.expr("count(1)").alias("total_expectations"),
        F.expr("count_if(success)").alias("successful_expectations"),
        F.expr("count_if(NOT success)").alias("failed_expectations"),
    )
