"""Mergeable metric states: profile once, add what is new, never read old data again.

A *state* of a table (or of one segment of it) is everything its metrics are finished from:

* **partials**, one row each: counts add up, minima and maxima combine, and mean and standard
  deviation come from ``(n, mean, m2)`` (rows, mean, sum of squared deviations), which combine
  without cancellation;
* opt-in **sketches** of distinct counts (``ApproxCountDistinct``, ``ApproxDistinctness``), 4 KB a column, for
  columns whose values are too many to be shuffled: estimates with a stated error, never the default;
* **frequencies**, ``(column, key, n)``: how often each value of a column occurs. Wide values
  are represented by their SHA-256 (see :func:`assay.functions.sql.group_key`), all others by
  their text, so the tables of any two states have the same layout and add up by key.

States are Parquet tables. :func:`compute_states` reads a table once (one aggregation for all
partials, one narrow pass for each column with a frequency metric) and can cut it into segments
by an expression - days, files, regions - in that same pass. :func:`metrics_of` finishes metrics
from any set of stored states: it reads states only, so yesterday's state and today's rows give
the metrics of both. :func:`merge_states` folds many states into one (compaction).

Combining is associative and commutative: it does not matter in which order, or in how many
steps, states are merged. Counts, extremes and frequencies are exact; means and deviations
agree with a single pass up to rounding. Partial rows are folded in the order of their numbers,
so a result does not depend on the cluster.

Scale: a state's frequencies hold one row for each distinct value (40 bytes or less before
compression), combined map-side, so a hot value costs one row a task; merging shuffles distinct
values, never rows of the table. Segments multiply that at most by the segments that a value
occurs in. Removed data cannot be subtracted from extremes: rebuild the state of its segment.

Edge cases: an empty table gives a state of zero rows (its metrics are failed ones, ``Size`` 0);
nulls are counted, and are no values; ``-0.0`` and ``0.0`` are one value; metrics that the schema
rules out are failed metrics with a message, as in a direct run; states of tables with different
columns merge as far as they share them, and a column that a state lacks counts as missing data
only for the rows that have it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.functions.sql import group_key, ident, is_digested, lit
from assay.operators.analyzers import (
    _FINAL_COLUMNS,
    FREQUENCY_STATS,
    Analyzer,
    _inline,
    _pivot_rows,
    _plan,
    dedupe,
    empty_metrics,
)
from assay.session import remove

PARTIALS, FREQUENCIES = "partials", "frequencies"
PARTIALS_SCHEMA = "segment string, part string, kind string, n bigint, x double, m2 double, sketch binary"
FREQUENCIES_SCHEMA = "segment string, column string, key binary, n bigint"

#: How a partial aggregate combines, by the first word of its name.
KINDS = {
    "rows": "count",
    "nonnull": "count",
    "compliant": "count",
    "unexpected": "count",
    "Minimum": "min",
    "MinLength": "min",
    "Maximum": "max",
    "MaxLength": "max",
    "Mean": "moments",
    "StandardDeviation": "moments",
    "sketch": "sketch",
}


def kind_of(part: str) -> str:
    return KINDS[part.split(":", 1)[0]]


def state_key(name: str, t: T.DataType) -> str:
    """A value's key in a frequency state: the digest of a wide value, the text of any other."""
    if is_digested(t):
        return group_key(name, t)
    c = ident(name)
    if isinstance(t, (T.FloatType, T.DoubleType)):
        c = f"({c} + 0)"  # one zero
    if isinstance(t, (T.StructType, T.MapType, T.ArrayType, T.VariantType)):
        return f"unhex(sha2(CAST(to_json(named_struct('v', {c}), map('ignoreNullFields', 'false')) AS BINARY), 256))"
    return f"CAST(CAST({c} AS STRING) AS BINARY)"


@dataclass(frozen=True)
class StateStore:
    """The folder of one stored state (or of the states of all segments of a table)."""

    spark: SparkSession
    path: str

    def partials(self) -> DataFrame:
        return self.spark.read.schema(PARTIALS_SCHEMA).parquet(f"{self.path}/{PARTIALS}")

    def frequencies(self, columns: Sequence[str] | None = None) -> DataFrame:
        rows = self.spark.read.schema(FREQUENCIES_SCHEMA).parquet(f"{self.path}/{FREQUENCIES}")
        return rows if columns is None else rows.where(F.col("column").isin(list(columns)))

    def remove(self) -> None:
        remove(self.spark, self.path)


def _partial_rows(part: str, sql: str | Column, i: int) -> tuple[list[Column], str]:
    """(aggregates of one partial, the struct of its row)."""
    kind = kind_of(part)
    row = f"named_struct('part', {lit(part)}, 'kind', {lit(kind)}, 'n', {{n}}, 'x', {{x}}, 'm2', {{m2}}, 'sketch', {{sketch}})"
    null_n, null_x, none = "CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)", "CAST(NULL AS BINARY)"
    if kind == "moments":
        value = sql[sql.index("(") + 1 : -1]  # avg(x), stddev_pop(x)
        aggs = [F.expr(f"count({value})").alias(f"_n{i}"), F.expr(f"avg({value})").alias(f"_x{i}"), F.expr(f"var_pop({value}) * count({value})").alias(f"_m{i}")]
        return aggs, row.format(n=f"_n{i}", x=f"_x{i}", m2=f"_m{i}", sketch=none)
    agg = (F.expr(sql) if isinstance(sql, str) else sql).alias(f"_a{i}")
    if kind == "count":
        return [agg], row.format(n=f"CAST(_a{i} AS BIGINT)", x=null_x, m2=null_x, sketch=none)
    if kind == "sketch":
        return [agg], row.format(n=null_n, x=null_x, m2=null_x, sketch=f"_a{i}")
    return [agg], row.format(n=null_n, x=f"CAST(_a{i} AS DOUBLE)", m2=null_x, sketch=none)


def state_frames(df: DataFrame, analyzers: Iterable[Analyzer], segment: str = "''") -> tuple[DataFrame, DataFrame]:
    """(partials, frequencies) of ``df`` by segment (a SQL expression; null is the segment ``''``)."""
    spark = df.sparkSession
    todo = list(enumerate(dedupe(analyzers)))
    partials, _, _, by_column = _plan(df, todo, df.columns)
    partials.setdefault("rows", "count(1)")
    label = f"coalesce(CAST({segment} AS STRING), '')"
    aggs, rows = zip(*(_partial_rows(p, e, i) for i, (p, e) in enumerate(partials.items())), strict=True)
    grouped = df.groupBy(F.expr(label).alias("_segment")) if segment != "''" else df.groupBy()
    wide = grouped.agg(*(a for part in aggs for a in part))
    wide = wide if segment != "''" else wide.withColumn("_segment", F.lit(""))
    partial_rows = wide.selectExpr("_segment AS segment", f"inline(array({', '.join(rows)}))")
    frequency = [
        df.where(f"{ident(c)} IS NOT NULL").selectExpr(f"{label} AS segment", f"{state_key(c, df.schema[c].dataType)} AS key")
        .groupBy("segment", "key").agg(F.count(F.lit(1)).alias("n")).selectExpr("segment", f"{lit(c)} AS column", "key", "n")
        for c in by_column
    ]
    none = spark.createDataFrame([], FREQUENCIES_SCHEMA)
    return partial_rows, reduce(DataFrame.unionByName, frequency) if frequency else none


def _write(partials: DataFrame, frequencies: DataFrame, path: str) -> StateStore:
    # frequencies first: a state without partials is not there yet
    frequencies.sortWithinPartitions("column", "key").write.parquet(f"{path}/{FREQUENCIES}")
    partials.coalesce(1).write.parquet(f"{path}/{PARTIALS}")  # a row for each partial and segment
    return StateStore(partials.sparkSession, path)


def compute_states(df: DataFrame, analyzers: Iterable[Analyzer], path: str, segment: str = "''") -> StateStore:
    """Measure ``df`` and store its state (one for each segment) in the new folder ``path``."""
    return _write(*state_frames(df, analyzers, segment), path)


# ---- combining -----------------------------------------------------------------------------

#: (n, mean, m2) of two disjoint sets of numbers; sets without numbers change nothing.
_MERGE = (
    "aggregate(array_sort(collect_list(CASE WHEN kind = 'moments' AND n > 0 THEN named_struct('n', n, 'x', x, 'm2', m2) END)), "
    "named_struct('n', 0L, 'x', 0D, 'm2', 0D), (a, b) -> named_struct('n', a.n + b.n, "
    "'x', a.x + (b.x - a.x) * b.n / (a.n + b.n), "
    "'m2', a.m2 + b.m2 + (b.x - a.x) * (b.x - a.x) * (CAST(a.n AS DOUBLE) * b.n / (a.n + b.n))))"
)


def _all(stores: Sequence[StateStore], what) -> DataFrame:
    return reduce(DataFrame.unionByName, [what(s) for s in stores])


def merged_partials(partials: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row for each partial (and group of segments)."""
    combined = partials.groupBy(*by, "part", "kind").agg(
        F.sum("n").alias("_n"), F.min("x").alias("_lo"), F.max("x").alias("_hi"), F.expr(_MERGE).alias("_m"),
        F.expr("hll_union_agg(CASE WHEN kind = 'sketch' THEN sketch END)").alias("_s"),
    )
    return combined.selectExpr(
        *by, "part", "kind",
        "CASE kind WHEN 'count' THEN _n WHEN 'moments' THEN _m.n END AS n",
        "CASE kind WHEN 'min' THEN _lo WHEN 'max' THEN _hi WHEN 'moments' THEN _m.x END AS x",
        "CASE WHEN kind = 'moments' THEN _m.m2 END AS m2",
        "CASE WHEN kind = 'sketch' THEN _s END AS sketch",
    )


def merged_frequencies(frequencies: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return frequencies.groupBy(*by, "column", "key").agg(F.sum("n").alias("n"))


def merge_states(stores: Sequence[StateStore], path: str) -> StateStore:
    """Fold states into one stored state without segments, in the new folder ``path``."""
    partials = merged_partials(_all(stores, StateStore.partials)).withColumn("segment", F.lit(""))
    frequencies = merged_frequencies(_all(stores, StateStore.frequencies)).withColumn("segment", F.lit(""))
    return _write(partials.select("segment", "part", "kind", "n", "x", "m2", "sketch"), frequencies.select("segment", "column", "key", "n"), path)


# ---- finishing metrics ---------------------------------------------------------------------------

_VALUE = {"count": "n", "min": "x", "max": "x", "sketch": "sketch"}


def _value_of(part: str) -> str:
    kind = kind_of(part)
    if kind != "moments":
        return _VALUE[kind]
    return "CASE WHEN n > 0 THEN x END" if part.startswith("Mean:") else "CASE WHEN n > 0 THEN sqrt(m2 / n) END"


def metrics_of(
    stores: StateStore | Sequence[StateStore],
    schema: T.StructType,
    analyzers: Iterable[Analyzer],
    table_name: str = "",
    by_segment: bool = False,
) -> DataFrame:
    """Metrics of stored states together, as from a direct run over all their rows.

    ``schema`` is the table's. With ``by_segment`` there is one set of metrics for each segment, with its
    name in the column ``segment``.
    """
    stores = [stores] if isinstance(stores, StateStore) else list(stores)
    spark = stores[0].spark
    by = ["segment"] if by_segment else []
    shape = spark.createDataFrame([], schema)
    todo = list(enumerate(dedupe(analyzers)))
    if not todo:
        return empty_metrics(spark)
    partials, alias, scan_rows, by_column = _plan(shape, todo, shape.columns)
    partials.setdefault("rows", "count(1)")
    final = [c.format(table=lit(table_name)) for c in _FINAL_COLUMNS]
    folded = merged_partials(_all(stores, StateStore.partials), by)
    frames = []
    if scan_rows:
        pivot = [
            F.max(F.expr(f"CASE WHEN part = {lit(p)} THEN {_value_of(p)} END")).alias(alias.get(p, "_rows")) for p in partials
        ]
        wide = folded.groupBy(*by).agg(*pivot)
        frames.append(wide.selectExpr(*by, f"inline(array({', '.join(scan_rows)}))") if by else _inline(wide, scan_rows))
    if by_column:
        names = list(by_column)
        index = "CASE column " + " ".join(f"WHEN {lit(c)} THEN {j}" for j, c in enumerate(names)) + " END AS idx"
        counts = merged_frequencies(_all(stores, lambda s: s.frequencies(names)), by).selectExpr(*by, index, "n")
        stats = counts.groupBy(*by, "idx").agg(*(F.expr(e.rsplit(" AS ", 1)[0]).alias(e.rsplit(" AS ", 1)[1]) for e in FREQUENCY_STATS))
        pivot, rows = _pivot_rows(by_column)
        if by:  # a segment without any value has no frequencies
            stats = folded.select(*by).distinct().join(stats, by, "left")
        wide = stats.groupBy(*by).agg(*(F.expr(e.rsplit(" AS ", 1)[0]).alias(e.rsplit(" AS ", 1)[1]) for e in pivot))
        frames.append(wide.selectExpr(*by, f"inline(array({', '.join(rows)}))"))
    return reduce(DataFrame.unionByName, frames).selectExpr(*by, *final)

