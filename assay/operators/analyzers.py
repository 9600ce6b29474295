"""Metric analyzers and the runner that evaluates many of them in few passes.

An analyzer names one metric of a table or column (``Completeness(emp_no)``).
The runner never evaluates analyzers one by one; it plans them together:

* **scan analyzers** are finished from plain aggregates (counts, min, max,
  sums). All of them share ONE global aggregation: a single scan with
  partial aggregation per task and a one-row final merge. Shared partials
  (the row count, a column's non-null count) are computed once.
* **frequency analyzers** (distinctness, uniqueness, duplicate rows) need the
  count of every value of a column. Each column gets one
  ``GROUP BY value`` (map-side combined, so a hot value costs one row per
  map task, not one per occurrence); all analyzers on the same column share
  it, and the value counts of all columns are summarised by one shared
  ``GROUP BY idx``.

The result is a long-form *metrics frame*: one row per analyzer, a few dozen
rows per table, so only metrics - never data - reach the driver.

Expressions are written as Spark SQL text and the whole plan of a table goes
to Spark as one ``spark.sql`` statement (with the DataFrame bound as a
relation): the logical plan is the same as with Column objects, but building
it costs a handful of JVM calls instead of thousands. ``analyzer_plans``
splits very wide tables into plans of bounded width.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import ClassVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.functions.sql import RELATION, group_key, ident, lit, metric_value, over, ratio

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("entity", T.StringType()),
        T.StructField("instance", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("analyzer", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("metric_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

Partials = Callable[[str], str]  # partial key -> SQL reference to its aggregated value


@dataclass(frozen=True)
class Analyzer:
    """Base analyzer. ``column=None`` means a table-level metric."""

    column: str | None = None

    metric: ClassVar[str] = ""
    frequency: ClassVar[bool] = False

    @property
    def instance(self) -> str:
        return "*" if self.column is None else self.column

    @property
    def entity(self) -> str:
        return "Dataset" if self.instance == "*" else "Column"

    @property
    def name(self) -> str:
        return f"{self.metric}({'' if self.column is None else self.column})"

    @property
    def key(self) -> tuple[str, str]:
        return (self.metric, self.instance)

    @property
    def required_column(self) -> str | None:
        """The input column this analyzer reads (None for table-level ones)."""
        return None if self.column in (None, "*") else self.column

    def problem(self, df: DataFrame) -> str | None:
        """Why this metric cannot be computed on ``df`` (decided from its schema, no job), or None."""
        c = self.required_column
        if c is not None and c not in df.columns:
            return f"Input data does not include column {c}!"
        return None

    # scan analyzers: named partial aggregates (SQL text or Column) + the finishing SQL
    def partials(self, columns: Sequence[str]) -> dict[str, str | Column]:
        return {}

    def finish(self, p: Partials, columns: Sequence[str]) -> str:
        raise NotImplementedError

    # frequency analyzers: finish from the stats of the column's frequency table
    def finish_frequency(self, s: Partials) -> str:
        raise NotImplementedError


_ROWS = "rows"


def _rows() -> dict[str, str]:
    return {_ROWS: "count(1)"}


@dataclass(frozen=True)
class Size(Analyzer):
    """Number of rows."""

    metric: ClassVar[str] = "Size"

    def partials(self, columns):
        return _rows()

    def finish(self, p, columns):
        return f"CAST({p(_ROWS)} AS DOUBLE)"


@dataclass(frozen=True)
class Completeness(Analyzer):
    """Non-null share of a column; ``Completeness("*")`` = non-null cells / (rows x columns)."""

    metric: ClassVar[str] = "Completeness"

    def _targets(self, columns):
        return list(columns) if self.column == "*" else [self.column]

    def partials(self, columns):
        out = _rows()
        for c in self._targets(columns):
            out[f"nonnull:{c}"] = f"count({ident(c)})"
        return out

    def finish(self, p, columns):
        cells = [p(f"nonnull:{c}") for c in self._targets(columns)]
        if not cells:
            return "CAST(NULL AS DOUBLE)"
        return ratio(" + ".join(cells), f"{p(_ROWS)} * {len(cells)}")


def _unresolved(df: DataFrame, expression: str) -> str | None:
    """The analysis error of a SQL expression on ``df``'s schema, if it has one."""
    try:
        df.limit(0).selectExpr(expression)
    except Exception as e:  # noqa: BLE001 - parse and analysis errors come in several classes
        return str(e).strip().splitlines()[0]
    return None


def _stat(name: str, sql: Callable[[str], str], doc: str = "", needs: type = T.NumericType):
    """A scan analyzer over one column of type ``needs``: ``sql(column)`` is the aggregate, the value its double."""

    @dataclass(frozen=True)
    class _A(Analyzer):
        metric: ClassVar[str] = name

        def problem(self, df):
            missing = super(_A, self).problem(df)
            if missing:
                return missing
            found = df.schema[self.column].dataType
            if not isinstance(found, needs):
                return f"Expected type of column {self.column} to be {needs.__name__}, but found {found.simpleString()}"
            return None

        def partials(self, columns):
            return {f"{name}:{self.column}": sql(ident(self.column))}

        def finish(self, p, columns):
            return metric_value(p(f"{name}:{self.column}"))

    _A.__name__ = _A.__qualname__ = name
    _A.__doc__ = doc or name
    return _A


Minimum = _stat("Minimum", lambda c: f"min({c})")
Maximum = _stat("Maximum", lambda c: f"max({c})")
Mean = _stat("Mean", lambda c: f"avg(CAST({c} AS DOUBLE))")
StandardDeviation = _stat(
    "StandardDeviation", lambda c: f"stddev_pop(CAST({c} AS DOUBLE))", "Population standard deviation."
)
MinLength = _stat("MinLength", lambda c: f"min(char_length({c}))", "Shortest string length; nulls ignored.", T.StringType)
MaxLength = _stat("MaxLength", lambda c: f"max(char_length({c}))", "Longest string length; nulls ignored.", T.StringType)


@dataclass(frozen=True)
class Compliance(Analyzer):
    """Share of ALL rows for which ``predicate`` is true; a null predicate counts as false.

    ``column`` holds the label (the constraint's description); ``predicate``
    is Spark SQL text, a Column, or a zero-argument function building the
    Column (so rules can be declared before a session exists). The metric is
    keyed on label and predicate, so rules that share a name stay apart.
    """

    predicate: str | Column | Callable[[], Column] | None = field(default=None, compare=False, hash=False)
    predicate_key: str = ""

    metric: ClassVar[str] = "Compliance"

    @staticmethod
    def of(label: str, predicate, key: str | None = None) -> Compliance:
        return Compliance(label, predicate=predicate, predicate_key=key or str(predicate))

    @property
    def required_column(self) -> str | None:
        return None  # ``column`` is a label here

    @property
    def instance(self) -> str:
        return f"{self.column}|{self.predicate_key}"

    @property
    def entity(self) -> str:
        return "Dataset"

    def problem(self, df):
        return _unresolved(df, f"({self.predicate}) AS p") if isinstance(self.predicate, str) else None

    @property
    def _pkey(self) -> str:
        return f"compliant:{self.predicate_key}"

    def partials(self, columns):
        p = self.predicate
        if isinstance(p, str):
            agg: str | Column = f"count_if(coalesce({p}, false))"
        else:
            pred = p if isinstance(p, Column) else p()
            agg = F.count_if(F.coalesce(pred, F.lit(False)))
        return {**_rows(), self._pkey: agg}

    def finish(self, p, columns):
        return ratio(p(self._pkey), p(_ROWS))


@dataclass(frozen=True)
class MissingCount(Analyzer):
    """Number of null cells of a column (a count, for expectations)."""

    metric: ClassVar[str] = "MissingCount"

    def partials(self, columns):
        return {**_rows(), f"nonnull:{self.column}": f"count({ident(self.column)})"}

    def finish(self, p, columns):
        return f"CAST({p(_ROWS)} - {p(f'nonnull:{self.column}')} AS DOUBLE)"


@dataclass(frozen=True)
class UnexpectedCount(Analyzer):
    """Non-null rows of ``column`` for which the SQL ``condition`` holds.

    ``needs`` is ``"number"`` or ``"text"`` where the condition makes sense for such columns only.
    """

    condition: str = ""
    needs: str = field(default="", compare=False, hash=False)

    metric: ClassVar[str] = "UnexpectedCount"

    @property
    def instance(self) -> str:
        return f"{self.column}|{self.condition}"

    def problem(self, df):
        missing = super().problem(df)
        if missing:
            return missing
        found, needs = df.schema[self.column].dataType, {"number": T.NumericType, "text": T.StringType}.get(self.needs)
        if needs is not None and not isinstance(found, needs):
            return f"Expected type of column {self.column} to be {needs.__name__}, but found {found.simpleString()}"
        return _unresolved(df, f"({self.condition}) AS p")

    def partials(self, columns):
        c = ident(self.column)
        return {f"unexpected:{self.instance}": f"count_if({c} IS NOT NULL AND ({self.condition}))"}

    def finish(self, p, columns):
        return f"CAST({p(f'unexpected:{self.instance}')} AS DOUBLE)"


# ---- sketched distinct counts (opt-in: no value is shuffled) ----------------------

#: Registers of a sketch are 2**LOG_REGISTERS (4 KB a column); estimates are off by less than
#: SKETCH_ERROR (relative, about three standard errors) with 99.7 percent confidence.
LOG_REGISTERS = 12
SKETCH_ERROR = 0.05


@dataclass(frozen=True)
class ApproxCountDistinct(Analyzer):
    """Estimated number of distinct non-null values, from a mergeable sketch in the shared scan; small counts are exact."""

    metric: ClassVar[str] = "ApproxCountDistinct"

    def partials(self, columns):
        return {f"sketch:{self.column}": f"hll_sketch_agg(CAST({ident(self.column)} AS STRING), {LOG_REGISTERS})"}

    def finish(self, p, columns):
        return f"CAST(hll_sketch_estimate({p(f'sketch:{self.column}')}) AS DOUBLE)"


@dataclass(frozen=True)
class ApproxDistinctness(ApproxCountDistinct):
    """Estimated share of distinct values among non-null rows."""

    metric: ClassVar[str] = "ApproxDistinctness"

    def partials(self, columns):
        return {**super().partials(columns), f"nonnull:{self.column}": f"count({ident(self.column)})"}

    def finish(self, p, columns):
        n = p(f"nonnull:{self.column}")
        return ratio(f"least({super().finish(p, columns)}, CAST({n} AS DOUBLE))", n)


# ---- frequency analyzers (share one groupBy(col).count() per column) -------


@dataclass(frozen=True)
class Distinctness(Analyzer):
    """Distinct non-null values / non-null rows."""

    metric: ClassVar[str] = "Distinctness"
    frequency: ClassVar[bool] = True

    def finish_frequency(self, s):
        return ratio(s("distinct_values"), s("nonnull_rows"))


@dataclass(frozen=True)
class Uniqueness(Analyzer):
    """Values occurring exactly once / non-null rows."""

    metric: ClassVar[str] = "Uniqueness"
    frequency: ClassVar[bool] = True

    def finish_frequency(self, s):
        return ratio(s("single_values"), s("nonnull_rows"))


@dataclass(frozen=True)
class CountDistinct(Analyzer):
    metric: ClassVar[str] = "CountDistinct"
    frequency: ClassVar[bool] = True

    def finish_frequency(self, s):
        return f"CAST({s('distinct_values')} AS DOUBLE)"


@dataclass(frozen=True)
class DuplicateRows(Analyzer):
    """Non-null rows whose value occurs more than once (a count, for expectations)."""

    metric: ClassVar[str] = "DuplicateRows"
    frequency: ClassVar[bool] = True

    def finish_frequency(self, s):
        return f"CAST({s('duplicate_rows')} AS DOUBLE)"


# ---- runner -------------------------------------------------------------------


def frequency_table(df: DataFrame, column: str) -> DataFrame:
    """``value, n`` for every non-null value of ``column`` (one shuffle, map-side combined).

    Wide values are represented by their digest (see :func:`assay.functions.sql.group_key`).
    """
    return (
        df.where(f"{ident(column)} IS NOT NULL")
        .selectExpr(f"{group_key(column, df.schema[column].dataType)} AS value")
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


FREQUENCY_STATS = (
    "count(1) AS distinct_values",
    "sum(n) AS nonnull_rows",
    "count_if(n = 1) AS single_values",
    "coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS duplicate_rows",
)


def frequency_stats(df: DataFrame, column: str) -> DataFrame:
    """One row: distinct values, non-null rows, values seen once, rows in repeated values.

    Each column gets its own narrow pass: a vectorized single-column read and
    a single-key hash aggregation. (Measured against exploding all columns
    into one typed ``(idx, value)`` shuffle: that plan moves the same bytes
    but costs ~2x the CPU on wide composite keys, see README.)
    """
    return frequency_table(df, column).selectExpr(*FREQUENCY_STATS)


def _metric_row(seq: int, a: Analyzer, value_sql: str, note: str | None = None) -> str:
    return (
        f"named_struct('seq', {seq}, 'entity', {lit(a.entity)}, 'instance', {lit(a.instance)}, "
        f"'metric', {lit(a.metric)}, 'analyzer', {lit(a.name)}, 'value', CAST({value_sql} AS DOUBLE), "
        f"'note', CAST({lit(note)} AS STRING))"
    )


def _inline(df: DataFrame, rows: list[str]) -> DataFrame:
    return df.selectExpr(f"inline(array({', '.join(rows)}))")


def dedupe(analyzers: Iterable[Analyzer]) -> list[Analyzer]:
    """Drop repeated analyzers (same type and parameters), keeping first positions."""
    return list(dict.fromkeys(analyzers))


def empty_metrics(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], METRICS_SCHEMA)


_FINAL_COLUMNS = (
    "{table} AS table_name",
    "seq",
    "entity",
    "instance",
    "metric",
    "analyzer",
    "value",
    "'DoubleMetric' AS metric_type",
    "CASE WHEN value IS NULL THEN 'Failure' ELSE 'Success' END AS status",
    "coalesce(note, CASE WHEN value IS NULL THEN concat('Empty state for analyzer ', analyzer, "
    "', all input values were NULL.') END) AS message",
)
_FINAL = ", ".join(_FINAL_COLUMNS)


def _plan(df: DataFrame, todo: list[tuple[int, Analyzer]], columns: Sequence[str]):
    """Split (seq, analyzer) pairs into the scan partials/rows and the per-column frequency rows.

    An analyzer that the input's schema rules out (missing column, wrong type,
    unresolvable predicate) yields a failed metric (null value with a message)
    instead of failing the whole table.
    """
    problems = {i: p for i, a in todo if (p := a.problem(df)) is not None}
    missing = [(i, a) for i, a in todo if i in problems]
    todo = [(i, a) for i, a in todo if i not in problems]
    scan = [(i, a) for i, a in todo if not a.frequency]
    partials: dict[str, str | Column] = {}
    for _, a in scan:
        for k, e in a.partials(columns).items():
            partials.setdefault(k, e)
    if missing and not partials:
        partials["rows"] = "count(1)"
    alias = {k: f"_p{j}" for j, k in enumerate(partials)}
    scan_rows = [_metric_row(i, a, a.finish(lambda k: alias[k], columns)) for i, a in scan]
    scan_rows += [
        _metric_row(i, a, "NULL", problems[i]) for i, a in missing
    ]
    by_column: dict[str, list[tuple[int, Analyzer]]] = {}
    for i, a in todo:
        if a.frequency:
            by_column.setdefault(a.column, []).append((i, a))
    return partials, alias, scan_rows, by_column


def run_analyzers(df: DataFrame, analyzers: Iterable[Analyzer], table_name: str = "") -> DataFrame:
    """Evaluate ``analyzers`` on ``df``; returns a lazy long-form metrics frame.

    ``seq`` is the analyzer's position in the (de-duplicated) input list, so
    callers can restore the requested order or split a combined run.

    When every expression is SQL text the whole plan - the shared scan
    aggregation, one frequency pass per column and their union - goes to
    Spark as ONE statement (``spark.sql`` with ``df`` bound as a relation);
    otherwise it is assembled with DataFrame calls. Both give the same plan.
    """
    return _run(df, list(enumerate(dedupe(analyzers))), table_name)


def analyzer_plans(
    df: DataFrame,
    analyzers: Iterable[Analyzer],
    table_name: str = "",
    max_columns: int = 32,
) -> list[DataFrame]:
    """The metrics of :func:`run_analyzers`, split into plans of bounded width.

    The first plan holds the shared scan aggregation (and the first columns'
    frequency passes); each further plan at most ``max_columns`` frequency
    passes. Adaptive execution re-plans a query after every finished stage,
    so one plan over hundreds of columns costs time quadratic in its width;
    bounded plans, run side by side (see ``assay.plans.parallel``), keep
    that constant per column. ``seq`` is the position in the analyzer list.
    """
    parts = plan_parts(df, list(enumerate(dedupe(analyzers))), max_columns)
    return [_run(df, part, table_name) for part in parts] or [empty_metrics(df.sparkSession)]


def plan_parts(
    df: DataFrame, todo: list[tuple[int, Analyzer]], max_columns: int = 32
) -> list[list[tuple[int, Analyzer]]]:
    """``(seq, analyzer)`` pairs of each bounded plan (see :func:`analyzer_plans`)."""
    all_columns = df.columns
    present = set(all_columns)
    scan = [(i, a) for i, a in todo if not a.frequency]
    # scan analyzers in groups of at most ~16 partial aggregates per column slot, so one
    # aggregation stays within codegen limits even for tables with thousands of columns
    scan_groups: list[list] = [[]]
    seen: set[str] = set()
    for i, a in scan:
        keys = set(a.partials(all_columns)) if a.required_column is None or a.required_column in present else set()
        if scan_groups[-1] and len(seen | keys) > max_columns * 16:
            scan_groups.append([])
            seen = set()
        scan_groups[-1].append((i, a))
        seen |= keys
    columns = list(dict.fromkeys(a.column for _, a in todo if a.frequency))
    chunks = [columns[j : j + max_columns] for j in range(0, len(columns), max_columns)] or [[]]
    plans = []
    for n in range(max(len(chunks), len(scan_groups))):
        members = set(chunks[n]) if n < len(chunks) else set()
        part = (scan_groups[n] if n < len(scan_groups) else []) + [
            (i, a) for i, a in todo if a.frequency and a.column in members
        ]
        if part:
            plans.append(part)
    return plans


def failed_metrics(spark: SparkSession, todo: list[tuple[int, Analyzer]], table_name: str, message: str) -> DataFrame:
    """Metric rows without a value for analyzers that could not be computed."""
    rows = [
        (table_name, i, a.entity, a.instance, a.metric, a.name, None, "DoubleMetric", "Failure", message)
        for i, a in todo
    ]
    return spark.createDataFrame(rows, METRICS_SCHEMA)


def run_part(df: DataFrame, todo: list[tuple[int, Analyzer]], table_name: str) -> DataFrame:
    """Lazy metrics of explicit ``(seq, analyzer)`` pairs."""
    return _run(df, todo, table_name)


def _run(df: DataFrame, todo: list[tuple[int, Analyzer]], table_name: str) -> DataFrame:
    columns = df.columns
    partials, alias, scan_rows, by_column = _plan(df, todo, columns)
    if not scan_rows and not by_column:
        return empty_metrics(df.sparkSession)
    final = _FINAL.format(table=lit(table_name))

    if all(isinstance(e, str) for e in partials.values()):
        parts = []
        if scan_rows:
            aggs = ", ".join(f"{e} AS {alias[k]}" for k, e in partials.items())
            parts.append(f"SELECT inline(array({', '.join(scan_rows)})) FROM (SELECT {aggs} FROM {RELATION})")
        if by_column:
            parts.append(_frequency_sql(df, by_column))
        body = "\nUNION ALL\n".join(parts)
        return over(df, f"SELECT {final} FROM ({body})")

    frames: list[DataFrame] = []
    if scan_rows:
        wide = df.agg(*[(F.expr(e) if isinstance(e, str) else e).alias(alias[k]) for k, e in partials.items()])
        frames.append(_inline(wide, scan_rows))
    for column, group in by_column.items():
        rows = [_metric_row(i, a, a.finish_frequency(lambda s: s)) for i, a in group]
        frames.append(_inline(frequency_stats(df, column), rows))
    return reduce(DataFrame.union, frames).selectExpr(*[c.format(table=lit(table_name)) for c in _FINAL_COLUMNS])


_STAT_DEFAULTS = {"distinct_values": "0", "single_values": "0", "duplicate_rows": "0"}


def _pivot_rows(by_column: dict[str, list[tuple[int, Analyzer]]]) -> tuple[list[str], list[str]]:
    """Pivot expressions (one row from per-column stats keyed by ``idx``) and the metric rows."""
    names = ["distinct_values", "nonnull_rows", "single_values", "duplicate_rows"]
    pivot = [f"max(CASE WHEN idx = {j} THEN {s} END) AS {s}_{j}" for j in range(len(by_column)) for s in names]
    rows = []
    for j, group in enumerate(by_column.values()):
        # a column without any non-null value has no statistics row: counts 0, ratios undefined
        def stat(s, j=j):
            return f"coalesce({s}_{j}, {_STAT_DEFAULTS[s]})" if s in _STAT_DEFAULTS else f"{s}_{j}"

        rows += [_metric_row(i, a, a.finish_frequency(stat)) for i, a in group]
    return pivot, rows


def _frequency_sql(df: DataFrame, by_column: dict[str, list[tuple[int, Analyzer]]]) -> str:
    """Frequency metrics of several columns with one shared statistics aggregation.

    Each column keeps its own ``GROUP BY value`` (one single-key shuffle,
    map-side combined); only the value counts ``(idx, n)`` leave it. The
    counts of all columns are unioned and summarised by ONE ``GROUP BY idx``
    (partial aggregation inside the union stage), then pivoted to one row.
    Per column that is two stages instead of three.
    """
    freq = "\nUNION ALL\n".join(
        f"SELECT {j} AS idx, count(1) AS n FROM {RELATION} WHERE {ident(c)} IS NOT NULL "
        f"GROUP BY {group_key(c, df.schema[c].dataType)}"
        for j, c in enumerate(by_column)
    )
    stats = f"SELECT idx, {', '.join(FREQUENCY_STATS)} FROM ({freq}) GROUP BY idx"
    pivot, rows = _pivot_rows(by_column)
    return f"SELECT inline(array({', '.join(rows)})) FROM (SELECT {', '.join(pivot)} FROM ({stats}))"
