"""Sampled metrics with error bounds.

*Sampling by value* (``value_sampled_profile``). Distinctness and uniqueness depend on how often each
value occurs, so a sample of rows says little about them: repeated values look unique. Here a column
keeps all rows of the values whose hash is below the fraction. Repeats stay together, and each value is in
the sample with the same probability f, so (values in the sample) / f is an unbiased count of the table's
values, whatever their frequencies. All other metrics come exactly from the scan that is needed anyway;
what the sample saves is the shuffle, which carries f times the distinct values.

Bounds: a count of U values of which k were sampled satisfies ``|U f - k| <= z sqrt(U f (1 - f))`` with the
confidence of z; solved for U this is a score interval that is valid for k = 0, too. What was seen is
certain, so the lower bound is never less, and ratios stay within 0 and 1. Exact metrics have their value as
both bounds.

*Sampling by row* (``profile(sample_fraction=...)``). ``row_sample_bounds`` adds the interval of a share
(score interval) and of a mean and a deviation (normal approximation); extremes are bounded on the side that
a sample proves, and counts, distinctness and uniqueness are not estimated by a sample of rows at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.functions.sql import RELATION, group_key, ident, is_digested, lit, over
from assay.operators.analyzers import METRICS_SCHEMA, Distinctness, Uniqueness, run_analyzers
from assay.operators.profile import SAMPLED, profile_analyzers
from assay.operators.states import state_key

#: ``metric_type`` of metrics that were estimated from a sample of values.
VALUE_SAMPLED = "ValueSampledMetric"
#: 95 percent.
Z = 1.959964


def value_hash(name: str, t: T.DataType) -> str:
    """Eight hex digits of a value's hash, the same for equal values on any cluster."""
    key = state_key(name, t)
    return f"lower(substr(hex({key}), 1, 8))" if is_digested(t) else f"substr(sha2({key}, 256), 1, 8)"


def _bound(k: str, f: float, z: float, sign: str) -> str:
    """Count of values from the ``k`` sampled ones."""
    v = f"{z * z * (1 - f)!r}D"
    return f"(({k} + {v} / 2 {sign} sqrt({v} * {k} + {v} * {v} / 4)) / {f!r}D)"


def value_sampled_profile(df: DataFrame, table_name: str = "", fraction: float = 0.1, z: float = Z) -> DataFrame:
    """The profile of ``df`` with ``lower`` and ``upper``; frequency metrics from a sample of values."""
    if not 0.0 < fraction <= 1.0:
        raise ValueError("sample fraction must be in (0, 1]")
    analyzers = list(enumerate(profile_analyzers(df.schema)))
    columns = [a.column for _, a in analyzers if a.metric == Distinctness.metric]
    exact = run_analyzers(df, [a for _, a in analyzers if not a.frequency], table_name)
    place = {a.key: i for i, a in analyzers}
    placed = "CASE " + " ".join(f"WHEN metric = {lit(m)} AND instance = {lit(c)} THEN {i}" for (m, c), i in place.items()) + " END"
    exact = exact.withColumn("seq", F.expr(placed)).select(*METRICS_SCHEMA.names, F.col("value").alias("lower"), F.col("value").alias("upper"))
    if not columns:
        return exact
    least = f"{int(fraction * 2**32):08x}" if fraction < 1.0 else "g"  # beyond every hex digit
    kinds = {f.name: f.dataType for f in df.schema.fields}
    sampled = "\nUNION ALL\n".join(
        f"SELECT {j} AS idx, count(1) AS n FROM {RELATION} WHERE {ident(c)} IS NOT NULL AND {value_hash(c, kinds[c])} < '{least}' "
        f"GROUP BY {group_key(c, kinds[c])}"
        for j, c in enumerate(columns)
    )
    sizes = ", ".join(f"count({ident(c)}) AS n{j}" for j, c in enumerate(columns))
    rows = ", ".join(f"named_struct('idx', {j}, 'rows', n{j})" for j in range(len(columns)))
    counts = over(
        df,
        f"SELECT r.idx, r.rows, coalesce(s.distinct_values, 0) AS distinct_values, coalesce(s.single_values, 0) AS single_values "
        f"FROM (SELECT inline(array({rows})) FROM (SELECT {sizes} FROM {RELATION})) r LEFT JOIN "
        f"(SELECT idx, count(1) AS distinct_values, count_if(n = 1) AS single_values FROM ({sampled}) GROUP BY idx) s ON r.idx = s.idx",
    )
    exactly = fraction >= 1.0
    estimates = []
    for metric, k in ((Distinctness.metric, "distinct_values"), (Uniqueness.metric, "single_values")):
        value = f"least(1D, try_divide({k} / {fraction!r}D, CAST(rows AS DOUBLE)))"
        lower = f"least(1D, greatest(try_divide(CAST({k} AS DOUBLE), CAST(rows AS DOUBLE)), try_divide({_bound(k, fraction, z, '-')}, CAST(rows AS DOUBLE))))"
        upper = f"least(1D, try_divide({_bound(k, fraction, z, '+')}, CAST(rows AS DOUBLE)))"
        value, lower, upper = (f"CASE WHEN rows > 0 THEN {x} END" for x in (value, lower, upper))
        estimates.append(
            f"named_struct('metric', {lit(metric)}, 'value', {value}, 'lower', {value if exactly else lower}, 'upper', {value if exactly else upper})"
        )
    names = f"element_at(array({', '.join(lit(c) for c in columns)}), idx + 1)"
    found = counts.selectExpr(f"{names} AS instance", f"inline(array({', '.join(estimates)}))")
    # metrics that the profile does not have for a column's type go
    found = found.withColumn("seq", F.expr(placed)).where("seq IS NOT NULL").selectExpr(
        f"{lit(table_name)} AS table_name", "seq", "'Column' AS entity", "instance", "metric", "concat(metric, '(', instance, ')') AS analyzer",
        "value", f"{lit(VALUE_SAMPLED)} AS metric_type", "CASE WHEN value IS NULL THEN 'Failure' ELSE 'Success' END AS status",
        "CASE WHEN value IS NULL THEN concat('Empty state for analyzer ', metric, '(', instance, '), all input values were NULL.') END AS message",
        "lower", "upper",
    )
    return exact.unionByName(found)


def row_sample_bounds(metrics: DataFrame, z: float = Z) -> DataFrame:
    """Metrics of a sample of rows with ``lower`` and ``upper`` (null: a sample proves nothing on that side)."""
    m = F.col("metric")
    pick = lambda name: F.max(F.when(m == name, F.col("value")))
    size = metrics.groupBy("table_name").agg(F.max(F.when((m == "Size") & (F.col("instance") == "*"), F.col("value"))).alias("_n"))
    column = metrics.groupBy("table_name", "instance").agg(pick("Completeness").alias("_c"), pick("StandardDeviation").alias("_s"))
    # a few rows a column: bounded broadcasts
    rows = metrics.join(F.broadcast(size), "table_name", "left").join(F.broadcast(column), ["table_name", "instance"], "left")
    known = "(_n * _c)"
    half = f"({z!r}D * sqrt(value * (1 - value) / _n + {z * z!r}D / (4 * _n * _n)))"
    middle, whole = f"(value + {z * z!r}D / (2 * _n))", f"(1 + {z * z!r}D / _n)"
    cases = {
        "Completeness": (f"({middle} - {half}) / {whole}", f"({middle} + {half}) / {whole}"),
        "Mean": (f"value - {z!r}D * try_divide(_s, sqrt({known}))", f"value + {z!r}D * try_divide(_s, sqrt({known}))"),
        "StandardDeviation": (f"value - {z!r}D * try_divide(value, sqrt(2 * {known}))", f"value + {z!r}D * try_divide(value, sqrt(2 * {known}))"),
        "Minimum": ("CAST(NULL AS DOUBLE)", "value"),
        "MinLength": ("CAST(NULL AS DOUBLE)", "value"),
        "Maximum": ("value", "CAST(NULL AS DOUBLE)"),
        "MaxLength": ("value", "CAST(NULL AS DOUBLE)"),
    }
    side = lambda i: "CASE " + " ".join(f"WHEN metric = '{k}' AND _n > 0 THEN {v[i]}" for k, v in cases.items()) + " END"
    sampled = F.col("metric_type") == SAMPLED
    return rows.select(
        *[F.col(c) for c in METRICS_SCHEMA.names],
        F.when(sampled, F.expr(side(0))).otherwise(F.col("value")).alias("lower"),
        F.when(sampled, F.expr(side(1))).otherwise(F.col("value")).alias("upper"),
    )
