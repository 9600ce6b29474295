"""Value-set discovery: which columns draw their values from a small set, and from which one.

Two passes. The first keeps a bounded, mergeable summary: every value falls into one of ``BUCKETS``
hash buckets, and only the buckets' counts are kept. A value that makes up ``least_share`` of a column's
values puts its whole bucket above that share, so no frequent value is lost, and at most 1 / ``least_share``
buckets of a column can be that heavy. The second pass counts exactly, and only values in heavy buckets: a
column of a billion different values shuffles the few of them that share a bucket with a frequent one, or
none. Wide values are counted by their digest, and only the values of frequent digests are ever read.

A column gets an in-set rule if its frequent values are at most ``max_values`` and cover at least
``coverage`` of its values; the rule is strict if they cover all of them, and otherwise holds ``mostly`` -
rounded down, so that the table it comes from passes.

Edge cases: nulls are no values; an empty column has no domain; ties are ordered by value; NaN is a value;
structs and maps are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.functions.sql import ident, is_digested, lit
from assay.operators import expectations as X
from assay.operators.states import state_key
from assay.session import materialize

BUCKETS = 4096
LEAST_SHARE = 0.01
COVERAGE = 0.95
MAX_VALUES = 20

DOMAINS = "table_name string, column string, rank int, value string, n long, share double, coverage double, values int, proposed boolean, mostly double"


def _bucket(column: str, t: T.DataType) -> str:
    return f"pmod(xxhash64({state_key(column, t)}), {BUCKETS})"


def heavy_buckets(df: DataFrame, columns: Sequence[str], least_share: float = LEAST_SHARE) -> DataFrame:
    """column, bucket, total: the buckets that may hold a frequent value (at most 1 / least_share for each column)."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    counts = [
        df.where(f"{ident(c)} IS NOT NULL").selectExpr(f"{_bucket(c, kinds[c])} AS bucket").groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n")).selectExpr(f"{lit(c)} AS column", "bucket", "n")
        for c in columns
    ]
    every = reduce(DataFrame.unionByName, counts)
    total = every.groupBy("column").agg(F.sum("n").alias("total"))
    return every.join(F.broadcast(total), "column").where(F.col("n") >= F.lit(least_share) * F.col("total")).select("column", "bucket", "total")


def frequent_values(df: DataFrame, columns: Sequence[str] | None = None, least_share: float = LEAST_SHARE) -> DataFrame:
    """column, value, n, total: every value that makes up at least ``least_share`` of its column's values, with its exact count."""
    kinds = {f.name: f.dataType for f in df.schema.fields if not isinstance(f.dataType, (T.StructType, T.MapType, T.VariantType))}
    columns = [c for c in (columns or df.columns) if c in kinds]
    none = df.sparkSession.createDataFrame([], "column string, value string, n long, total long")
    if not columns:
        return none
    heavy = materialize(heavy_buckets(df, columns, least_share))  # at most 1 / least_share rows for each column
    parts = []
    for c in columns:
        mine = F.broadcast(heavy.where(F.col("column") == c).select("bucket", "total"))
        keyed = df.where(f"{ident(c)} IS NOT NULL").selectExpr(f"{state_key(c, kinds[c])} AS key", f"{_bucket(c, kinds[c])} AS bucket", f"{ident(c)} AS v")
        counted = keyed.join(mine, "bucket").groupBy("key", "total").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= F.lit(least_share) * F.col("total"))
        if is_digested(kinds[c]):
            # at most 1 / least_share digests: a bounded broadcast, one value of each is kept map-side
            few = F.broadcast(counted)
            shown = keyed.join(few, "key").groupBy("key", "n", "total").agg(F.first("v").cast("string").alias("value"))
        else:
            shown = counted.selectExpr("CAST(key AS STRING) AS value", "n", "total")
        parts.append(shown.selectExpr(f"{lit(c)} AS column", "value", "n", "total"))
    return reduce(DataFrame.unionByName, parts, none)


def discover_domains(
    df: DataFrame,
    table_name: str = "",
    columns: Sequence[str] | None = None,
    least_share: float = LEAST_SHARE,
    coverage: float = COVERAGE,
    max_values: int = MAX_VALUES,
) -> DataFrame:
    """Frequent values of every column, most frequent first, with what they cover and whether they make a rule (``DOMAINS``)."""
    found = frequent_values(df, columns, least_share)
    column = found.groupBy("column").agg((F.sum("n") / F.max("total")).alias("coverage"), F.count(F.lit(1)).cast("int").alias("values"))
    # a few rows a column: bounded
    rows = found.join(F.broadcast(column), "column")
    rank = "row_number() OVER (PARTITION BY column ORDER BY n DESC, value)"
    proposed = f"values <= {max_values} AND coverage >= {coverage!r}D"
    return rows.selectExpr(
        f"{lit(table_name)} AS table_name", "column", f"CAST({rank} AS INT) AS rank", "value", "n", "n / total AS share", "coverage", "values",
        f"{proposed} AS proposed", f"CASE WHEN {proposed} AND coverage < 1 THEN floor(coverage * 10000) / 10000 END AS mostly",
    )


def domains_to_expectations(rows: Iterable, schema: T.StructType) -> list[X.Expectation]:
    """In-set rules of collected ``discover_domains`` rows, by column in the table's order."""
    values: dict[str, list] = {}
    mostly: dict[str, float | None] = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        if r["proposed"]:
            values.setdefault(r["column"], []).append(r["value"])
            mostly[r["column"]] = r["mostly"]

    def typed(v: str, t: T.DataType):
        if isinstance(t, T.IntegralType):
            return int(v)
        if isinstance(t, (T.FloatType, T.DoubleType)):
            return float(v)
        return v == "true" if isinstance(t, T.BooleanType) else v

    return [
        X.expect_column_values_to_be_in_set(f.name, [typed(v, f.dataType) for v in values[f.name]], mostly=mostly[f.name])
        for f in schema.fields
        if f.name in values and not (isinstance(f.dataType, (T.FloatType, T.DoubleType)) and any(math.isnan(float(v)) for v in values[f.name]))
    ]
