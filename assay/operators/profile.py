"""Column profiling: choose analyzers by column type and run them in one plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.functions.sql import ident
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
    run_analyzers,
)


def profile_analyzers(schema: T.StructType) -> list[Analyzer]:
    """Analyzers for a table, in report order.

    Table: Size, Completeness(*). Every column: Completeness, Distinctness.
    Numeric columns add Minimum, Maximum, Mean, StandardDeviation; string
    columns add MinLength, MaxLength, Uniqueness; other types get nothing more.
    """
    out: list[Analyzer] = [Size(), Completeness("*")]
    for f in schema.fields:
        out += [Completeness(f.name), Distinctness(f.name)]
        if isinstance(f.dataType, T.NumericType):
            out += [Minimum(f.name), Maximum(f.name), Mean(f.name), StandardDeviation(f.name)]
        elif isinstance(f.dataType, T.StringType):
            out += [MinLength(f.name), MaxLength(f.name), Uniqueness(f.name)]
    return out


#: ``metric_type`` of metrics that were measured on a sample.
SAMPLED = "SampledMetric"


def sample_rows(df: DataFrame, fraction: float | None, key: Sequence[str] = ()) -> DataFrame:
    """Rows whose key hashes below ``fraction``; ``None`` or ``>= 1`` keeps all rows.

    The choice depends on the ``key`` columns' values alone, so the sample is the same for
    any file layout, partitioning or engine. Used only when a caller asks for it.
    """
    if fraction is None or fraction >= 1.0:
        return df
    if not 0.0 < fraction:
        raise ValueError("sample fraction must be in (0, 1]")
    if not key:
        raise ValueError("a sample needs key columns")
    text = ", ".join(f"coalesce(CAST({ident(c)} AS STRING), '')" for c in key)
    # eight hex digits of the hash, compared as text
    return df.where(f"substr(md5(CAST(concat_ws('|', {text}) AS BINARY)), 1, 8) < '{int(fraction * 2**32):08x}'")


def profile(
    df: DataFrame,
    table_name: str = "",
    extra: list[Analyzer] | None = None,
    sample_fraction: float | None = None,
    sample_key: Sequence[str] = (),
) -> DataFrame:
    """Long-form metrics of ``df``: one row per metric (see ``METRICS_SCHEMA``).

    ``extra`` analyzers (e.g. those a set of checks needs) are evaluated in the
    same passes, so profiling and checking scan the data once; their rows
    follow the profile rows (``seq >= len(profile_analyzers(df.schema))``).

    With ``sample_fraction`` the metrics describe the sample (``Size`` is its row count)
    and carry ``metric_type`` ``SampledMetric``; no row-count, range or length rule is
    generated from them.
    """
    analyzers = profile_analyzers(df.schema) + list(extra or [])
    metrics = run_analyzers(sample_rows(df, sample_fraction, sample_key), analyzers, table_name)
    if sample_fraction is None or sample_fraction >= 1.0:
        return metrics
    return metrics.withColumn("metric_type", F.lit(SAMPLED))
