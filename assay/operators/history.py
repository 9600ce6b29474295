"""Run history of metrics, and each run's deviation from its own past.

``append_history`` adds a run's metrics to a Parquet history, one folder a run; repeating a run
replaces that run alone. ``deviations`` compares every metric with the ``window`` runs before it:
the middle of the past is its median, its spread the median absolute deviation (scaled to a normal
distribution's), so earlier outliers neither hide new ones nor raise false alarms, and no limits have
to be set by hand. A ``phase`` (a SQL expression on ``run``, such as the day of the week) compares a
run only with earlier runs of the same phase, for metrics with a season.

A series - one metric of one column of one table - has one number a run, so the windows hold numbers
only: at most ``window`` for each row, whatever the size of the tables behind them.

Status: ``missing`` if the metric has no value in that run, ``new`` while there are fewer than
``least`` earlier values, ``anomaly`` if the value is more than ``limit`` spreads from the median, else
``ok``. Where the past does not vary, the least spread (``flat`` of the median's size) decides. Missing
values are no part of the past. Runs are ordered by their name (dates, or numbers of equal length).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assay.operators.analyzers import METRICS_SCHEMA

SERIES = ["table_name", "metric", "instance"]
#: A normal distribution's standard deviation in median absolute deviations.
NORMAL = 1.4826


def append_history(metrics: DataFrame, path: str) -> None:
    """Add metrics (with a ``run`` column) to the history in ``path``; runs that are there already are replaced."""
    (
        metrics.select("run", *METRICS_SCHEMA.names).repartition("run").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)
    )


def read_history(spark: SparkSession, path: str) -> DataFrame:
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in METRICS_SCHEMA.fields)
    return spark.read.schema(f"{fields}, run string").parquet(path)


def _median(array: str) -> str:
    """Median of a sorted array (null if it is empty)."""
    n = f"size({array})"
    return f"try_divide(get({array}, CAST(({n} - 1) DIV 2 AS INT)) + get({array}, CAST({n} DIV 2 AS INT)), 2D)"


def deviations(
    history: DataFrame,
    window: int = 14,
    limit: float = 4.0,
    least: int = 5,
    phase: str = "0",
    flat: float = 1e-3,
) -> DataFrame:
    """Every run of every series with ``expected``, ``spread``, ``score`` (spreads from the median) and ``status``."""
    rows = history.select(*SERIES, "run", "value").withColumn("_phase", F.expr(phase))
    past = Window.partitionBy(*SERIES, "_phase").orderBy("run").rowsBetween(-window, -1)
    seen = rows.withColumn("_past", F.array_sort(F.collect_list("value").over(past)))  # nulls are not collected
    seen = seen.withColumn("expected", F.expr(_median("_past")))
    seen = seen.withColumn("_off", F.expr("array_sort(transform(_past, x -> abs(x - expected)))"))
    spread = f"greatest({NORMAL}D * {_median('_off')}, {flat!r}D * abs(expected))"
    seen = seen.withColumn("spread", F.expr(spread))
    seen = seen.withColumn("score", F.expr("CASE WHEN value = expected THEN 0D ELSE coalesce(try_divide(abs(value - expected), spread), if(value IS NULL OR expected IS NULL, NULL, CAST('Infinity' AS DOUBLE))) END"))
    status = f"CASE WHEN value IS NULL THEN 'missing' WHEN size(_past) < {least} THEN 'new' WHEN score > {limit!r}D THEN 'anomaly' ELSE 'ok' END"
    return seen.select(*SERIES, "run", "value", F.size("_past").alias("earlier"), "expected", "spread", "score", F.expr(status).alias("status"))
