"""Result sinks and the metrics scan.

Flat result tables are written partitioned by ``table_name`` with dynamic
partition overwrite, so re-running one table replaces only its folder and
per-table runs can proceed independently. ``nested_report`` gives the
one-document-per-table view (``{table_name, <items>: [...]}``); each list
holds the rule or metric rows of one table, so it is bounded by the rule set.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.operators.analyzers import METRICS_SCHEMA

METRICS = "metrics"
CONSTRAINTS = "constraints"
CHECKS = "checks"
VERIFICATION = "verification"
EXPECTATIONS = "expectations"
COMBINED = "combined_expectations"
RULES = "rules"
SUMMARY = "summary"
REPORTS = "reports"


def write_result(df: DataFrame, output_dir: str, name: str, fmt: str = "json") -> str:
    path = os.path.join(output_dir, name)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("table_name")
        .format(fmt)
        .save(path)
    )
    return path


def nested_report(df: DataFrame, items: str, order: str = "seq", extra: dict | None = None) -> DataFrame:
    """One row per table with its rows as an ordered list of structs."""
    fields = [c for c in df.columns if c != "table_name"]
    nested = df.groupBy("table_name").agg(
        F.sort_array(F.collect_list(F.struct(F.col(order).alias("_order"), *fields))).alias("_items")
    )
    cols = [F.col("table_name"), F.current_timestamp().cast("string").alias("timestamp")]
    cols += [F.lit(v).alias(k) for k, v in (extra or {}).items()]
    cols.append(F.transform("_items", lambda s: s.dropFields("_order")).alias(items))
    return nested.select(*cols)


def write_report(df: DataFrame, output_dir: str, name: str, items: str, order: str = "seq", extra=None) -> str:
    """Nested JSON documents, one file per table, under ``<output>/reports/<name>/table_name=<t>/``."""
    doc = nested_report(df, items, order, extra)
    return write_result(one_file_per_table(doc), os.path.join(output_dir, REPORTS), name, "json")


def one_file_per_table(doc: DataFrame) -> DataFrame:
    """Put each table's rows in one task so a partitioned write emits one file per table.

    Only for report frames with one row (one document) per table.
    """
    return doc.repartition("table_name")


def read_metrics(spark: SparkSession, output_dir: str, table_name: str, fmt: str = "json") -> DataFrame | None:
    """Saved metrics of one table, or ``None`` when there are none or they cannot be read.

    The filter on the partition column prunes the scan to that table's folder.
    """
    path = os.path.join(output_dir, METRICS)
    try:
        reader = spark.read.format(fmt)
        if fmt == "json":
            reader = reader.schema(METRICS_SCHEMA)  # no inference pass over every table's files
        df = reader.load(path).where(F.col("table_name") == table_name)
        if df.isEmpty():
            return None
        return df
    except Exception:  # noqa: BLE001 - missing or unreadable metrics -> caller skips the table
        return None
