"""Apply checks and expectation suites to every micro-batch of a stream.

The batch operators are reused unchanged inside ``foreachBatch``; each
batch's results are written under ``batch_id=<n>`` with dynamic partition
overwrite, so a micro-batch replayed after a failure replaces its own
results instead of duplicating them. The stream's checkpoint location
defaults to a folder under the session's shared ``spark.checkpoint.dir``.

Every batch is judged on its own: uniqueness and distinctness hold within a
batch, not over the stream.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assay.operators import expectations as X
from assay.operators.checks import Check, verify
from assay.session import ensure_checkpoint_dir


def _write(df: DataFrame, path: str, batch_id: int, fmt: str) -> None:
    (
        df.withColumn("batch_id", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .format(fmt)
        .save(path)
    )


def _start(stream: DataFrame, handler, checkpoint_location: str | None, available_now: bool) -> StreamingQuery:
    location = checkpoint_location or os.path.join(
        ensure_checkpoint_dir(stream.sparkSession), "assay-streams", uuid.uuid4().hex
    )
    writer = stream.writeStream.foreachBatch(handler).option("checkpointLocation", location)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def validate_stream(
    stream: DataFrame,
    rules: Sequence[X.Expectation],
    table_name: str,
    output_path: str,
    checkpoint_location: str | None = None,
    fmt: str = "json",
    available_now: bool = False,
) -> StreamingQuery:
    """Validate each micro-batch against ``rules``; one result row per rule and batch."""
    suite = f"{table_name}_suite"

    def handle(batch: DataFrame, batch_id: int) -> None:
        _write(X.validate(batch, rules, table_name, suite), output_path, batch_id, fmt)

    return _start(stream, handle, checkpoint_location, available_now)


def check_stream(
    stream: DataFrame,
    checks: Sequence[Check],
    table_name: str,
    output_path: str,
    checkpoint_location: str | None = None,
    fmt: str = "json",
    available_now: bool = False,
) -> StreamingQuery:
    """Run ``checks`` on each micro-batch; one constraint row per constraint and batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        _write(verify(batch, checks, table_name).constraints, output_path, batch_id, fmt)

    return _start(stream, handle, checkpoint_location, available_now)
