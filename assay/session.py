"""Session helpers: a tuned local session for tests/bench, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpointed results once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench (a cluster brings its own settings)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("assay")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
    )
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Uses the cluster's ``spark.checkpoint.dir`` when set (it must be shared
    storage on a cluster); only when nothing is configured - local tests - a
    fresh temporary folder is used.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. Spark Connect: the server manages checkpoints
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set: point it at shared storage") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: point it at shared storage (e.g. an HDFS or object-store path)"
            )
        configured = tempfile.mkdtemp(prefix="assay-ckpt-")  # local mode only (tests)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, on whatever file system it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stage_as_parquet(df: DataFrame, name: str = "staged", staged: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to Parquet under the checkpoint folder and read it back.

    Row-oriented sources (CSV, JSON) are parsed in full on every scan; metric
    passes read one column each, so staging to a columnar copy first turns
    K full parses into one parse plus K pruned column reads. It also cuts the
    lineage, so a lost executor never re-parses the source. ``staged`` collects
    the folders, for :func:`remove` when they are no longer read.
    """
    base = ensure_checkpoint_dir(df.sparkSession)
    path = os.path.join(base, "assay-staged", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    if staged is not None:
        staged.append(path)
    return df.sparkSession.read.parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint.

    Used for small results (metrics, rules) that several consumers read, so
    the data behind them is scanned once. The checkpoint lands in the shared
    ``spark.checkpoint.dir`` and survives lost executors.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
