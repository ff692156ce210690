"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# A relation is broadcast by hint only after it was counted and found at or
# below this many rows; above it the planner is left to choose a shuffle join.
BROADCAST_ROW_LIMIT = 100_000

# Scratch folder of local sessions without the setting.
_local_dir: str | None = None


def build_session(app_name: str = "tallyhouse") -> SparkSession:
    """Session for spark-submit; master and sizing come from the submit command."""
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def use_utc(spark: SparkSession) -> None:
    """All timestamps of the engine are UTC instants; calendar days are UTC days."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting (tests) falls back to a machine
    folder; a cluster without it is an error rather than a silent local path.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    global _local_dir
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="tallyhouse-")
    return _local_dir


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, never reused between runs."""
    return f"{shared_dir(spark)}/tallyhouse/{label}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete one scratch folder after use; other paths are refused."""
    if not path.startswith(f"{shared_dir(spark)}/tallyhouse/"):
        raise ValueError(f"not a scratch path: {path}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def broadcast_if_small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Broadcast hint behind a size check.

    ``rows`` is the row count when the caller already knows it. At most
    ``BROADCAST_ROW_LIMIT + 1`` rows are looked at otherwise.
    """
    if rows is None:
        rows = df.limit(BROADCAST_ROW_LIMIT + 1).count()
    return F.broadcast(df) if rows <= BROADCAST_ROW_LIMIT else df
