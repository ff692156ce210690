"""Continuous load: new source files go through the same stages as a batch.

The stream's checkpoint remembers which files were read, which replaces the
watermark table for deciding what is new. ``foreachBatch`` runs at least once
per batch; the upsert is idempotent, and rejects, events and check results are
keyed by the batch's run id, so a repeated batch changes nothing.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tallyhouse.model import Entity
from tallyhouse.operators.validate import POSITION
from tallyhouse.plans import quality
from tallyhouse.plans.job import (
    RunReport,
    advance_watermarks,
    check,
    counts_of,
    read_watermark,
    transform,
    utc_now,
)
from tallyhouse.plans.load import EntityReport, load_entity
from tallyhouse.sources import csv_source
from tallyhouse.sources.ledger import FAILED, SUCCEEDED, RunLedger
from tallyhouse.sources.warehouse import Warehouse


RUN_BASE = "_run_base"


def csv_stream(
    spark: SparkSession, entity: Entity, folder: str, multi_line: bool = True
) -> DataFrame:
    """CSV files of one entity as they arrive in a folder.

    The column order is taken from the files present at the start; a file whose
    header differs stops the stream instead of being misread. Records may span
    lines, so a file is one task, unless the caller knows that none does.
    """
    columns = csv_source.header(spark, folder)
    csv_source.check_header(entity, columns)
    text = StructType([StructField(c, StringType()) for c in columns])
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    return (
        spark.readStream.schema(text)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(folder)
        .select(*entity.source_columns, position.alias(POSITION))
    )


def run_base(spark: SparkSession, checkpoint: str) -> int:
    """Run id of a stream's first batch, kept in its checkpoint folder.

    A restart goes on with the same ids, so a repeated batch replaces its own
    rejects; another stream, or a fresh checkpoint, gets ids of its own.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/{RUN_BASE}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        spark.createDataFrame([(time.time_ns() // 1000,)], "run_id bigint").coalesce(1).write.json(path.toString())
    return spark.read.schema("run_id bigint").json(path.toString()).first().run_id


def positioned(batch: DataFrame) -> DataFrame:
    """Complete the position with the row number, which only a batch can give."""
    known = [F.col(f"{POSITION}.*")] if POSITION in batch.columns else []
    named = batch.select("*", *known, F.monotonically_increasing_id().alias("row"))
    parts = ["file", "block", "row"] if known else ["row"]
    return named.withColumn(POSITION, F.struct(*parts)).drop(*parts)


def start_load(
    warehouse: Warehouse,
    entity: Entity,
    rows: DataFrame,
    checkpoint: str,
    reject_dir: str | None = None,
    refresh: bool = False,
    on_report: Callable[[EntityReport], None] | None = None,
    skip_quality: bool = False,
    blocking: bool = True,
    workflow: str = "csv_stream",
) -> StreamingQuery:
    """Load everything available, then stop; start again for the next files.

    Every batch is a run of its own: its events are recorded, the checks run,
    and the watermark moves last, not at all if a blocking check failed (which
    also stops the query).

    Rows not after the stored watermark are loaded as well (the checkpoint
    already decides what is new) but counted as late. With ``refresh`` the
    rollups of the days in each batch are rebuilt.
    """

    first_run = run_base(warehouse.spark, checkpoint)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        now: datetime = utc_now()
        run = RunReport(first_run + batch_id)
        ledger = RunLedger(warehouse)
        run.attempt = ledger.begin(run.run_id, workflow, checkpoint)
        try:
            mark = read_watermark(warehouse, entity.name) if entity.watermark else None
            report = load_entity(
                warehouse,
                entity,
                positioned(batch),
                run.run_id,
                now,
                reject_dir=reject_dir,
                late_before=mark,
            )
            run.entities.append(report)
            if refresh and report.first_day is not None:
                transform(warehouse, report.first_day, report.last_day, now, scope_customers=True)
            if not skip_quality:
                run.blocking = quality.gate(check(warehouse, run.run_id, run.attempt, now), blocking)
            advance_watermarks(warehouse, run, now)
        except Exception as error:
            ledger.finish(run.run_id, FAILED, counts_of(run), f"{type(error).__name__}: {error}")
            raise
        ledger.finish(run.run_id, SUCCEEDED, counts_of(run))
        if on_report:
            on_report(report)

    return (
        rows.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def daily_counts(rows: DataFrame, moment: str, late_by: str = "1 day") -> DataFrame:
    """Rows per calendar day of a stream with bounded lateness."""
    return (
        rows.withWatermark(moment, late_by)
        .groupBy(F.window(moment, "1 day"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.to_date("window.start").alias("day"), "rows")
    )
