"""Calendar days of a stream in event time: closed once, late rows put aside.

A day is open until the watermark (the highest moment of earlier batches less the
allowed lateness) has reached its end. One stateful operator, keyed by day and a
hash shard of the row's key, keeps the keys of an open day, so a row sent again
counts once. When the day closes, its shards report their counts and their state
is dropped; a row for a closed day is late and keeps its source text. So a day
is reported once and never changes, and counted and late rows make up all rows
but the repeated ones.

Rows without a moment or a key are reported as ``invalid``, at once. State is
eight bytes per key of the open days; more ``shards`` make a day's pieces smaller,
so a day with a third of all rows still spreads. The number is part of the state:
a stream keeps the one it began with.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

CLOSED, LATE, INVALID = "closed", "late", "invalid"
DAY_MS = 86_400_000
NO_DAY = -(2**31)
NEVER = "2262-01-01 00:00:00"  # pandas has nothing beyond
# Marks a column as event time; the delay itself is that of withWatermark.
EVENT_TIME = {"spark.watermarkDelayMs": 0}
EVENTS = "day int, rows bigint, row string, fate string"


def _events(day: int, fate: str, rows: list[int], texts: list[str | None]) -> pd.DataFrame:
    return pd.DataFrame({"day": [day] * len(rows), "rows": rows, "row": texts, "fate": [fate] * len(rows)})


def _follow(key: tuple, chunks: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Rows of one shard of one day: kept while it is open, put aside afterwards."""
    day = int(key[0])
    end = (day + 1) * DAY_MS
    if day == NO_DAY:
        for chunk in chunks:
            yield _events(day, INVALID, [1] * len(chunk), chunk["row"].tolist())
        return
    kept = np.frombuffer(state.get[0], np.int64) if state.exists else np.zeros(0, np.int64)
    if not state.hasTimedOut and state.getCurrentWatermarkMs() < end:
        parts = [kept, *(chunk["key"].to_numpy(np.int64) for chunk in chunks)]
        state.update((np.unique(np.concatenate(parts)).tobytes(),))
        state.setTimeoutTimestamp(end - 1)  # fires once the watermark is beyond it
        return
    if not state.hasTimedOut:
        for chunk in chunks:
            yield _events(day, LATE, [1] * len(chunk), chunk["row"].tolist())
    if state.exists:
        state.remove()
        yield _events(day, CLOSED, [len(kept)], [None])


def day_events(rows: DataFrame, moment: str, key: str, late_by: str, shards: int = 16) -> DataFrame:
    """Closed days, late and invalid rows of a stream; ``key`` is a column of whole numbers.

    Spark drops rows whose event time is behind the watermark before an operator
    with timeouts sees them. So what goes in as event time is ``clock``, which is
    never behind; the watermark still comes from ``at``, and the operator itself
    decides by the day.
    """
    text = F.to_json(F.struct(*rows.columns))
    valid = F.col(moment).isNotNull() & F.col(key).isNotNull()
    prepared = rows.select(
        F.col(moment).cast("timestamp").alias("at"),
        F.when(valid, F.unix_date(F.to_date(moment))).otherwise(F.lit(NO_DAY)).alias("day"),
        F.coalesce(F.col(key).cast("bigint"), F.lit(0)).alias("key"),
        text.alias("row"),
        F.when(valid, F.xxhash64(F.col(key).cast("bigint"))).otherwise(F.xxhash64(text)).alias("hash"),
    ).withColumn("shard", F.pmod("hash", F.lit(shards)).cast("int"))
    return (
        prepared.withWatermark("at", late_by)
        .select("day", "shard", "key", "row", F.lit(NEVER).cast("timestamp").alias("clock", metadata=EVENT_TIME))
        .groupBy("day", "shard")
        .applyInPandasWithState(_follow, EVENTS, "keys binary", "append", GroupStateTimeout.EventTimeTimeout)
    )


def start(
    rows: DataFrame, out: str, checkpoint: str, moment: str, key: str, late_by: str = "1 day", shards: int = 16
) -> StreamingQuery:
    """Take in everything available, then stop; start again for the next files.

    Each batch writes a folder of its own, in one write; a repeated batch
    replaces what it wrote before.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("fate").parquet(f"{out}/batch={batch_id}")

    return (
        day_events(rows, moment, key, late_by, shards)
        .writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _read(spark: SparkSession, out: str, fate: str) -> DataFrame:
    # No batch has rows of every kind, and the first may have none at all.
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/batch=*/fate={fate}")
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folder)
    if not found:
        return spark.createDataFrame([], "day int, rows bigint, row string")
    return spark.read.schema("day int, rows bigint, row string").parquet(f"{out}/batch=*/fate={fate}")


def _day() -> Column:
    return F.when(F.col("day") != NO_DAY, F.date_from_unix_date("day")).alias("day")


def closed_days(spark: SparkSession, out: str) -> DataFrame:
    """Days that can't change any more, with their distinct keys."""
    return _read(spark, out, CLOSED).groupBy("day").agg(F.sum("rows").alias("rows")).select(_day(), "rows")


def late_rows(spark: SparkSession, out: str) -> DataFrame:
    """Rows that came after their day had closed, with their source text."""
    return _read(spark, out, LATE).select(_day(), "row")


def invalid_rows(spark: SparkSession, out: str) -> DataFrame:
    """Rows without a moment or a key, with their source text."""
    return _read(spark, out, INVALID).select("row")
