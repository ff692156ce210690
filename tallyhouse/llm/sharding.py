"""Two-pass external shuffle of a corpus into shards.

Pass one scatters rows into buckets small enough for one task by a seeded hash
of the id and the text. Pass two shuffles each bucket by Fisher-Yates with a
generator seeded by the bucket. Buckets follow each other in one global order,
place ``g`` goes to shard ``g % shards`` and slot ``g // shards``, so shards
differ by at most one row (law ``rows``) and slots have no gap.

Rows are ordered by id and checksum before the Fisher-Yates shuffle, so a task
that is repeated after a loss gives the same places. Null texts have size 1,
null ids and repeated rows are ordinary rows; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.llm.base import ship

SHARDS = 16
SEED = 2027
BUCKET_BYTES = 4 << 20
SPAN = 1024


def row_size(text_col: str) -> Column:
    return (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long")


def bucket_of(id_col: str, text_col: str, buckets: int, seed: int) -> Column:
    """Uniform bucket; the text is part of the key so that equal ids spread too."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), F.crc32(F.encode(text_col, "UTF-8"))), F.lit(buckets)).cast(
        "int"
    )


def bucket_count(docs: DataFrame, text_col: str, bucket_bytes: int) -> int:
    total = docs.agg(F.sum(row_size(text_col))).first()[0] or 0
    return max(1, math.ceil(total / bucket_bytes))


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A place for each of n rows."""
    return np.random.Generator(np.random.PCG64([seed, bucket])).permutation(n)


def _offsets(buckets: DataFrame) -> DataFrame:
    """Rows in all earlier buckets, summed within spans of buckets, then over the spans."""
    span = F.floor(F.col("bucket") / SPAN)
    sizes = buckets.groupBy("bucket").count().withColumn("span", span)
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    within = earlier.partitionBy("span").orderBy("bucket")
    spans = sizes.groupBy("span").agg(F.sum("count").alias("rows"))
    starts = spans.select("span", F.sum("rows").over(earlier.orderBy("span")).alias("start"))
    before = F.coalesce("start", F.lit(0)) + F.coalesce(F.sum("count").over(within), F.lit(0))
    return sizes.join(starts, "span").select("bucket", before.alias("offset"))


def shuffled(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All rows and columns of ``docs`` with ``shard_no``, ``shard_slot`` and ``shard_size``."""
    ship(docs.sparkSession)
    buckets = bucket_count(docs, text_col, bucket_bytes)
    key = bucket_of(id_col, text_col, buckets, seed)
    # Columns travel as struct fields, so clashing names do no harm.
    rows = docs.select(
        key.alias("bucket"),
        F.col(id_col).alias("id"),
        F.crc32(F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")).alias("crc"),
        row_size(text_col).alias("size"),
        F.struct(*docs.columns).alias("row"),
    )

    def shuffle(group: pa.Table, offset: pa.Table) -> pa.Table:
        by = [(c, "ascending") for c in ("id", "crc", "size")]
        places = np.empty(group.num_rows, np.int64)
        order = pc.sort_indices(group.select(["id", "crc", "size"]), by).to_numpy()
        places[order] = fisher_yates(group.num_rows, seed, group.column("bucket")[0].as_py())
        return group.append_column("g", pa.array(places + offset.column("offset")[0].as_py()))

    offsets = _offsets(docs.select(key.alias("bucket")))
    schema = rows.withColumn("g", F.lit(0).cast("long")).schema
    placed = rows.groupBy("bucket").cogroup(offsets.groupBy("bucket")).applyInArrow(shuffle, schema)
    return placed.select(
        "row.*",
        (F.col("g") % shards).cast("int").alias("shard_no"),
        F.floor(F.col("g") / shards).alias("shard_slot"),
        F.col("size").alias("shard_size"),
    )


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write the shuffled corpus: a folder per shard, its files in slot order."""
    out = shuffled(docs, **options)
    ordered = out.repartitionByRange("shard_no", "shard_slot").sortWithinPartitions("shard_no", "shard_slot")
    ordered.write.partitionBy("shard_no").parquet(path)
