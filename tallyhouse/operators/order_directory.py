"""A stored order for pages: rows in their sort order, in ranges with known counts.

A page at a deep offset of a plain sort merges offset + limit rows in one task. Here
the order is laid down once: rows are partitioned by range over the sort columns and
sorted inside, and every row carries its range and its place in it. Counts per range,
added up, tell which ranges a page touches, so each page, the first or the last,
reads the ranges it overlaps and keeps just its own rows; the total is known as well.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tallyhouse.operators.paging import clamp_page
from tallyhouse.sources.warehouse import Warehouse

RANGES = "order_ranges"
ROWS_PER_RANGE = 100_000
# Up to ROWS_PER_RANGE rows each, a listing has no more ranges than this: each is a task,
# whose result goes to the driver.
RANGES_AT_MOST = 1_000
# Columns added to the stored rows.
RANGE, SLOT = "page_range", "page_slot"
_SLOT_BITS = 33


def build(
    warehouse: Warehouse,
    name: str,
    df: DataFrame,
    order: Sequence[Column],
    rows_per_range: int = ROWS_PER_RANGE,
) -> None:
    """Lay down ``df`` in ``order``, whose last column must make it total.

    Ranges have about ``rows_per_range`` rows; of a listing that would have more than
    ``RANGES_AT_MOST`` of them they grow with it, up to ``ROWS_PER_RANGE`` rows.

    Rows go to a folder of this version; the small table of ranges names the
    version and is switched last, so a reader sees one version or the other,
    and a build that died is a folder nobody reads. The version before is kept
    for readers that still use it, older ones are removed. A row's range and
    slot come from its task and place there (``monotonically_increasing_id``),
    with no second shuffle; a repeated task sorts the same rows the same way.
    """
    if {RANGE, SLOT} & set(df.columns):
        raise ValueError(f"the rows have a column {RANGE} or {SLOT} already")
    version = uuid.uuid4().hex
    rows = df.count()
    parts = max(1, -(-rows // max(rows_per_range, min(ROWS_PER_RANGE, -(-rows // RANGES_AT_MOST)))))
    place = F.monotonically_increasing_id()
    laid = (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_place", place)
        .withColumn(RANGE, F.shiftright("_place", _SLOT_BITS).cast("int"))
        .withColumn(SLOT, F.col("_place").bitwiseAND((1 << _SLOT_BITS) - 1))
        .drop("_place")
    )
    path = _path(warehouse, name, version)
    laid.sortWithinPartitions(RANGE, SLOT).write.partitionBy(RANGE).parquet(path)
    # Only the footers are read for these counts. As many rows as ranges.
    counts = _rows(warehouse, name, version, df).groupBy(F.col(RANGE).alias("page_range")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    before = Window.orderBy("page_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    ranges = counts.select(
        F.lit(name).alias("directory"),
        F.lit(version).alias("version"),
        "page_range",
        "rows",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first_row"),
        F.sum("rows").over(everything).alias("total"),
    )
    known = warehouse.read(RANGES)
    old = {r.version for r in known.filter(F.col("directory") == name).select("version").distinct().collect()}
    warehouse.replace(RANGES, known.filter(F.col("directory") != name).unionByName(ranges).coalesce(1))
    _remove_other(warehouse, name, old | {version})


def page(warehouse: Warehouse, name: str, like: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    """One page with ``total_count`` and ``has_next_page`` beside each row.

    ``like`` gives the columns of the listing. A page overlaps at most as many
    ranges as it has rows; these are all that the driver looks at. A page past
    the end, or of an empty listing, is empty.
    """
    limit, offset = clamp_page(limit, offset)
    ranges = warehouse.read(RANGES).filter(F.col("directory") == name)
    hit = ranges.filter(
        (F.col("first_row") < offset + limit) & (F.col("first_row") + F.col("rows") > offset)
    ).collect()
    if not hit:
        return (
            like.limit(0)
            .withColumn("total_count", F.lit(0).cast("bigint"))
            .withColumn("has_next_page", F.lit(False))
        )
    wanted = F.lit(False)
    for r in hit:
        slots = F.col(SLOT).between(offset - r.first_row, offset + limit - 1 - r.first_row)
        wanted = wanted | ((F.col(RANGE) == r.page_range) & slots)
    rows = _rows(warehouse, name, hit[0].version, like).filter(wanted)
    return (
        rows.orderBy(RANGE, SLOT)
        .drop(RANGE, SLOT)
        .withColumn("total_count", F.lit(hit[0].total))
        .withColumn("has_next_page", F.lit(hit[0].total > offset + limit))
    )


def _path(warehouse: Warehouse, name: str, version: str) -> str:
    return f"{warehouse.root}/order_directories/{name}/{version}"


def _rows(warehouse: Warehouse, name: str, version: str, like: DataFrame) -> DataFrame:
    schema = StructType([*like.schema.fields, StructField(SLOT, LongType()), StructField(RANGE, IntegerType())])
    return warehouse.spark.read.schema(schema).parquet(_path(warehouse, name, version))


def _remove_other(warehouse: Warehouse, name: str, kept: set[str]) -> None:
    """Remove the versions before the last one, and folders that a dead build left."""
    fs, folder = warehouse._folder(f"{warehouse.root}/order_directories/{name}")
    for status in fs.listStatus(folder):
        if status.getPath().getName() not in kept:
            fs.delete(status.getPath(), True)
