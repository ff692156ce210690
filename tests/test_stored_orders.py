"""Stored bitmaps of products and stored orders for pages."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import day_bitmaps, order_directory, paging
from tallyhouse.plans import reports
from tallyhouse.sources.warehouse import Warehouse

ROLLUP = (
    "sale_date date, product_id long, category_id long, units_sold long, net_revenue decimal(14,2), "
    "gross_revenue decimal(14,2), discount_total decimal(14,2), order_count int, month string"
)


def rollup(spark, rows):
    named = [(d, p, c, 1, "2.50", "3.00", "0.50", 1, f"{d:%Y-%m}") for d, p, c in rows]
    text = ROLLUP.replace("decimal(14,2)", "string")
    df = spark.createDataFrame(named, text)
    return df.select(*(F.col(f.name).cast(t).alias(f.name) for f, t in zip(df.schema, (c.strip().split(" ")[1] for c in ROLLUP.split(", ")))))


@pytest.mark.parametrize("granularity", reports.GRANULARITIES)
def test_bitmaps_equal_distinct(spark, granularity):
    """Ids on both sides of block borders, far ones, and one under two categories."""
    pick = random.Random(3)
    ids = [0, 1, 7, 32_767, 32_768, 32_769, 65_536, 65_537, 10**12, 10**12 + 1]
    days = [date(2026, 1, 1) + timedelta(days=n) for n in (0, 1, 6, 7, 31, 40, 95, 364, 365)]
    rows = [(d, p, 1 + p % 3) for d in days for p in pick.sample(ids, 5)] + [(days[0], 1, 9)]
    daily = rollup(spark, rows)
    stored = day_bitmaps.category_days(daily)
    closure = spark.createDataFrame([(1, 1), (2, 1), (3, 3)], "category_id long, root_category_id long")
    for more in ({}, {"closure": closure, "category_id": 1}):
        want = reports.sales_trends(daily, days[0], days[-1], granularity, **more)
        got = reports.sales_trends_stored(stored, days[0], days[-1], granularity, **more)
        assert got.select(want.columns).collect() == want.collect()


def test_bitmaps_of_nothing(spark):
    stored = day_bitmaps.category_days(rollup(spark, []))
    assert reports.sales_trends_stored(stored, "2026-01-01", "2026-02-01").isEmpty()
    with pytest.raises(ValueError):
        reports.sales_trends_stored(stored, "2026-01-01", "2026-02-01", "HOUR")


def test_bitmaps_take_the_room_of_their_ids(spark):
    """A bitmap is one number, so scattered ids need no 4 KB each and no sort by task."""
    day = date(2026, 1, 1)
    ids = [-65, -1, 0, 63, 64, 10**12, None]
    stored = day_bitmaps.category_days(rollup(spark, [(day, p, 1) for p in ids]))
    assert dict(stored.dtypes)["products"] == "bigint"
    plan = day_bitmaps.trend(stored, F.col("sale_date"))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    row = reports.sales_trends_stored(stored, day, day).first()
    assert (row.distinct_products, row.units_sold) == (6, 7)


def listing(spark, n):
    pick = random.Random(n)
    rows = [(i, pick.choice([None, 1.0, 2.0, 3.0]), f"r{i}") for i in range(n)]
    return spark.createDataFrame(rows, "id long, price double, name string")


@pytest.mark.parametrize("descending", [True, False])
def test_pages_equal_a_sort(spark, tmp_path, descending):
    """Nulls last, ties by id, every page of a listing whose keys are mostly equal."""
    warehouse = Warehouse(spark, str(tmp_path))
    df = listing(spark, 430)
    order = paging.sort_columns("P", {"P": "price"}, descending, "id")
    order_directory.build(warehouse, "by_price", df, order, rows_per_range=50)
    assert warehouse.read("order_ranges").count() > 4
    want = [r.id for r in df.orderBy(*order).collect()]
    for offset in (0, 49, 50, 199, 400, 429, 430, 10_000):
        got = order_directory.page(warehouse, "by_price", df, 60, offset).collect()
        assert [r.id for r in got] == want[offset : offset + 60]
        assert all(r.total_count == 430 and r.has_next_page == (offset + 60 < 430) for r in got)
    assert df.columns == ["id", "price", "name"]


def test_a_deep_page_reads_its_ranges_only(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    df = listing(spark, 1000)
    order_directory.build(warehouse, "by_id", df, [F.col("id")], rows_per_range=100)
    deep = order_directory.page(warehouse, "by_id", df, 10, 950)
    assert [r.id for r in deep.collect()] == list(range(950, 960))
    assert len(deep.inputFiles()) <= 12
    plan = deep._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "page_range" in plan and "Limit" not in plan


def test_ranges_grow_with_the_listing(spark, tmp_path, monkeypatch):
    """Small ranges of a large listing: no task and no result at the driver for each."""
    monkeypatch.setattr(order_directory, "RANGES_AT_MOST", 5, raising=False)
    warehouse = Warehouse(spark, str(tmp_path))
    df = listing(spark, 1000)
    order_directory.build(warehouse, "by_id", df, [F.col("id").desc()], rows_per_range=10)
    assert warehouse.read("order_ranges").count() <= 5
    got = order_directory.page(warehouse, "by_id", df, 60, 570).collect()
    assert [r.id for r in got] == list(range(429, 369, -1))


def test_directories_are_replaced_as_a_whole(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    order = [F.col("id")]
    for name, n in (("a", 30), ("b", 5), ("a", 12), ("a", 7)):
        order_directory.build(warehouse, name, listing(spark, n), order, rows_per_range=4)
    like = listing(spark, 1)
    assert [r.total_count for r in order_directory.page(warehouse, "a", like, 1).collect()] == [7]
    assert [r.id for r in order_directory.page(warehouse, "b", like, 9).collect()] == [0, 1, 2, 3, 4]
    assert len(list((tmp_path / "order_directories" / "a").iterdir())) == 2
    order_directory.build(warehouse, "a", like.limit(0), order)
    assert order_directory.page(warehouse, "a", like, 9).isEmpty()
    assert order_directory.page(warehouse, "unknown", like, 9).isEmpty()
    with pytest.raises(ValueError):
        order_directory.build(warehouse, "a", like.withColumn("page_slot", F.lit(1)), order)
