"""Watermark filters, refresh windows and scoped refreshes."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from tallyhouse.operators.rollups import in_days


def newer_than(rows: DataFrame, column: str, watermark: datetime | str | None) -> DataFrame:
    """Rows strictly after the watermark; all rows when there is none."""
    if watermark is None:
        return rows
    return rows.filter(F.col(column) > F.lit(watermark).cast("timestamp"))


def late_rows(rows: DataFrame, column: str, watermark: datetime | str | None) -> DataFrame:
    """Rows an incremental run skips because they are not after the watermark."""
    if watermark is None:
        return rows.limit(0)
    return rows.filter(F.col(column) <= F.lit(watermark).cast("timestamp"))


def next_watermark(rows: DataFrame, column: str) -> DataFrame:
    """Highest value over the clean rows, before reference checks."""
    return rows.agg(F.max(column).alias("watermark_ts"))


def advance(current: DataFrame, proposed: DataFrame) -> DataFrame:
    """(entity, watermark_ts) after the run; never earlier than before."""
    return (
        current.select("entity", "watermark_ts")
        .unionByName(proposed.select("entity", "watermark_ts"))
        .groupBy("entity")
        .agg(F.max("watermark_ts").alias("watermark_ts"))
    )


def day_span(rows: DataFrame, column: str) -> DataFrame:
    """First and last UTC day; both null for no rows."""
    return rows.agg(
        F.to_date(F.min(column)).alias("start"), F.to_date(F.max(column)).alias("end")
    )


def touched_customers(orders: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Distinct customers with an order in the closed day range."""
    return in_days(orders, "order_date", start, end).select("customer_id").distinct()


def orders_in_range(orders: DataFrame, start: date | str, end: date | str) -> DataFrame:
    return in_days(orders, "order_date", start, end).agg(F.count(F.lit(1)).alias("orders"))


def rebuild_days(
    stored: DataFrame, fresh: DataFrame, start: date | str, end: date | str
) -> DataFrame:
    """Rollup after a day-range rebuild: stored days outside the range, and the
    fresh rows inside it. Stale products of rebuilt days disappear."""
    if str(end) < str(start):
        raise ValueError(f"end {end} precedes start {start}")
    inside = F.col("sale_date").between(
        F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    )
    return stored.filter(~inside).unionByName(fresh.filter(inside))
