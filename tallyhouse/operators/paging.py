"""Sorted pages: allow-listed sort, stable tiebreak, total count, keyset."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

MAX_PAGE = 200
MAX_PER_CATEGORY = 50
DEFAULT_PERIOD_DAYS = 90


def clamp_page(limit: int, offset: int = 0) -> tuple[int, int]:
    return max(1, min(limit, MAX_PAGE)), max(0, offset)


def clamp_per_category(limit: int) -> int:
    return max(1, min(limit, MAX_PER_CATEGORY))


def resolve_period(
    start: date | str | None, end: date | str | None, today: date | None = None
) -> tuple[date, date]:
    """The given closed period, or the last 90 days if none is given.

    A period with one bound only, or one that ends before it starts, is an error.
    """
    start, end = (date.fromisoformat(d) if isinstance(d, str) else d for d in (start, end))
    if (start is None) != (end is None):
        raise ValueError("a period needs both its start and its end")
    if start is None or end is None:
        today = today or date.today()
        return today - timedelta(days=DEFAULT_PERIOD_DAYS), today
    if end < start:
        raise ValueError("the period ends before it starts")
    return start, end


def sort_columns(
    field: str, allowed: dict[str, str], descending: bool, tiebreak: str
) -> list[Column]:
    """Nulls last in both directions; the tiebreak keeps pages disjoint."""
    if field not in allowed:
        raise ValueError(f"unsupported sort field: {field!r}")
    column = F.col(allowed[field])
    first = column.desc_nulls_last() if descending else column.asc_nulls_last()
    return [first, F.col(tiebreak).asc()]


def page(
    df: DataFrame,
    order: list[Column],
    limit: int,
    offset: int,
    counted: DataFrame | None = None,
) -> DataFrame:
    """One page with ``total_count`` and ``has_next_page`` beside each row.

    The total is a scalar subquery over the same rows with every column but
    the needed ones pruned; a window over all rows would go through one task.
    ``counted`` may name a cheaper frame with as many rows as ``df``. The sort
    and limit plan as a distributed top-k of offset + limit rows, at every
    offset; for walking far down a list there are the keyset pages. A page past
    the end is empty, so it shows no total.
    """
    limit, offset = clamp_page(limit, offset)
    total = (df if counted is None else counted).agg(F.count(F.lit(1)).alias("n")).scalar()
    rows = df.orderBy(*order).offset(offset).limit(limit)
    return rows.withColumn("total_count", total).withColumn(
        "has_next_page", F.col("total_count") > F.lit(offset + limit)
    )


def before_cursor(df: DataFrame, moment: str, key: str, after: tuple[object, int]) -> DataFrame:
    """Rows strictly after the cursor in newest-first order: (moment, key) < cursor.

    The plain upper bound on ``moment`` is there for the scan: it reaches the
    Parquet filters, and the month predicate prunes partitions.
    """
    at, last_id = F.lit(after[0]).cast("timestamp"), F.lit(after[1])
    kept = df.filter(F.col(moment) <= at).filter(
        (F.col(moment) < at) | ((F.col(moment) == at) & (F.col(key) < last_id))
    )
    if "month" in df.columns:
        kept = kept.filter(F.col("month") <= F.date_format(at, "yyyy-MM"))
    return kept
