"""US federal holidays as one CASE expression over a date column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

MONDAY, THURSDAY = 1, 4

# Fixed values: (name, month, first day, last day, ISO weekday or None). A
# floating holiday is a weekday inside the day window it can fall in.
HOLIDAYS = (
    ("New Year's Day", 1, 1, 1, None),
    ("Martin Luther King Jr. Day", 1, 15, 21, MONDAY),
    ("Presidents Day", 2, 15, 21, MONDAY),
    ("Memorial Day", 5, 25, 31, MONDAY),
    ("Juneteenth", 6, 19, 19, None),
    ("Independence Day", 7, 4, 4, None),
    ("Labor Day", 9, 1, 7, MONDAY),
    ("Columbus Day", 10, 8, 14, MONDAY),
    ("Veterans Day", 11, 11, 11, None),
    ("Thanksgiving Day", 11, 22, 28, THURSDAY),
    ("Christmas Day", 12, 25, 25, None),
)


def iso_weekday(day: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(day) + 1


def holiday_name(day: Column) -> Column:
    def matches(month: int, first: int, last: int, weekday: int | None) -> Column:
        hit = (F.month(day) == month) & F.dayofmonth(day).between(first, last)
        return hit if weekday is None else hit & (iso_weekday(day) == weekday)

    name, *window = HOLIDAYS[0]
    return reduce(
        lambda case, row: case.when(matches(*row[1:]), F.lit(row[0])),
        HOLIDAYS[1:],
        F.when(matches(*window), F.lit(name)),
    )
