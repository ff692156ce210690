"""Boolean column expressions used by rules, audits and rollups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Order life cycle, payment methods and the e-mail shape.
ORDER_STATUSES = (
    "Pending",
    "Processing",
    "Shipped",
    "In Transit",
    "Delivered",
    "Cancelled",
    "Returned",
)
PAYMENT_METHODS = (
    "Credit Card",
    "PayPal",
    "Apple Pay",
    "Google Pay",
    "Gift Card",
    "Bank Transfer",
)
NO_REVENUE_STATUSES = ("Cancelled", "Returned")
EMAIL_SHAPE = r"^[^@\s]+@[^@\s]+\.[^@\s]{2,}$"


def revenue_bearing(status: Column) -> Column:
    return ~status.isin(*NO_REVENUE_STATUSES)


def not_blank(text: Column) -> Column:
    return text.isNotNull() & (F.length(text) > 0)


def positive(value: Column) -> Column:
    return value.isNotNull() & (value > 0)


def not_negative(value: Column) -> Column:
    return value.isNotNull() & (value >= 0)


def null_or(value: Column, test: Column) -> Column:
    return value.isNull() | test


def in_sequence(*moments: Column) -> Column:
    """Each moment is not before the previous one; a null skips the comparison."""
    steps = [
        earlier.isNull() | later.isNull() | (later >= earlier)
        for earlier, later in zip(moments, moments[1:])
    ]
    return reduce(lambda a, b: a & b, steps)


def first_failure(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first rule that is not true (null counts as failed), else null."""
    return F.coalesce(
        *[F.when(~F.coalesce(passed, F.lit(False)), F.lit(name)) for name, passed in rules]
    )
