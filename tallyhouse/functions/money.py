"""Exact money arithmetic that stays on the 64-bit fast path.

``sum`` of a decimal wider than 8 digits needs a 128-bit accumulator, which
Spark keeps as a BigDecimal object per group. Summing whole cents as BIGINT is
exact, overflows with an error (ANSI mode), and any total that fits the
14-digit rollup columns fits 64 bits with room to spare.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def cents(amount: Column) -> Column:
    return (amount * F.lit(100).cast("decimal(3,0)")).cast("bigint")


def from_cents(total: Column, precision: int = 14) -> Column:
    return (total.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(
        f"decimal({precision},2)"
    )


def sum_money(amount: Column, precision: int = 14) -> Column:
    return from_cents(F.sum(cents(amount)), precision)


def ratio_2dp(numerator: Column, denominator: Column, precision: int) -> Column:
    """Quotient rounded half-up once; null when the denominator is zero."""
    divisor = F.when(denominator != 0, denominator.cast("decimal(18,0)"))
    return F.round(numerator.cast("decimal(20,2)") / divisor, 2).cast(f"decimal({precision},2)")
