"""Order-independent digests of months: what changed, without comparing rows.

The digest of a month is its row count and the sum and the exclusive or of its
row hashes. It does not depend on the order of rows or on how they lie in files,
counts repeated rows, and adds up from partial digests, so tasks fold their rows
before the shuffle. Null columns are told apart by their place in the hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

DIGEST = "rows bigint, hash_sum decimal(38,0), hash_xor bigint, month string"


def row_hash(columns: Sequence[str]) -> Column:
    """xxhash64 skips nulls, so each column goes in beside whether it is null."""
    parts = [p for c in columns for p in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(*parts)


def by_month(df: DataFrame, columns: Sequence[str], month: str = "month") -> DataFrame:
    """(rows, hash_sum, hash_xor, month): one row per month that has rows."""
    # Halves of the hash add up as whole numbers, exact for 2^31 rows a month; a decimal is made once.
    low, high = F.col("h").bitwiseAND(0xFFFFFFFF), F.shiftright("h", 32)
    halves = F.col("high").cast("decimal(20,0)") * F.lit(2**32).cast("decimal(10,0)") + F.col("low").cast("decimal(20,0)")
    return (
        df.select(F.col(month).alias("month"), row_hash(columns).alias("h"))
        .groupBy("month")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(low).alias("low"),
            F.sum(high).alias("high"),
            F.bit_xor("h").alias("hash_xor"),
        )
        .select("rows", halves.cast("decimal(38,0)").alias("hash_sum"), "hash_xor", "month")
    )


def as_text(digest: str = "") -> Column:
    """One value per digest; no rows read as the digest of nothing."""
    return F.concat_ws(
        "/",
        F.coalesce(F.col(f"{digest}rows"), F.lit(0)).cast("string"),
        F.coalesce(F.col(f"{digest}hash_sum"), F.lit(0)).cast("string"),
        F.coalesce(F.col(f"{digest}hash_xor"), F.lit(0)).cast("string"),
    )


def combined(digests: dict[str, DataFrame]) -> DataFrame:
    """(month, inputs): the digests of several tables side by side, as one value per month."""
    stacked = None
    for name, frame in digests.items():
        part = frame.select("month", F.struct(F.lit(name).alias("t"), as_text().alias("d")).alias("part"))
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy("month").agg(
        # One entry per table.
        F.to_json(F.sort_array(F.collect_list("part"))).alias("inputs")
    )


def changed_months(current: DataFrame, recorded: DataFrame) -> DataFrame:
    """Months whose inputs differ from the recorded ones, new and vanished ones included."""
    was = recorded.select("month", F.col("inputs").alias("was")).distinct()
    beside = current.select("month", "inputs").join(was, "month", "full")
    return beside.filter(~F.col("inputs").eqNullSafe(F.col("was"))).select("month").distinct()
