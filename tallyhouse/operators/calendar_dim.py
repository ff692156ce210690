"""Date dimension and declared month ranges."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.functions.holidays import holiday_name, iso_weekday
from tallyhouse.model import FIRST_MONTH, LAST_MONTH

SEED_START, SEED_END = "2015-01-01", "2035-12-31"


def _check_range(start: date | str, end: date | str) -> None:
    if str(end) < str(start):
        raise ValueError(f"end {end} precedes start {start}")


def describe_days(days: DataFrame) -> DataFrame:
    """Calendar attributes of a DataFrame of ``date``."""
    day = F.col("date")
    holiday = holiday_name(day)
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        day,
        iso_weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        (iso_weekday(day) >= 6).alias("is_weekend"),
        holiday.isNotNull().alias("is_holiday"),
        holiday.alias("holiday_name"),
    )


def days_between(span: DataFrame) -> DataFrame:
    """One row per day of a one-row (start, end) DataFrame."""
    return span.select(F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("date"))


def date_dimension(
    spark: SparkSession, start: date | str = SEED_START, end: date | str = SEED_END
) -> DataFrame:
    _check_range(start, end)
    span = spark.range(1).select(
        F.lit(str(start)).cast("date").alias("start"), F.lit(str(end)).cast("date").alias("end")
    )
    return describe_days(days_between(span))


def refresh_date_dimension(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """Add new days; of known days only the holiday fields are refreshed."""
    known = existing.alias("t").join(fresh.alias("s"), "date_key", "left")
    kept = known.select(
        *[
            F.coalesce(f"s.{c}", f"t.{c}").alias(c)
            if c == "is_holiday"
            else F.when(F.col("s.date").isNotNull(), F.col("s.holiday_name"))
            .otherwise(F.col("t.holiday_name"))
            .alias(c)
            if c == "holiday_name"
            else F.col("date_key")
            if c == "date_key"
            else F.col(f"t.{c}")
            for c in existing.columns
        ]
    )
    return kept.unionByName(fresh.join(existing.select("date_key"), "date_key", "left_anti"))


def months_between(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    """Month starts covering both ends."""
    _check_range(start, end)
    first, last = (F.trunc(F.lit(str(d)).cast("date"), "month") for d in (start, end))
    return spark.range(1).select(
        F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("month_start")
    )


def declared_months(spark: SparkSession) -> DataFrame:
    return months_between(spark, FIRST_MONTH, LAST_MONTH)


def new_months(declared: DataFrame, start_end: DataFrame) -> DataFrame:
    """Months of a one-row (start, end) DataFrame that are not declared yet."""
    wanted = start_end.filter(F.col("start").isNotNull()).select(
        F.explode(
            F.sequence(
                F.trunc("start", "month"), F.trunc("end", "month"), F.expr("interval 1 month")
            )
        ).alias("month_start")
    )
    return wanted.join(declared, "month_start", "left_anti")


def undeclared_rows(df: DataFrame, moment: str, declared: DataFrame) -> DataFrame:
    """Rows per month outside every declared month. A month partition column
    answers without reading the timestamps."""
    month = (
        F.concat("month", F.lit("-01")).cast("date")
        if "month" in df.columns
        else F.trunc(moment, "month")
    )
    per_month = df.groupBy(month.alias("month_start")).agg(F.count(F.lit(1)).alias("row_count"))
    return per_month.join(declared, "month_start", "left_anti")


def months_before(months: DataFrame, cutoff: date | str) -> DataFrame:
    """Months that end on or before the cutoff: candidates for retention."""
    upper = F.add_months("month_start", 1)
    return (
        months.select("month_start", upper.alias("upper_bound"))
        .filter(F.col("upper_bound") <= F.lit(str(cutoff)).cast("date"))
        .orderBy("upper_bound")
    )
