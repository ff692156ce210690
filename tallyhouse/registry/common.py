"""Helpers of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType

from tallyhouse.operators import rollups
from tallyhouse.operators.hierarchy import category_closure
from tallyhouse.sources import sample

# Period used by the period reports.
START, END = "1996-01-01", "1997-12-31"


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles in the last projection, as in the oracle."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def daily(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Daily rollup straight from the lines, limited to a period if given."""
    lines = sample.sold_lines(spark, sf_dir)
    if start and end:
        lines = rollups.in_days(lines, "order_date", start, end)
    return rollups.daily_sales(lines, sample.products(spark, sf_dir))


def closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_closure(sample.categories(spark, sf_dir))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.customer_metrics(sample.customers(spark, sf_dir), sample.orders(spark, sf_dir))


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.customer_summary(sample.customers(spark, sf_dir), metrics(spark, sf_dir))
