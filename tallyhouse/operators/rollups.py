"""Derived tables: daily sales, customer metrics, product and category summaries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from tallyhouse.functions.money import cents, from_cents, ratio_2dp, sum_money
from tallyhouse.functions.predicates import revenue_bearing


def in_days(df: DataFrame, column: str, start: date | str, end: date | str) -> DataFrame:
    """Rows whose timestamp falls in the closed day range, as a half-open test.

    Tables partitioned by month get the matching partition predicate as well:
    it is not implied by the timestamp predicate.
    """
    first = F.lit(str(start)).cast("date")
    after = F.date_add(F.lit(str(end)).cast("date"), 1)
    kept = df.filter(
        (F.col(column) >= first.cast("timestamp")) & (F.col(column) < after.cast("timestamp"))
    )
    if "month" in df.columns:
        kept = kept.filter(F.col("month").between(str(start)[:7], str(end)[:7]))
    return kept


def sold_lines(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines whose order exists and bears revenue.

    A semi join on the full composite key: (order_id, order_date) is unique in
    orders, nothing else of the order is needed, and the line side stays
    splittable when one order is hot.
    """
    keys = ["order_id", "order_date"]
    if "month" in items.columns and "month" in orders.columns:
        keys.append("month")
    return items.join(orders.filter(revenue_bearing(F.col("status"))).select(*keys), keys, "left_semi")


def daily_sales(lines: DataFrame, products: DataFrame) -> DataFrame:
    """One row per (UTC day, product) from revenue-bearing lines.

    The sums combine map-side, so a hot product or day costs one partial row
    per task. ``order_count`` is exact: Spark de-duplicates (day, product,
    order) first and counts second, again with partial aggregation. Net is
    gross less discount, as line revenue is derived from the same columns.
    """
    in_cents = {
        "gross_revenue": F.sum("gross"),
        "discount_total": F.sum("discount"),
        "net_revenue": F.sum("gross") - F.sum("discount"),
    }
    per_day = (
        lines.select(
            F.to_date("order_date").alias("sale_date"),
            "product_id",
            "quantity",
            (cents(F.col("unit_price")) * F.col("quantity")).alias("gross"),
            cents(F.col("discount")).alias("discount"),
            "order_id",
        )
        .groupBy("sale_date", "product_id")
        .agg(
            F.sum(F.col("quantity").cast("bigint")).alias("units_sold"),
            *[from_cents(total).alias(name) for name, total in in_cents.items()],
            F.count_distinct("order_id").cast("int").alias("order_count"),
        )
    )
    return per_day.join(products.select("product_id", "category_id"), "product_id").select(
        "sale_date",
        F.date_format("sale_date", "yyyyMMdd").cast("int").alias("date_key"),
        "product_id",
        "category_id",
        "units_sold",
        "gross_revenue",
        "discount_total",
        "net_revenue",
        "order_count",
        ratio_2dp(F.col("gross_revenue"), F.col("units_sold"), 10).alias("avg_unit_price"),
    )


def customer_metrics(
    customers: DataFrame, orders: DataFrame, only: DataFrame | None = None
) -> DataFrame:
    """Lifetime value and cadence per customer; zeros without revenue orders.

    ``only`` (a DataFrame of customer_id) scopes the refresh; it is joined,
    never collected.
    """
    base = customers.select("customer_id")
    paying = orders.filter(revenue_bearing(F.col("status")))
    if only is not None:
        base = base.join(only, "customer_id", "left_semi")
        paying = paying.join(only, "customer_id", "left_semi")
    totals = paying.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("orders"),
        sum_money(F.col("total_amount")).alias("value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    return metrics_of(base, totals)


def metrics_of(base: DataFrame, totals: DataFrame) -> DataFrame:
    """Metrics of the customers in ``base`` from (customer_id, orders, value, first and last order)."""
    span = (
        F.unix_micros("last_order_date") - F.unix_micros("first_order_date")
    ).cast("decimal(20,0)")
    gap_days = span / (F.lit(86_400_000_000).cast("decimal(11,0)") * (F.col("orders") - 1))
    return base.join(totals, "customer_id", "left").select(
        "customer_id",
        F.coalesce("orders", F.lit(0)).cast("int").alias("total_orders"),
        F.coalesce("value", F.lit(0)).cast("decimal(14,2)").alias("lifetime_value"),
        F.coalesce(ratio_2dp(F.col("value"), F.col("orders"), 12), F.lit(0))
        .cast("decimal(12,2)")
        .alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        F.when(F.col("orders") > 1, F.round(gap_days, 2).cast("decimal(10,2)")).alias(
            "avg_days_between_orders"
        ),
    )


def customer_summary(customers: DataFrame, metrics: DataFrame) -> DataFrame:
    """Customer master beside its metrics; customers without metrics read as zero."""
    zero = F.lit(0)
    return customers.join(metrics, "customer_id", "left").select(
        "customer_id",
        "email",
        "first_name",
        "last_name",
        "country",
        "state",
        "city",
        "registration_date",
        F.coalesce("total_orders", zero).alias("order_count"),
        F.coalesce("lifetime_value", zero).cast("decimal(14,2)").alias("lifetime_value"),
        F.coalesce("avg_order_value", zero).cast("decimal(12,2)").alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        "avg_days_between_orders",
    )


def product_summary(
    rollup: DataFrame, products: DataFrame, categories: DataFrame, closure: DataFrame
) -> DataFrame:
    """All-time totals per product. The rollup is reduced to one row per product
    before any join, so the joins carry products and not selling days."""
    return summary_of(product_totals(rollup), products, categories, closure)


def product_totals(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("product_id").agg(
        F.sum("units_sold").alias("units"),
        sum_money(F.col("net_revenue"), 18).alias("revenue"),
        sum_money(F.col("discount_total"), 18).alias("discount"),
        F.sum(F.col("order_count").cast("bigint")).alias("orders"),
        F.min("sale_date").alias("first_sale_date"),
        F.max("sale_date").alias("last_sale_date"),
    )


def summary_of(
    totals: DataFrame, products: DataFrame, categories: DataFrame, closure: DataFrame
) -> DataFrame:
    """Products and their categories beside (product_id, units, revenue, discount, orders, first and last day)."""
    roots = closure.select("category_id", "root_category_id", "root_category_name")
    zero = F.lit(0)
    return (
        products.select("product_id", F.col("name").alias("product_name"), "sku", "category_id")
        .join(categories.select("category_id", F.col("name").alias("category_name")), "category_id")
        .join(roots, "category_id", "left")
        .join(totals, "product_id", "left")
        .select(
            "product_id",
            "product_name",
            "sku",
            "category_id",
            "category_name",
            "root_category_id",
            "root_category_name",
            F.coalesce("units", zero).alias("total_units_sold"),
            F.coalesce("revenue", zero).cast("decimal(18,2)").alias("total_revenue"),
            F.coalesce("discount", zero).cast("decimal(18,2)").alias("total_discount"),
            F.coalesce("orders", zero).alias("order_count"),
            "first_sale_date",
            "last_sale_date",
        )
    )


def daily_category_sales(rollup: DataFrame, closure: DataFrame) -> DataFrame:
    """Daily trend per top-level category.

    ``order_count`` adds per-product counts, so it counts product-order pairs;
    an order with two products of one category counts twice.
    """
    roots = closure.select(
        "category_id",
        F.col("root_category_id").alias("root_id"),
        F.col("root_category_name").alias("category_name"),
    )
    return (
        rollup.join(roots, "category_id")
        .groupBy("sale_date", "date_key", "root_id", "category_name")
        .agg(
            F.sum("units_sold").alias("units_sold"),
            sum_money(F.col("net_revenue"), 18).alias("net_revenue"),
            F.sum(F.col("order_count").cast("bigint")).alias("order_count"),
        )
        .withColumnRenamed("root_id", "category_id")
    )
