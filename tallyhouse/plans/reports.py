"""The read side: sales, trends, rankings, listings and purchase history."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.functions.money import sum_money
from tallyhouse.operators import day_bitmaps
from tallyhouse.operators.hierarchy import in_subtree
from tallyhouse.operators.paging import (
    before_cursor,
    clamp_page,
    clamp_per_category,
    page,
    resolve_period,
    sort_columns,
)

# Sortable fields by public name.
PRODUCT_SALES_SORTS = {
    "REVENUE": "net_revenue",
    "UNITS": "units_sold",
    "ORDERS": "order_count",
    "NAME": "product_name",
}
PRODUCT_SORTS = {
    "NAME": "name",
    "PRICE": "price",
    "CREATED_AT": "created_at",
    "INVENTORY": "inventory_count",
}
CUSTOMER_SORTS = {
    "LIFETIME_VALUE": "lifetime_value",
    "ORDER_COUNT": "order_count",
    "LAST_ORDER": "last_order_date",
    "NAME": "last_name",
}
GRANULARITIES = ("DAY", "WEEK", "MONTH", "QUARTER", "YEAR")

ORDER_COLUMNS = (
    "order_id",
    "customer_id",
    "order_date",
    "status",
    "payment_method",
    "shipping_address",
    "shipping_city",
    "shipping_state",
    "shipping_zip",
    "shipping_country",
    "processing_date",
    "shipping_date",
    "delivery_date",
    "total_amount",
)


def contains(column: str, text: str) -> Column:
    """Case-insensitive substring; ``%`` and ``_`` in the text stay wildcards."""
    return F.col(column).ilike(f"%{text}%")


def sales_days(rollup: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Rollup rows of a closed day range, pruning month partitions when present."""
    kept = rollup.filter(
        F.col("sale_date").between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))
    )
    if "month" in rollup.columns:
        kept = kept.filter(F.col("month").between(str(start)[:7], str(end)[:7]))
    return kept


def _measures(precision: int = 18) -> list[Column]:
    return [
        F.sum("units_sold").alias("units_sold"),
        sum_money(F.col("net_revenue"), precision).alias("net_revenue"),
        sum_money(F.col("gross_revenue"), precision).alias("gross_revenue"),
        sum_money(F.col("discount_total"), precision).alias("discount_total"),
        F.sum(F.col("order_count").cast("bigint")).alias("order_count"),
    ]


def product_sales(
    rollup: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    start: date | str | None = None,
    end: date | str | None = None,
    closure: DataFrame | None = None,
    category_id: Column | int | None = None,
    search: str | None = None,
    today: date | None = None,
) -> DataFrame:
    """Sales per product over a period, without one over the last 90 days.

    The category filter tests the category stored in the rollup; the category
    shown is the product's current one. A search drops the other products' days
    before they are summed up.
    """
    days = sales_days(rollup, *resolve_period(start, end, today))
    if category_id is not None:
        days = in_subtree(days, closure, category_id)
    if search:
        products = products.filter(contains("name", search))
        days = days.join(products.select("product_id"), "product_id", "left_semi")
    per_product = days.groupBy("product_id").agg(*_measures())
    return (
        per_product.join(
            products.select("product_id", F.col("name").alias("product_name"), "sku", "category_id"),
            "product_id",
        )
        .join(categories.select("category_id", F.col("name").alias("category_name")), "category_id")
        .select(
            "product_id",
            "product_name",
            "sku",
            "category_id",
            "category_name",
            "units_sold",
            "net_revenue",
            "gross_revenue",
            "discount_total",
            "order_count",
        )
    )


def product_sales_page(
    sales: DataFrame, sort: str = "REVENUE", descending: bool = True, limit: int = 50, offset: int = 0
) -> DataFrame:
    order = sort_columns(sort, PRODUCT_SALES_SORTS, descending, "product_id")
    return page(sales, order, limit, offset)


def top_products_by_category(
    rollup: DataFrame,
    products: DataFrame,
    closure: DataFrame,
    start: date | str | None = None,
    end: date | str | None = None,
    per_category: int = 5,
    root_category_id: Column | int | None = None,
    today: date | None = None,
) -> DataFrame:
    """Top N products within each top-level category.

    The rank filter lets Catalyst keep only N rows per category and task
    before the shuffle, so even a category with most of the products moves a
    handful of rows; names are joined to the winners only.
    """
    start, end = resolve_period(start, end, today)
    roots = closure.select(
        "category_id",
        F.col("root_category_id").alias("root_id"),
        F.col("root_category_name").alias("category_name"),
    )
    if root_category_id is not None:
        wanted = root_category_id if isinstance(root_category_id, Column) else F.lit(root_category_id)
        roots = roots.filter(F.col("root_id") == wanted)
    per_product = (
        sales_days(rollup, start, end)
        .join(roots, "category_id")
        .groupBy("root_id", "category_name", "product_id")
        .agg(
            F.sum("units_sold").alias("units_sold"),
            sum_money(F.col("net_revenue"), 18).alias("net_revenue"),
            F.sum(F.col("order_count").cast("bigint")).alias("order_count"),
        )
    )
    best_first = Window.partitionBy("root_id").orderBy(F.col("net_revenue").desc(), "product_id")
    winners = per_product.withColumn("rank", F.row_number().over(best_first)).filter(
        F.col("rank") <= clamp_per_category(per_category)
    )
    names = products.select("product_id", F.col("name").alias("product_name"), "sku")
    return (
        winners.join(names, "product_id")
        .select(
            F.col("root_id").alias("category_id"),
            "category_name",
            "product_id",
            "product_name",
            "sku",
            "units_sold",
            "net_revenue",
            "order_count",
            "rank",
        )
        .orderBy("category_name", "rank")
    )


def sales_trends(
    rollup: DataFrame,
    start: date | str | None = None,
    end: date | str | None = None,
    granularity: str = "DAY",
    closure: DataFrame | None = None,
    category_id: Column | int | None = None,
    today: date | None = None,
) -> DataFrame:
    """Sums and distinct products per calendar bucket (weeks start on Monday)."""
    if granularity not in GRANULARITIES:
        raise ValueError(f"unsupported granularity: {granularity!r}")
    days = sales_days(rollup, *resolve_period(start, end, today))
    if category_id is not None:
        days = in_subtree(days, closure, category_id)
    bucket = F.date_trunc(granularity.lower(), "sale_date").cast("date")
    return (
        days.groupBy(bucket.alias("bucket_start"))
        .agg(*_measures(), F.count_distinct("product_id").alias("distinct_products"))
        .orderBy("bucket_start")
    )


def sales_trends_stored(
    category_days: DataFrame,
    start: date | str | None = None,
    end: date | str | None = None,
    granularity: str = "DAY",
    closure: DataFrame | None = None,
    category_id: Column | int | None = None,
    today: date | None = None,
) -> DataFrame:
    """``sales_trends`` from the stored bitmaps: distinct products without a distinct."""
    if granularity not in GRANULARITIES:
        raise ValueError(f"unsupported granularity: {granularity!r}")
    days = sales_days(category_days, *resolve_period(start, end, today))
    if category_id is not None:
        days = in_subtree(days, closure, category_id)
    bucket = F.date_trunc(granularity.lower(), "sale_date").cast("date")
    return day_bitmaps.trend(days, bucket).orderBy("bucket_start")


def customer_list(
    summary: DataFrame,
    search: str | None = None,
    country: str | None = None,
    min_lifetime_value: float | str | None = None,
) -> DataFrame:
    kept = summary
    if search:
        kept = kept.filter(contains("email", search) | contains("last_name", search))
    if country:
        kept = kept.filter(F.col("country") == country)
    if min_lifetime_value is not None:
        kept = kept.filter(
            F.col("lifetime_value") >= F.lit(str(min_lifetime_value)).cast("decimal(14,2)")
        )
    return kept


def customers_page(
    customers: DataFrame,
    sort: str = "LIFETIME_VALUE",
    descending: bool = True,
    limit: int = 50,
    offset: int = 0,
    counted: DataFrame | None = None,
) -> DataFrame:
    """``counted`` may be the customer master under the same filters: metrics
    add no rows, so the total need not join them."""
    order = sort_columns(sort, CUSTOMER_SORTS, descending, "customer_id")
    return page(customers, order, limit, offset, counted)


def product_list(
    products: DataFrame,
    search: str | None = None,
    closure: DataFrame | None = None,
    category_id: Column | int | None = None,
    active_only: bool = False,
    min_price: float | str | None = None,
    max_price: float | str | None = None,
) -> DataFrame:
    kept = products
    if search:
        kept = kept.filter(contains("name", search))
    if active_only:
        kept = kept.filter("is_active")
    if min_price is not None:
        kept = kept.filter(F.col("price") >= F.lit(str(min_price)).cast("decimal(10,2)"))
    if max_price is not None:
        kept = kept.filter(F.col("price") <= F.lit(str(max_price)).cast("decimal(10,2)"))
    if category_id is not None:
        kept = in_subtree(kept, closure, category_id)
    return kept


def products_page(
    products: DataFrame, sort: str = "NAME", descending: bool = False, limit: int = 50, offset: int = 0
) -> DataFrame:
    return page(products, sort_columns(sort, PRODUCT_SORTS, descending, "product_id"), limit, offset)


def purchase_history(
    orders: DataFrame,
    customer_id: int,
    first: int = 20,
    after: tuple[object, int] | None = None,
    statuses: list[str] | None = None,
) -> DataFrame:
    """A customer's orders, newest first, after an optional (order_date, order_id).

    ``has_next_page`` is true on every row when a further order exists. One
    row more than the page is read to know it, so the flag costs no count.
    """
    first, _ = clamp_page(first)
    kept = orders.filter(F.col("customer_id") == customer_id)
    if after is not None:
        kept = before_cursor(kept, "order_date", "order_id", after)
    if statuses:
        kept = kept.filter(F.col("status").isin(*statuses))
    newest = [F.col("order_date").desc(), F.col("order_id").desc()]
    window = Window.orderBy(*newest)  # over at most first + 1 rows
    return (
        kept.select(*ORDER_COLUMNS)
        .orderBy(*newest)
        .limit(first + 1)
        .withColumn("position", F.row_number().over(window))
        .withColumn(
            "has_next_page",
            F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))) > first,
        )
        .filter(F.col("position") <= first)
        .drop("position")
    )


def recent_orders(orders: DataFrame, customers: DataFrame | None = None, first: int = 3) -> DataFrame:
    """The newest N orders of every customer (or of the given customers).

    The rank filter prunes to N rows per customer and task before the shuffle,
    so a customer with a third of all orders does not become one large task. A
    batch operator: N is not clamped to a page.
    """
    if first < 1:
        raise ValueError("ask for one order or more")
    if customers is not None:
        orders = orders.join(customers.select("customer_id"), "customer_id", "left_semi")
    newest = Window.partitionBy("customer_id").orderBy(
        F.col("order_date").desc(), F.col("order_id").desc()
    )
    return (
        orders.select(*ORDER_COLUMNS)
        .withColumn("rank", F.row_number().over(newest))
        .filter(F.col("rank") <= first)
    )
