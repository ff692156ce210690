"""Sales reports over the supplied tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.operators import rollups
from tallyhouse.plans import reports
from tallyhouse.registry import query
from tallyhouse.registry.common import END, START, closure, daily, metrics, plain, summary
from tallyhouse.registry.oracle import REVENUE, text_id, with_parts
from tallyhouse.sources import sample

IN_PERIOD = f"sale_date BETWEEN DATE '{START}' AND DATE '{END}'"

DAILY_COLUMNS = """sale_date, date_key, product_id, category_id, units_sold,
    gross_revenue::DOUBLE AS gross_revenue, discount_total::DOUBLE AS discount_total,
    net_revenue::DOUBLE AS net_revenue, order_count, avg_unit_price::DOUBLE AS avg_unit_price"""

MEASURES = """sum(d.units_sold)::BIGINT AS units_sold,
    sum(d.net_revenue)::DOUBLE AS net_revenue, sum(d.gross_revenue)::DOUBLE AS gross_revenue,
    sum(d.discount_total)::DOUBLE AS discount_total, sum(d.order_count)::BIGINT AS order_count"""


@query("daily_sales_rollup", with_parts(f"SELECT {DAILY_COLUMNS} FROM e_daily", "e_daily"))
def daily_sales_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(daily(spark, sf_dir))


TOP_PARTS = ("e_items", "e_orders", "e_products", "e_closure")


def top_sql(n: int, where: str = "TRUE") -> str:
    """Straight from the lines of the period."""
    return f"""
    SELECT r.root_category_id AS category_id, r.root_category_name AS category_name,
           i.product_id, p.name AS product_name, p.sku,
           CAST(sum(i.quantity) AS BIGINT) AS units_sold,
           CAST(sum(i.line_revenue) AS DOUBLE) AS net_revenue,
           count(DISTINCT i.order_id) AS order_count,
           CAST(row_number() OVER best AS INTEGER) AS rank
    FROM e_items i
    SEMI JOIN (SELECT order_id, order_date FROM e_orders WHERE {REVENUE}) o
        ON i.order_id = o.order_id AND i.order_date = o.order_date
    JOIN e_products p ON i.product_id = p.product_id
    JOIN e_closure r ON p.category_id = r.category_id
    WHERE CAST(i.order_date AS DATE) BETWEEN DATE '{START}' AND DATE '{END}' AND {where}
    GROUP BY r.root_category_id, r.root_category_name, i.product_id, p.name, p.sku
    WINDOW best AS (PARTITION BY r.root_category_id ORDER BY sum(i.line_revenue) DESC, i.product_id)
    QUALIFY row_number() OVER best <= {n}"""


@query(
    "top_products_by_category",
    with_parts(top_sql(5), *TOP_PARTS),
)
def top_products_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        reports.top_products_by_category(
            daily(spark, sf_dir, START, END),
            sample.products(spark, sf_dir),
            closure(spark, sf_dir),
            START,
            END,
        )
    )


@query(
    "top_products_one_category",
    with_parts(top_sql(10, f"r.root_category_id = {text_id(chr(39) + 'PROMO' + chr(39))}"), *TOP_PARTS),
)
def top_products_one_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        reports.top_products_by_category(
            daily(spark, sf_dir, START, END),
            sample.products(spark, sf_dir),
            closure(spark, sf_dir),
            START,
            END,
            per_category=10,
            root_category_id=sample.text_id(F.lit("PROMO")),
        )
    )


@query(
    "daily_category_sales",
    with_parts(
        """SELECT d.sale_date, d.date_key, c.root_category_id AS category_id,
                  c.root_category_name AS category_name, sum(d.units_sold)::BIGINT AS units_sold,
                  sum(d.net_revenue)::DOUBLE AS net_revenue,
                  sum(d.order_count)::BIGINT AS order_count
           FROM e_daily d JOIN e_closure c ON c.category_id = d.category_id GROUP BY ALL""",
        "e_daily",
        "e_closure",
    ),
)
def daily_category_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(rollups.daily_category_sales(daily(spark, sf_dir), closure(spark, sf_dir)))


@query(
    "product_sales_summary",
    with_parts(
        """SELECT p.product_id, p.name AS product_name, p.sku, p.category_id,
                  k.name AS category_name, c.root_category_id, c.root_category_name,
                  coalesce(sum(d.units_sold), 0)::BIGINT AS total_units_sold,
                  coalesce(sum(d.net_revenue), 0)::DOUBLE AS total_revenue,
                  coalesce(sum(d.discount_total), 0)::DOUBLE AS total_discount,
                  coalesce(sum(d.order_count), 0)::BIGINT AS order_count,
                  min(d.sale_date) AS first_sale_date, max(d.sale_date) AS last_sale_date
           FROM e_products p JOIN e_categories k ON k.category_id = p.category_id
           LEFT JOIN e_closure c ON c.category_id = p.category_id
           LEFT JOIN e_daily d ON d.product_id = p.product_id GROUP BY ALL""",
        "e_daily",
        "e_closure",
        "e_categories",
    ),
)
def product_sales_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        rollups.product_summary(
            daily(spark, sf_dir),
            sample.products(spark, sf_dir),
            sample.categories(spark, sf_dir),
            closure(spark, sf_dir),
        )
    )


METRIC_COLUMNS = """lifetime_value::DOUBLE AS lifetime_value,
    avg_order_value::DOUBLE AS avg_order_value, first_order_date, last_order_date,
    avg_days_between_orders::DOUBLE AS avg_days_between_orders"""


@query(
    "customer_metrics",
    with_parts(f"SELECT customer_id, total_orders, {METRIC_COLUMNS} FROM e_metrics", "e_metrics"),
)
def customer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(metrics(spark, sf_dir))


SUMMARY_SQL = f"""SELECT c.customer_id, c.email, c.first_name, c.last_name, c.country, c.state,
    c.city, c.registration_date, m.total_orders AS order_count, {METRIC_COLUMNS}
    FROM e_customers c JOIN e_metrics m ON m.customer_id = c.customer_id"""


@query("customer_summary", with_parts(SUMMARY_SQL, "e_metrics"))
def customer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(summary(spark, sf_dir))


def page_sql(inner: str, order: str, limit: int, offset: int) -> str:
    return f"""SELECT *, total_count > {limit + offset} AS has_next_page
        FROM (SELECT *, count(*) OVER () AS total_count FROM ({inner}) listed
              ORDER BY {order} LIMIT {limit} OFFSET {offset}) paged"""


def product_sales_sql(where: str, order: str, limit: int, offset: int) -> str:
    inner = f"""SELECT p.product_id, p.name AS product_name, p.sku, p.category_id,
            k.name AS category_name, {MEASURES}
        FROM e_daily d JOIN e_products p ON p.product_id = d.product_id
        JOIN e_categories k ON k.category_id = p.category_id
        WHERE {where} GROUP BY p.product_id, p.name, p.sku, p.category_id, k.name"""
    return with_parts(page_sql(inner, order, limit, offset), "e_daily", "e_categories", "e_closure")


def _product_sales(spark: SparkSession, sf_dir: str, **filters: object) -> DataFrame:
    return reports.product_sales(
        daily(spark, sf_dir, START, END),
        sample.products(spark, sf_dir),
        sample.categories(spark, sf_dir),
        START,
        END,
        **filters,
    )


@query(
    "product_sales_page",
    product_sales_sql(IN_PERIOD, "net_revenue DESC NULLS LAST, product_id", 50, 25),
)
def product_sales_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reports.product_sales_page(_product_sales(spark, sf_dir), limit=50, offset=25))


@query(
    "product_sales_search",
    product_sales_sql(
        f"{IN_PERIOD} AND p.name ILIKE '%Bolt%'", "units_sold ASC NULLS LAST, product_id", 20, 0
    ),
)
def product_sales_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = _product_sales(spark, sf_dir, search="Bolt")
    return plain(reports.product_sales_page(sales, sort="UNITS", descending=False, limit=20))


PROMO = text_id("'PROMO'")


@query(
    "product_sales_category",
    product_sales_sql(
        f"""{IN_PERIOD} AND d.category_id IN (SELECT category_id FROM e_closure
            WHERE category_id = {PROMO} OR root_category_id = {PROMO})""",
        "product_name ASC NULLS LAST, product_id",
        200,
        0,
    ),
)
def product_sales_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = _product_sales(
        spark,
        sf_dir,
        closure=closure(spark, sf_dir),
        category_id=sample.text_id(F.lit("PROMO")),
    )
    return plain(reports.product_sales_page(sales, sort="NAME", descending=False, limit=500))


def trend_sql(unit: str, where: str = IN_PERIOD) -> str:
    return with_parts(
        f"""SELECT date_trunc('{unit}', d.sale_date)::DATE AS bucket_start, {MEASURES},
                   count(DISTINCT d.product_id) AS distinct_products
            FROM e_daily d WHERE {where} GROUP BY 1""",
        "e_daily",
        "e_closure",
    )


def _register_trend(granularity: str) -> None:
    @query(f"sales_trend_{granularity.lower()}", trend_sql(granularity.lower()))
    def trend(spark: SparkSession, sf_dir: str) -> DataFrame:
        rollup = daily(spark, sf_dir, START, END)
        return plain(reports.sales_trends(rollup, START, END, granularity))


for _granularity in reports.GRANULARITIES:
    _register_trend(_granularity)


@query(
    "sales_trend_category",
    trend_sql(
        "month",
        f"""{IN_PERIOD} AND d.category_id IN (SELECT category_id FROM e_closure
            WHERE category_id = {PROMO} OR root_category_id = {PROMO})""",
    ),
)
def sales_trend_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        reports.sales_trends(
            daily(spark, sf_dir, START, END),
            START,
            END,
            "MONTH",
            closure=closure(spark, sf_dir),
            category_id=sample.text_id(F.lit("PROMO")),
        )
    )


@query(
    "product_sales_default_period",
    with_parts(
        f"""SELECT p.product_id, p.name AS product_name, p.sku, p.category_id, k.name AS category_name, {MEASURES}
            FROM e_daily d JOIN e_products p ON p.product_id = d.product_id
            JOIN e_categories k ON k.category_id = p.category_id
            WHERE d.sale_date BETWEEN DATE '1998-08-02' - 90 AND DATE '1998-08-02' GROUP BY ALL""",
        "e_daily",
        "e_categories",
    ),
)
def product_sales_default_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a period: the 90 days up to the given day."""
    sales = reports.product_sales(
        daily(spark, sf_dir),
        sample.products(spark, sf_dir),
        sample.categories(spark, sf_dir),
        today=date(1998, 8, 2),
    )
    return plain(sales)
