"""Listings, purchase history, lookups and nested results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse import model
from tallyhouse.operators import lookups
from tallyhouse.plans import reports
from tallyhouse.plans.job import utc_now
from tallyhouse.plans.load import upsert
from tallyhouse.registry import query
from tallyhouse.registry.common import END, START, closure, daily, plain, summary
from tallyhouse.registry.oracle import text_id, with_parts
from tallyhouse.registry.sales import IN_PERIOD, PROMO, SUMMARY_SQL, page_sql
from tallyhouse.session import cut_lineage, scratch_path
from tallyhouse.sources import sample
from tallyhouse.sources.warehouse import Warehouse

CUSTOMER = 8
CURSOR = ("1999-06-15 00:00:00", 700)

ORDER_SQL = """order_id, customer_id, order_date, status, payment_method, shipping_address,
    shipping_city, shipping_state, shipping_zip, shipping_country, processing_date,
    shipping_date, delivery_date, total_amount::DOUBLE AS total_amount"""


def history_sql(where: str, first: int) -> str:
    return with_parts(
        f"""SELECT {ORDER_SQL}, matching > {first} AS has_next_page
            FROM (SELECT *, count(*) OVER () AS matching FROM e_orders WHERE {where}
                  ORDER BY order_date DESC, order_id DESC LIMIT {first}) newest""",
        "e_orders",
    )


@query("purchase_history_first", history_sql(f"customer_id = {CUSTOMER}", 5))
def purchase_history_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reports.purchase_history(sample.orders(spark, sf_dir), CUSTOMER, first=5))


@query(
    "purchase_history_after",
    history_sql(
        f"""customer_id = {CUSTOMER}
            AND (order_date, order_id) < (TIMESTAMP '{CURSOR[0]}', {CURSOR[1]})""",
        4,
    ),
)
def purchase_history_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        reports.purchase_history(sample.orders(spark, sf_dir), CUSTOMER, first=4, after=CURSOR)
    )


@query(
    "purchase_history_status",
    history_sql(f"customer_id = {CUSTOMER} AND status IN ('Shipped', 'Delivered')", 20),
)
def purchase_history_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        reports.purchase_history(
            sample.orders(spark, sf_dir), CUSTOMER, statuses=["Shipped", "Delivered"]
        )
    )


@query(
    "recent_orders_per_customer",
    with_parts(
        f"""SELECT {ORDER_SQL}, rank::INTEGER AS rank FROM (
                SELECT *, row_number() OVER (PARTITION BY customer_id
                    ORDER BY order_date DESC, order_id DESC) AS rank FROM e_orders) ranked
            WHERE rank <= 3""",
        "e_orders",
    ),
)
def recent_orders_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reports.recent_orders(sample.orders(spark, sf_dir), first=3))


@query(
    "customers_page",
    with_parts(page_sql(SUMMARY_SQL, "lifetime_value DESC NULLS LAST, customer_id", 40, 10), "e_metrics"),
)
def customers_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = reports.customers_page(
        summary(spark, sf_dir), limit=40, offset=10, counted=sample.customers(spark, sf_dir)
    )
    return plain(listed)


@query(
    "customers_search",
    with_parts(
        page_sql(
            f"""SELECT * FROM ({SUMMARY_SQL}) s
                WHERE (email ILIKE '%customer.0000000_1%' OR last_name ILIKE '%customer.0000000_1%')
                  AND country = 'NATION_4' AND lifetime_value >= 100000.00""",
            "last_order_date ASC NULLS LAST, customer_id",
            50,
            0,
        ),
        "e_metrics",
    ),
)
def customers_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports.customer_list(
        summary(spark, sf_dir), "Customer.0000000_1", country="NATION_4", min_lifetime_value="100000.00"
    )
    return plain(reports.customers_page(found, sort="LAST_ORDER", descending=False))


PRODUCT_SQL = """product_id, name, description, price::DOUBLE AS price, cost::DOUBLE AS cost,
    category_id, sku, inventory_count, weight::DOUBLE AS weight, is_active, created_at"""


@query(
    "products_page",
    with_parts(
        page_sql(f"SELECT {PRODUCT_SQL} FROM e_products", "name ASC NULLS LAST, product_id", 50, 100),
        "e_products",
    ),
)
def products_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reports.products_page(sample.products(spark, sf_dir), limit=50, offset=100))


@query(
    "products_filtered",
    with_parts(
        page_sql(
            f"""SELECT {PRODUCT_SQL} FROM e_products WHERE name ILIKE '%RING%' AND is_active
                AND price BETWEEN 901 AND 1500 AND category_id IN (
                    SELECT category_id FROM e_closure
                    WHERE category_id = {PROMO} OR root_category_id = {PROMO})""",
            "created_at DESC NULLS LAST, product_id",
            200,
            0,
        ),
        "e_products",
        "e_closure",
    ),
)
def products_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports.product_list(
        sample.products(spark, sf_dir),
        search="RING",
        closure=closure(spark, sf_dir),
        category_id=sample.text_id(F.lit("PROMO")),
        active_only=True,
        min_price=901,
        max_price=1500,
    )
    return plain(reports.products_page(found, sort="CREATED_AT", descending=True, limit=200))


@query(
    "products_by_inventory",
    with_parts(
        page_sql(
            f"SELECT {PRODUCT_SQL} FROM e_products", "inventory_count DESC NULLS LAST, product_id", 25, 0
        ),
        "e_products",
    ),
)
def products_by_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        reports.products_page(sample.products(spark, sf_dir), sort="INVENTORY", descending=True, limit=25)
    )


@query(
    "product_lookup",
    with_parts(
        f"""SELECT k.product_id, p.* EXCLUDE (product_id) FROM
            (SELECT DISTINCT customer_id * 2 AS product_id FROM e_customers) k
            LEFT JOIN (SELECT {PRODUCT_SQL} FROM e_products) p ON p.product_id = k.product_id""",
        "e_customers",
        "e_products",
    ),
)
def product_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = sample.customers(spark, sf_dir).select((F.col("customer_id") * 2).alias("product_id"))
    return plain(lookups.lookup(keys, sample.products(spark, sf_dir), ["product_id"]))


@query(
    "product_lookup_stored",
    with_parts(
        f"""SELECT k.product_id, p.* EXCLUDE (product_id, created_at) FROM
            (SELECT product_id * 3 AS product_id FROM e_products WHERE product_id % 97 = 0) k
            LEFT JOIN (SELECT {PRODUCT_SQL} FROM e_products) p ON p.product_id = k.product_id""",
        "e_products",
    ),
)
def product_lookup_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few ids, some of them unknown, looked up in a stored table by their key shards."""
    warehouse = Warehouse(spark, scratch_path(spark, "lookup-tables"), 16)
    products = sample.products(spark, sf_dir)
    upsert(warehouse, model.PRODUCTS, products.select(*model.PRODUCTS.columns), utc_now())
    keys = products.filter("product_id % 97 = 0").select((F.col("product_id") * 3).alias("product_id"))
    return plain(lookups.lookup_stored(warehouse, model.PRODUCTS, keys).select(*model.PRODUCTS.columns))


@query(
    "orders_by_id",
    with_parts(
        """SELECT order_id, customer_id, order_date, status, total_amount::DOUBLE AS total_amount FROM e_orders
           WHERE order_id IN (SELECT min(order_id) FROM e_orders GROUP BY year(order_date))""",
        "e_orders",
    ),
)
def orders_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a few ids without their dates, found through Bloom filters of the stored months."""
    warehouse = Warehouse(spark, scratch_path(spark, "lookup-tables"), 4)
    orders = sample.orders(spark, sf_dir)
    upsert(warehouse, model.ORDERS, orders.select(*model.ORDERS.columns), utc_now())
    first = orders.groupBy(F.year("order_date")).agg(F.min("order_id").alias("order_id"))
    ids = [r.order_id for r in first.collect()]
    found = lookups.rows_of_ids(warehouse, "orders", "order_id", ids)
    return plain(found.select("order_id", "customer_id", "order_date", "status", "total_amount"))


@query(
    "customer_lookup",
    with_parts(
        f"""SELECT k.customer_id, s.* EXCLUDE (customer_id) FROM
            (SELECT DISTINCT product_id AS customer_id FROM e_products) k
            LEFT JOIN ({SUMMARY_SQL}) s ON s.customer_id = k.customer_id""",
        "e_metrics",
        "e_products",
    ),
)
def customer_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = sample.products(spark, sf_dir).select(F.col("product_id").alias("customer_id"))
    return plain(lookups.lookup(keys, summary(spark, sf_dir), ["customer_id"]))


@query(
    "category_lookup",
    with_parts(
        f"""SELECT k.category_id, c.name, c.description, c.parent_id FROM (
                SELECT DISTINCT {text_id("p_type")} AS category_id FROM part
                UNION SELECT {text_id("p_name")} FROM part) k
            LEFT JOIN e_categories c ON c.category_id = k.category_id""",
        "e_categories",
    ),
)
def category_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = sample.table(spark, sf_dir, "part")
    keys = part.select(sample.text_id(F.col("p_type")).alias("category_id")).unionByName(
        part.select(sample.text_id(F.col("p_name")).alias("category_id"))
    )
    return lookups.lookup(keys, sample.categories(spark, sf_dir), ["category_id"])


@query(
    "items_lookup",
    with_parts(
        """SELECT order_item_id, order_id, order_date, product_id, quantity,
                  unit_price::DOUBLE AS unit_price, discount::DOUBLE AS discount,
                  line_revenue::DOUBLE AS line_revenue
           FROM e_items WHERE (order_id, order_date) IN (
               SELECT order_id, order_date FROM e_orders WHERE status = 'Returned')""",
        "e_items",
        "e_orders",
    ),
)
def items_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = sample.orders(spark, sf_dir).filter("status = 'Returned'")
    return plain(lookups.lines_of(returned, sample.order_items(spark, sf_dir)))


@query(
    "nested_order_history",
    with_parts(
        f"""SELECT o.order_id, o.order_date, o.status, c.email, i.order_item_id, p.name AS product_name,
                   i.quantity, i.unit_price::DOUBLE AS unit_price
            FROM (SELECT * FROM e_orders WHERE customer_id = {CUSTOMER}
                  ORDER BY order_date DESC, order_id DESC LIMIT 10) o
            LEFT JOIN e_customers c ON c.customer_id = o.customer_id
            LEFT JOIN e_items i ON i.order_id = o.order_id AND i.order_date = o.order_date
            LEFT JOIN e_products p ON p.product_id = i.product_id""",
        "e_orders",
        "e_items",
        "e_customers",
        "e_products",
    ),
)
def nested_order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = cut_lineage(reports.purchase_history(sample.orders(spark, sf_dir), CUSTOMER, first=10))
    nested = lookups.nested_order_page(
        page,
        sample.order_items(spark, sf_dir),
        sample.products(spark, sf_dir),
        sample.customers(spark, sf_dir),
    )
    line = [F.col(f"item.{c}").alias(c) for c in ("order_item_id", "product_name", "quantity", "unit_price")]
    return plain(nested.select("order_id", "order_date", "status", F.col("customer.email").alias("email"), *line))


@query(
    "order_lines_flat",
    with_parts(
        """SELECT o.order_id, o.order_date, o.status, i.order_item_id, i.product_id,
                  p.name AS product_name, i.line_revenue::DOUBLE AS line_revenue
           FROM e_orders o
           LEFT JOIN e_items i ON i.order_id = o.order_id AND i.order_date = o.order_date
           LEFT JOIN e_products p ON p.product_id = i.product_id""",
        "e_orders",
        "e_items",
        "e_products",
    ),
)
def order_lines_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = lookups.order_lines_flat(
        sample.orders(spark, sf_dir), sample.order_items(spark, sf_dir), sample.products(spark, sf_dir)
    )
    return plain(
        flat.select(
            "order_id",
            "order_date",
            "status",
            "item.order_item_id",
            "item.product_id",
            "item.product_name",
            "item.line_revenue",
        )
    )


@query(
    "nested_product_sales",
    with_parts(
        f"""SELECT product_id, units_sold, net_revenue::DOUBLE AS net_revenue, order_count,
                   p.sku, k.name AS category_name
            FROM (SELECT d.product_id, sum(d.units_sold)::BIGINT AS units_sold,
                         sum(d.net_revenue) AS net_revenue,
                         sum(d.order_count)::BIGINT AS order_count
                  FROM e_daily d WHERE {IN_PERIOD} GROUP BY 1
                  ORDER BY net_revenue DESC, product_id LIMIT 50) s
            LEFT JOIN e_products p USING (product_id)
            LEFT JOIN e_categories k ON k.category_id = p.category_id""",
        "e_daily",
        "e_categories",
    ),
)
def nested_product_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    products, categories = sample.products(spark, sf_dir), sample.categories(spark, sf_dir)
    sales = reports.product_sales(daily(spark, sf_dir, START, END), products, categories, START, END)
    nested = lookups.nested_product_sales(
        reports.product_sales_page(sales, limit=50), products, categories
    )
    return plain(
        nested.select(
            "product_id",
            "units_sold",
            "net_revenue",
            "order_count",
            F.col("product.sku").alias("sku"),
            F.col("product.category.name").alias("category_name"),
        )
    )
