"""Row rules and references over text copies of the supplied tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyhouse import model
from tallyhouse.operators import audits, references, validate
from tallyhouse.operators.validate import MISMATCH, REASON
from tallyhouse.registry import query
from tallyhouse.registry.common import closure, daily, metrics, plain
from tallyhouse.registry.oracle import with_parts
from tallyhouse.registry.structure import NATION, REGION, SEGMENT
from tallyhouse.sources import faults, sample


def _classified(entity: model.Entity, spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = getattr(faults, "categories" if entity is model.CATEGORIES else entity.name)(spark, sf_dir)
    return validate.classify(entity, raw.withColumn(validate.POSITION, F.col("row_id")))


def _result(classified: DataFrame, *columns: str) -> DataFrame:
    return plain(
        classified.select(
            F.col(validate.POSITION).alias("row_id"), F.col(REASON).alias("reject_reason"), *columns
        )
    )


CATEGORY_REASON = """CASE description WHEN 'Brand#9' THEN 'category_id_invalid'
    WHEN 'Brand#3' THEN 'name_blank' WHEN 'Brand#5' THEN 'parent_id_invalid'
    WHEN 'Brand#7' THEN 'parent_is_self' END"""
CATEGORY_ROWS = f"""
    SELECT category_id AS row_id, {CATEGORY_REASON} AS reject_reason,
           CASE WHEN description IS NOT DISTINCT FROM 'Brand#9' THEN NULL ELSE category_id END
               AS category_id,
           CASE description WHEN 'Brand#3' THEN '' WHEN 'Brand#9' THEN NULL ELSE name END AS name
    FROM e_categories"""


@query("validate_categories", with_parts(f"SELECT * FROM ({CATEGORY_ROWS}) r", "e_categories"))
def validate_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _result(_classified(model.CATEGORIES, spark, sf_dir), "category_id", "name")


PRODUCT_REASON = """CASE
    WHEN inventory_count = 1 THEN 'product_id_invalid'
    WHEN inventory_count IN (2, 16) THEN 'name_blank'
    WHEN inventory_count = 3 THEN 'sku_blank'
    WHEN inventory_count = 4 THEN 'category_id_invalid'
    WHEN inventory_count IN (5, 6, 15, 19) THEN 'price_invalid'
    WHEN inventory_count = 7 THEN 'cost_invalid'
    WHEN inventory_count = 8 THEN 'inventory_invalid'
    WHEN inventory_count = 9 THEN 'weight_invalid'
    WHEN inventory_count = 18 AND length(name) * 60 > 255 THEN 'name_too_long'
    WHEN inventory_count = 17 THEN 'price_out_of_range' END"""
PRODUCT_ROWS = f"""
    SELECT product_id AS row_id, {PRODUCT_REASON} AS reject_reason,
           CASE WHEN inventory_count = 1 THEN NULL ELSE product_id END AS product_id,
           CASE WHEN inventory_count IN (6, 15, 17, 19) THEN NULL
                WHEN inventory_count = 5 THEN -1 WHEN inventory_count = 16 THEN -2
                WHEN inventory_count = 12 THEN 1000 WHEN inventory_count = 14 THEN 12.35
                WHEN inventory_count = 20 THEN 0 ELSE price END::DOUBLE AS price,
           CASE inventory_count WHEN 10 THEN TRUE WHEN 11 THEN FALSE WHEN 21 THEN TRUE
                ELSE is_active END AS is_active,
           CASE inventory_count WHEN 8 THEN -1 WHEN 13 THEN 0 ELSE inventory_count END
               AS inventory_count
    FROM e_products"""


@query("validate_products", with_parts(f"SELECT * FROM ({PRODUCT_ROWS}) r", "e_products"))
def validate_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _result(
        _classified(model.PRODUCTS, spark, sf_dir), "product_id", "price", "is_active", "inventory_count"
    )


CUSTOMER_ROWS = """
    SELECT customer_id AS row_id, CASE
               WHEN country = 'NATION_12' THEN 'customer_id_invalid'
               WHEN country IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_13')
                   THEN 'email_invalid'
               WHEN country = 'NATION_4' THEN 'first_name_blank'
               WHEN country = 'NATION_5' THEN 'last_name_blank'
               WHEN country IN ('NATION_6', 'NATION_14') THEN 'registration_date_invalid'
               WHEN country = 'NATION_7' THEN 'last_login_before_registration'
               WHEN country = 'NATION_15' THEN 'zip_code_too_long' END AS reject_reason,
           CASE country WHEN 'NATION_1' THEN 'not-an-email' WHEN 'NATION_2' THEN 'no@tld'
               WHEN 'NATION_3' THEN 'a b@x.com' WHEN 'NATION_13' THEN '@example.com'
               ELSE email END AS email,
           CASE country WHEN 'NATION_6' THEN NULL WHEN 'NATION_14' THEN NULL
               WHEN 'NATION_10' THEN TIMESTAMP '1995-03-15 08:00:00'
               WHEN 'NATION_11' THEN TIMESTAMP '1995-03-15'
               WHEN 'NATION_17' THEN TIMESTAMP '1995-03-01'
               ELSE registration_date END AS registration_date
    FROM e_customers"""


@query("validate_customers", with_parts(f"SELECT * FROM ({CUSTOMER_ROWS}) r", "e_customers"))
def validate_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _result(_classified(model.CUSTOMERS, spark, sf_dir), "email", "registration_date")


ORDER_ROWS = """
    SELECT o_orderkey + 1 AS row_id,
           CASE o_orderstatus || substr(o_orderpriority, 1, 1)
               WHEN 'O1' THEN 'order_id_invalid' WHEN 'O2' THEN 'customer_id_invalid'
               WHEN 'O3' THEN 'order_date_invalid' WHEN 'O4' THEN 'status_unknown'
               WHEN 'O5' THEN 'payment_method_unknown' WHEN 'F1' THEN 'total_amount_invalid'
               WHEN 'P2' THEN 'total_amount_invalid' WHEN 'F2' THEN 'shipping_address_blank'
               WHEN 'F3' THEN 'date_sequence_invalid' WHEN 'F4' THEN 'shipping_city_blank'
               WHEN 'F5' THEN 'shipping_zip_blank' END AS reject_reason,
           CASE WHEN o_orderstatus || substr(o_orderpriority, 1, 1) = 'O3' THEN NULL
               ELSE o_orderdate::TIMESTAMP END AS order_date,
           CASE o_orderstatus || substr(o_orderpriority, 1, 1) WHEN 'F1' THEN -1
               WHEN 'P2' THEN NULL ELSE o_totalprice::DECIMAL(12,2) END::DOUBLE AS total_amount
    FROM orders"""


@query("validate_orders", with_parts("SELECT * FROM r", r=ORDER_ROWS))
def validate_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _result(_classified(model.ORDERS, spark, sf_dir), "order_date", "total_amount")


ITEM_ROWS = """
    SELECT order_item_id AS row_id, CASE kind
               WHEN '4R' THEN 'order_item_id_invalid' WHEN '1R' THEN 'order_id_invalid'
               WHEN '3R' THEN 'product_id_invalid' WHEN '2R' THEN 'order_date_invalid'
               WHEN '1A' THEN 'quantity_invalid' WHEN '7A' THEN 'quantity_invalid'
               WHEN '5R' THEN 'quantity_invalid' WHEN '2A' THEN 'unit_price_invalid'
               WHEN '3A' THEN 'discount_invalid' WHEN '4A' THEN 'discount_invalid'
               WHEN '7R' THEN 'discount_invalid' END AS reject_reason,
           CASE kind WHEN '1A' THEN 0 WHEN '5R' THEN 0 WHEN '7A' THEN NULL ELSE quantity END
               AS whole_quantity,
           CASE kind WHEN '3A' THEN 99999999.99 WHEN '4A' THEN -1 WHEN '5A' THEN 0
               WHEN '5R' THEN 9999 WHEN '6R' THEN unit_price * quantity
               WHEN '7R' THEN unit_price * quantity + 0.01 ELSE discount END AS discount,
           unit_price, quantity, line_revenue, kind
    FROM (
        SELECT i.*, l.l_linenumber || l.l_returnflag AS kind
        FROM (SELECT l_orderkey * 8 + l_linenumber AS order_item_id, l_linenumber, l_returnflag,
                     l_quantity::INTEGER AS quantity, l_extendedprice::DECIMAL(10,2) AS unit_price,
                     round(l_extendedprice::DECIMAL(10,2) * l_discount::DECIMAL(4,2), 2)
                         ::DECIMAL(10,2) AS discount,
                     (l_extendedprice::DECIMAL(10,2) * l_quantity::INTEGER
                      - round(l_extendedprice::DECIMAL(10,2) * l_discount::DECIMAL(4,2), 2))
                         ::DECIMAL(12,2) AS line_revenue
              FROM lineitem) i,
             (SELECT i.l_linenumber, i.l_returnflag) l
    ) lines"""


@query(
    "validate_order_items",
    with_parts(
        """SELECT row_id, reject_reason, discount::DOUBLE AS discount,
                  (CASE kind WHEN '6A' THEN abs(unit_price * quantity - discount - 1) > 0.011
                       WHEN '5A' THEN abs(line_revenue - unit_price * quantity) > 0.011
                       WHEN '6R' THEN line_revenue > 0.011 ELSE FALSE END) AS total_mismatch
           FROM r WHERE reject_reason IS NULL""",
        r=ITEM_ROWS,
    ),
)
def validate_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = validate.accepted(_classified(model.ORDER_ITEMS, spark, sf_dir))
    return _result(clean, "discount", F.col(MISMATCH).alias("total_mismatch"))


@query(
    "revenue_mismatch",
    with_parts(
        """SELECT count(*) AS rows, count(*) FILTER (
               (kind = '6A' AND abs(unit_price * quantity - discount - 1) > 0.011)
               OR (kind = '5A' AND abs(line_revenue - unit_price * quantity) > 0.011)
               OR (kind = '6R' AND line_revenue > 0.011)) AS mismatched
           FROM r WHERE reject_reason IS NULL""",
        r=ITEM_ROWS,
    ),
)
def revenue_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = validate.accepted(_classified(model.ORDER_ITEMS, spark, sf_dir))
    return clean.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(MISMATCH)).alias("mismatched")
    )


@query(
    "reject_reason_counts",
    with_parts(
        """SELECT entity, reject_reason AS reason, count(*) AS rows FROM (
               SELECT 'product_categories' AS entity, reject_reason FROM c
               UNION ALL SELECT 'products', reject_reason FROM p
               UNION ALL SELECT 'customers', reject_reason FROM k
               UNION ALL SELECT 'orders', reject_reason FROM o
               UNION ALL SELECT 'order_items', reject_reason FROM i) every
           WHERE reject_reason IS NOT NULL GROUP BY ALL""",
        "e_categories",
        "e_products",
        "e_customers",
        c=CATEGORY_ROWS,
        p=PRODUCT_ROWS,
        k=CUSTOMER_ROWS,
        o=ORDER_ROWS,
        i=ITEM_ROWS,
    ),
)
def reject_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        validate.reason_counts(_classified(entity, spark, sf_dir)).select(
            F.lit(entity.name).alias("entity"), "reason", "rows"
        )
        for entity in model.ENTITIES
    ]
    return reduce(DataFrame.unionByName, counts).orderBy(F.col("rows").desc(), "entity", "reason")


@query(
    "orphan_quarantine",
    with_parts(
        """SELECT i.order_item_id, i.order_id, i.product_id, CASE
                  WHEN o.status = 'Returned' THEN 'missing_order_id_order_date'
                  WHEN NOT p.is_active THEN 'missing_product_id' END AS reject_reason
           FROM e_items i JOIN e_orders o ON o.order_id = i.order_id
           JOIN e_products p ON p.product_id = i.product_id""",
        "e_items",
        "e_orders",
        "e_products",
    ),
)
def orphan_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines checked against parents from which returned orders and inactive
    products were left out: the first broken reference is charged."""
    rows = sample.order_items(spark, sf_dir).withColumn(REASON, F.lit(None).cast("string"))
    parents = {
        "orders": sample.orders(spark, sf_dir).filter("status <> 'Returned'"),
        "products": sample.products(spark, sf_dir).filter("is_active"),
    }
    checked = references.check_references(model.ORDER_ITEMS, rows, parents)
    return checked.select(
        "order_item_id", "order_id", "product_id", F.col(REASON).alias("reject_reason")
    )


@query(
    "self_fk_quarantine",
    f"""SELECT {NATION.format("n_nationkey")} AS category_id, {REGION.format("n_regionkey")}
               AS parent_id, CASE WHEN r_name = 'AMERICA' THEN 'missing_parent_id' END
               AS reject_reason
        FROM nation JOIN region ON r_regionkey = n_regionkey
        UNION ALL
        SELECT DISTINCT {SEGMENT}, {NATION.format("c_nationkey")},
               CASE WHEN r_name = 'AMERICA' THEN 'missing_parent_id' END
        FROM customer JOIN nation ON n_nationkey = c_nationkey
        JOIN region ON r_regionkey = n_regionkey
        UNION ALL
        SELECT {REGION.format("r_regionkey")}, NULL, NULL FROM region
        WHERE r_name NOT IN ('AMERICA', 'ASIA')""",
)
def self_fk_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One root is missing and one is stored already: the whole branch below
    the missing root is quarantined, level by level."""
    tree = sample.region_tree(spark, sf_dir)
    staged = tree.filter("parent_id IS NOT NULL OR name NOT IN ('AMERICA', 'ASIA')").withColumn(
        REASON, F.lit(None).cast("string")
    )
    stored = tree.filter("parent_id IS NULL AND name = 'ASIA'")
    checked = references.check_references(model.CATEGORIES, staged, {model.CATEGORIES.name: stored})
    return checked.select("category_id", "parent_id", F.col(REASON).alias("reject_reason"))


@query(
    "unique_quarantine",
    with_parts(
        """SELECT product_id, sku, CASE WHEN product_id <> min(product_id) OVER (PARTITION BY sku)
                  THEN 'duplicate_sku' END AS reject_reason
           FROM (SELECT product_id, name AS sku FROM e_products) renamed""",
        "e_products",
    ),
)
def unique_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products that take their (far from unique) name as SKU: the lowest id keeps it."""
    rows = (
        sample.products(spark, sf_dir)
        .withColumn("sku", F.col("name"))
        .withColumn(REASON, F.lit(None).cast("string"))
    )
    checked = references.check_unique(model.PRODUCTS, rows, rows.limit(0))
    return checked.select("product_id", "sku", F.col(REASON).alias("reject_reason"))


CHAIN_KIND = "CASE WHEN inventory_count = 7 THEN 'stays' WHEN inventory_count % 10 = 3 THEN 'moves' END"


@query(
    "unique_chain",
    with_parts(
        """SELECT product_id, wanted AS sku, CASE WHEN kind IS NULL AND coalesce(
                  first_value(kind IGNORE NULLS) OVER (PARTITION BY category_id ORDER BY product_id
                      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING),
                  first_value(kind IGNORE NULLS) OVER (PARTITION BY category_id ORDER BY product_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) = 'stays'
                  THEN 'duplicate_sku' END AS reject_reason
           FROM c QUALIFY kind IS DISTINCT FROM 'stays'""",
        "e_products",
        c=f"""SELECT product_id, category_id, {CHAIN_KIND} AS kind,
                     CASE WHEN inventory_count % 10 = 3 THEN 'NEW-' || product_id
                         ELSE coalesce(lead(sku) OVER within, first_value(sku) OVER within) END AS wanted
              FROM e_products WINDOW within AS (PARTITION BY category_id ORDER BY product_id)""",
    ),
)
def unique_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every product of a category takes the next one's SKU, the last one the first's.

    Some take a new SKU, which frees theirs; some are not in the batch, so the rows
    that wait for theirs lose, one after the other. Rings without either exchange.
    """
    stored = sample.products(spark, sf_dir)
    within = Window.partitionBy("category_id").orderBy("product_id")
    wanted = F.coalesce(F.lead("sku").over(within), F.first("sku").over(within))
    fresh = F.concat(F.lit("NEW-"), F.col("product_id"))
    rows = (
        stored.withColumn("sku", F.when(F.col("inventory_count") % 10 == 3, fresh).otherwise(wanted))
        .filter("inventory_count <> 7")
        .withColumn(REASON, F.lit(None).cast("string"))
    )
    checked = references.check_unique(model.PRODUCTS, rows, stored)
    return checked.select("product_id", "sku", F.col(REASON).alias("reject_reason"))


def entity_tables(spark: SparkSession, sf_dir: str) -> audits.Tables:
    return {
        "product_categories": sample.categories(spark, sf_dir),
        "products": sample.products(spark, sf_dir),
        "customers": sample.customers(spark, sf_dir),
        "orders": sample.orders(spark, sf_dir),
        "order_items": sample.order_items(spark, sf_dir),
    }


def counts_sql(pairs: dict[str, str], column: str = "check") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS \"{column}\", ({sql})::BIGINT AS violations" for name, sql in pairs.items()
    )


CONSTRAINT_COUNTS = {
    "products_price_non_negative": "SELECT count(*) FROM e_products WHERE price < 0",
    "products_cost_non_negative": "SELECT count(*) FROM e_products WHERE cost < 0",
    "products_inventory_non_negative": "SELECT count(*) FROM e_products WHERE inventory_count < 0",
    "products_weight_non_negative": "SELECT count(*) FROM e_products WHERE weight < 0",
    "customers_email_shape": "SELECT count(*) FROM e_customers WHERE email NOT LIKE '%_@_%.__%'",
    "category_not_self_parent": "SELECT count(*) FROM e_categories WHERE parent_id = category_id",
    "orders_total_non_negative": "SELECT count(*) FROM e_orders WHERE total_amount < 0",
    "orders_date_sequence": """SELECT count(*) FROM e_orders WHERE processing_date < order_date
        OR shipping_date < processing_date OR delivery_date < shipping_date""",
    "order_items_quantity_positive": "SELECT count(*) FROM e_items WHERE quantity <= 0",
    "order_items_price_non_negative": "SELECT count(*) FROM e_items WHERE unit_price < 0",
    "order_items_discount_valid": """SELECT count(*) FROM e_items
        WHERE discount < 0 OR discount > unit_price * quantity""",
}
ENTITY_PARTS = ("e_categories", "e_products", "e_customers", "e_orders", "e_items")


@query("constraint_audit", with_parts(counts_sql(CONSTRAINT_COUNTS), *ENTITY_PARTS))
def constraint_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.constraints(entity_tables(spark, sf_dir))


def _duplicate_sql(table: str, key: str) -> str:
    return f"SELECT count(*) FROM (SELECT 1 FROM {table} GROUP BY {key} HAVING count(*) > 1) d"


UNIQUENESS_COUNTS = {
    "product_categories.category_id": _duplicate_sql("e_categories", "category_id"),
    "products.product_id": _duplicate_sql("e_products", "product_id"),
    "products.sku": _duplicate_sql("e_products", "sku"),
    "customers.customer_id": _duplicate_sql("e_customers", "customer_id"),
    "customers.email": _duplicate_sql("e_customers", "email"),
    "orders.order_id+order_date": _duplicate_sql("e_orders", "order_id, order_date"),
    "order_items.order_item_id+order_date": _duplicate_sql("e_items", "order_item_id, order_date"),
}


@query("uniqueness_audit", with_parts(counts_sql(UNIQUENESS_COUNTS), *ENTITY_PARTS))
def uniqueness_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.uniqueness(entity_tables(spark, sf_dir))


def _missing(child: str, columns: str, parent: str, parent_columns: str) -> str:
    match = " AND ".join(
        f"p.{b.strip()} = c.{a.strip()}" for a, b in zip(columns.split(","), parent_columns.split(","))
    )
    return f"""SELECT count(*) FROM {child} c WHERE c.{columns.split(",")[0]} IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE {match})"""


PER_ORDER = """(SELECT o.order_id, o.total_amount, sum(i.line_revenue) AS line_sum,
    count(i.order_id) AS lines FROM e_orders o LEFT JOIN e_items i
    ON i.order_id = o.order_id AND i.order_date = o.order_date GROUP BY ALL) per_order"""
PAYING = "status NOT IN ('Cancelled', 'Returned')"
CONTRACT_COUNTS = {
    "category_parent_missing": _missing("e_categories", "parent_id", "e_categories", "category_id"),
    "product_category_missing": _missing("e_products", "category_id", "e_categories", "category_id"),
    "order_customer_missing": _missing("e_orders", "customer_id", "e_customers", "customer_id"),
    "item_order_missing": _missing("e_items", "order_id,order_date", "e_orders", "order_id,order_date"),
    "item_product_missing": _missing("e_items", "product_id", "e_products", "product_id"),
    "category_too_deep": "SELECT count(*) FROM e_closure WHERE depth > 2",
    **{f"duplicate {name}": sql for name, sql in UNIQUENESS_COUNTS.items()},
    "item_date_differs": """SELECT count(*) FROM e_items i JOIN e_orders o
        ON o.order_id = i.order_id WHERE o.order_date <> i.order_date""",
    "order_before_registration": """SELECT count(*) FROM e_orders o JOIN e_customers c
        ON c.customer_id = o.customer_id WHERE o.order_date < c.registration_date""",
    "item_quantity": CONSTRAINT_COUNTS["order_items_quantity_positive"],
    "item_discount": CONSTRAINT_COUNTS["order_items_discount_valid"],
    "item_money": "SELECT count(*) FROM e_items WHERE unit_price < 0 OR line_revenue < 0",
    "line_total_mismatch": """SELECT count(*) FROM e_items
        WHERE abs(unit_price * quantity - discount - line_revenue) > 0.011""",
    "order_money": CONSTRAINT_COUNTS["orders_total_non_negative"],
    "order_dates_not_monotone": CONSTRAINT_COUNTS["orders_date_sequence"],
    "order_status_unknown": """SELECT count(*) FROM e_orders WHERE status NOT IN ('Pending',
        'Processing', 'Shipped', 'In Transit', 'Delivered', 'Cancelled', 'Returned')""",
    "order_date_out_of_range": """SELECT count(*) FROM e_orders
        WHERE order_date < TIMESTAMP '1995-02-01' OR order_date >= TIMESTAMP '2001-07-01'""",
    "order_total_mismatch": f"SELECT count(*) FROM {PER_ORDER} WHERE abs(total_amount - line_sum) > 0.011",
    "order_without_lines": f"SELECT count(*) FROM {PER_ORDER} WHERE lines = 0",
    "mean_lines_out_of_band": f"""SELECT (sum(lines) / count(*) NOT BETWEEN 3.5 AND 4.7)::BIGINT
        FROM {PER_ORDER} WHERE lines > 0""",
    "rollup_vs_lines": f"""SELECT (100 * abs((SELECT sum(net_revenue) FROM e_daily)
        - (SELECT sum(line_revenue) FROM e_items i JOIN e_orders o ON o.order_id = i.order_id
           WHERE {PAYING})))::BIGINT""",
    "lifetime_value_vs_orders": f"""SELECT (100 * abs((SELECT sum(lifetime_value) FROM e_metrics)
        - (SELECT sum(total_amount) FROM e_orders WHERE {PAYING})))::BIGINT""",
    "month_totals_vs_days": f"""SELECT (100 * sum(abs(coalesce(d.total, 0) - coalesce(l.total, 0))))::BIGINT FROM (
        SELECT strftime(sale_date, '%Y-%m') AS month, sum(net_revenue) AS total FROM e_daily GROUP BY 1) d
        FULL JOIN (SELECT strftime(i.order_date, '%Y-%m') AS month, sum(line_revenue) AS total
            FROM e_items i JOIN e_orders o ON o.order_id = i.order_id WHERE {PAYING} GROUP BY 1) l
        ON l.month = d.month""",
}


@query(
    "contract_audit",
    with_parts(counts_sql(CONTRACT_COUNTS), *ENTITY_PARTS, "e_closure", "e_daily", "e_metrics"),
)
def contract_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.contracts(
        entity_tables(spark, sf_dir),
        daily(spark, sf_dir),
        metrics(spark, sf_dir),
        closure(spark, sf_dir),
        "1995-02-01",
        "2001-06-30",
    )
