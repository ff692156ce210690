"""Shared oracle SQL: the entity mapping as DuckDB common table expressions.

Money is kept in DECIMAL and cast to DOUBLE only in a final projection.
"""

from __future__ import annotations

REVENUE = "status NOT IN ('Cancelled', 'Returned')"


def text_id(expr: str) -> str:
    return f"('0x' || substr(md5({expr}), 1, 15))::BIGINT"


PARTS = {
    "e_categories": f"""
        SELECT DISTINCT {text_id("p_type")} AS category_id, p_type AS name,
               NULL::VARCHAR AS description, NULL::BIGINT AS parent_id
        FROM part
        UNION ALL
        SELECT DISTINCT {text_id("p_type || '/' || p_brand")}, p_type || ' - ' || p_brand,
               p_brand, {text_id("p_type")}
        FROM part""",
    "e_closure": f"""
        SELECT DISTINCT {text_id("p_type")} AS category_id, p_type AS name,
               NULL::BIGINT AS parent_id, {text_id("p_type")} AS root_category_id,
               p_type AS root_category_name, 1 AS depth
        FROM part
        UNION ALL
        SELECT DISTINCT {text_id("p_type || '/' || p_brand")}, p_type || ' - ' || p_brand,
               {text_id("p_type")}, {text_id("p_type")}, p_type, 2
        FROM part""",
    "e_products": f"""
        SELECT p_partkey + 1 AS product_id, p_name AS name,
               p_brand || ' ' || p_type AS description,
               p_retailprice::DECIMAL(10,2) AS price,
               (p_retailprice::DECIMAL(10,2) - 100)::DECIMAL(10,2) AS cost,
               {text_id("p_type || '/' || p_brand")} AS category_id,
               'SKU-' || p_partkey AS sku, p_size::INTEGER AS inventory_count,
               p_size::DECIMAL(8,2) AS weight, p_size % 10 <> 0 AS is_active,
               TIMESTAMP '1995-01-01' + to_days(p_size::INTEGER) AS created_at
        FROM part""",
    "e_customers": """
        SELECT c_custkey + 1 AS customer_id,
               lower(replace(c_name, '#', '.')) || '@example.com' AS email,
               'Customer' AS first_name, c_name AS last_name, c_mktsegment AS city,
               r_name AS state, n_name AS country,
               TIMESTAMP '1995-01-01' + to_days(c_nationkey::INTEGER) AS registration_date
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "e_orders": """
        SELECT order_id, customer_id, order_date, status, payment_method, shipping_address,
               'Springfield' AS shipping_city, 'IL' AS shipping_state, '62701' AS shipping_zip,
               'USA' AS shipping_country,
               CASE WHEN status IN ('Shipped', 'Delivered', 'Returned', 'Processing')
                    THEN order_date + INTERVAL 1 DAY END AS processing_date,
               CASE WHEN status IN ('Shipped', 'Delivered', 'Returned')
                    THEN order_date + INTERVAL 2 DAY END AS shipping_date,
               CASE WHEN status IN ('Delivered', 'Returned')
                    THEN order_date + INTERVAL 5 DAY END AS delivery_date,
               total_amount
        FROM (
            SELECT o_orderkey + 1 AS order_id, o_custkey + 1 AS customer_id,
                   o_orderdate::TIMESTAMP AS order_date,
                   CASE WHEN o_orderstatus = 'O' THEN 'Shipped'
                        WHEN o_orderstatus = 'P' THEN 'Processing'
                        WHEN o_orderpriority = '5-LOW' THEN 'Cancelled'
                        WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Returned'
                        ELSE 'Delivered' END AS status,
                   CASE substr(o_orderpriority, 1, 1)
                        WHEN '1' THEN 'Credit Card' WHEN '2' THEN 'PayPal'
                        WHEN '3' THEN 'Apple Pay' WHEN '4' THEN 'Google Pay'
                        ELSE 'Gift Card' END AS payment_method,
                   'Dock ' || o_custkey AS shipping_address,
                   o_totalprice::DECIMAL(12,2) AS total_amount
            FROM orders
        ) mapped""",
    "e_items": """
        SELECT order_item_id, order_id, order_date, product_id, quantity, unit_price, discount,
               (unit_price * quantity - discount)::DECIMAL(12,2) AS line_revenue
        FROM (
            SELECT l_orderkey * 8 + l_linenumber AS order_item_id, l_orderkey + 1 AS order_id,
                   o_orderdate::TIMESTAMP AS order_date, l_partkey + 1 AS product_id,
                   l_quantity::INTEGER AS quantity,
                   l_extendedprice::DECIMAL(10,2) AS unit_price,
                   round(l_extendedprice::DECIMAL(10,2) * l_discount::DECIMAL(4,2), 2)
                       ::DECIMAL(10,2) AS discount
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        ) mapped""",
    "e_daily": f"""
        SELECT s.sale_date, strftime(s.sale_date, '%Y%m%d')::INTEGER AS date_key, s.product_id,
               p.category_id, s.units_sold, s.gross_revenue, s.discount_total, s.net_revenue,
               s.order_count,
               ((2 * (s.gross_revenue * 100)::HUGEINT + s.units_sold) // (2 * s.units_sold))
                   ::BIGINT / 100.0 AS avg_unit_price
        FROM (
            SELECT i.order_date::DATE AS sale_date, i.product_id,
                   sum(i.quantity)::BIGINT AS units_sold,
                   sum(i.unit_price * i.quantity) AS gross_revenue,
                   sum(i.discount) AS discount_total, sum(i.line_revenue) AS net_revenue,
                   count(DISTINCT i.order_id)::INTEGER AS order_count
            FROM e_items i JOIN e_orders o
              ON o.order_id = i.order_id AND o.order_date = i.order_date
            WHERE {REVENUE} GROUP BY 1, 2
        ) s JOIN e_products p ON p.product_id = s.product_id""",
    "e_metrics": f"""
        SELECT c.customer_id, coalesce(a.n, 0)::INTEGER AS total_orders,
               coalesce(a.value, 0)::DECIMAL(18,2) AS lifetime_value,
               CASE WHEN a.n > 0
                    THEN ((2 * (a.value * 100)::HUGEINT + a.n) // (2 * a.n))::BIGINT / 100.0
                    ELSE 0.0 END AS avg_order_value,
               a.first_order_date, a.last_order_date,
               CASE WHEN a.n > 1 THEN
                   ((2 * 100 * a.span_days + (a.n - 1)) // (2 * (a.n - 1)))::BIGINT / 100.0
               END AS avg_days_between_orders
        FROM e_customers c LEFT JOIN (
            SELECT customer_id, count(*) AS n, sum(total_amount) AS value,
                   min(order_date) AS first_order_date, max(order_date) AS last_order_date,
                   date_diff('day', min(order_date), max(order_date)) AS span_days
            FROM e_orders WHERE {REVENUE} GROUP BY 1
        ) a ON a.customer_id = c.customer_id""",
}

NEEDS = {
    "e_daily": ("e_items", "e_orders", "e_products"),
    "e_metrics": ("e_customers", "e_orders"),
}


def with_parts(body: str, *names: str, **extra: str) -> str:
    """``body`` preceded by the named expressions, what they need, and extras."""
    ordered: list[str] = []
    for name in names:
        for part in (*NEEDS.get(name, ()), name):
            if part not in ordered:
                ordered.append(part)
    parts = [f"{name} AS ({PARTS[name]})" for name in ordered]
    parts += [f"{name} AS ({sql})" for name, sql in extra.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body
