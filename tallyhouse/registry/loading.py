"""Upsert, updates, deletes and incremental operators over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse import model
from tallyhouse.functions.predicates import revenue_bearing
from tallyhouse.operators import merge, rollups, updates
from tallyhouse.plans import incremental
from tallyhouse.registry import query
from tallyhouse.registry.common import END, START, daily, metrics, plain
from tallyhouse.registry.oracle import with_parts
from tallyhouse.registry.sales import DAILY_COLUMNS, IN_PERIOD, METRIC_COLUMNS
from tallyhouse.sources import sample

NOW = "2002-01-01 00:00:00"

LINE_ORDER = (
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)


@query(
    "dedupe_last",
    f"""SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY {", ".join(f"{c} DESC" for c in LINE_ORDER)}) AS rn FROM lineitem) r
        WHERE rn = 1""",
)
def dedupe_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last restatement of each line; the lines repeat their key for real."""
    lines = sample.table(spark, sf_dir, "lineitem")
    order = [F.col(c).desc() for c in LINE_ORDER]
    return merge.last_per_key(lines, ["l_orderkey", "l_linenumber"], order)


def _stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders before 1999, as loaded on their own day."""
    return (
        sample.orders(spark, sf_dir)
        .filter("order_date < TIMESTAMP '1999-01-01'")
        .withColumn("created_at", F.col("order_date"))
        .withColumn("updated_at", F.col("order_date"))
    )


def _staged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders from 1998 on, with the ones in process now shipped."""
    shipped = F.when(F.col("status") == "Processing", "Shipped").otherwise(F.col("status"))
    return (
        sample.orders(spark, sf_dir)
        .filter("order_date >= TIMESTAMP '1998-01-01'")
        .withColumn("status", shipped)
    )


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge(
        _stored_orders(spark, sf_dir),
        _staged_orders(spark, sf_dir),
        model.ORDERS.key,
        model.ORDERS.update_columns,
        NOW,
    )


MERGED = f"""
    SELECT order_id, order_date, customer_id, total_amount::DOUBLE AS total_amount,
           CASE WHEN order_date >= TIMESTAMP '1998-01-01' AND status = 'Processing' THEN 'Shipped'
                ELSE status END AS status,
           CASE WHEN order_date < TIMESTAMP '1999-01-01' THEN order_date
                ELSE TIMESTAMP '{NOW}' END AS created_at,
           CASE WHEN order_date < TIMESTAMP '1998-01-01' THEN order_date
                WHEN order_date < TIMESTAMP '1999-01-01' AND status <> 'Processing' THEN order_date
                ELSE TIMESTAMP '{NOW}' END AS updated_at,
           CASE WHEN order_date < TIMESTAMP '1998-01-01' THEN 'keep'
                WHEN order_date < TIMESTAMP '1999-01-01' THEN 'update' ELSE 'insert' END AS change
    FROM e_orders"""


@query("upsert_merge", with_parts("SELECT * FROM merged", "e_orders", merged=MERGED))
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        _merged(spark, sf_dir).select(
            "order_id",
            "order_date",
            "customer_id",
            "total_amount",
            "status",
            "created_at",
            "updated_at",
            F.col(merge.CHANGE).alias("change"),
        )
    )


@query(
    "upsert_counts",
    with_parts(
        """SELECT count(*) FILTER (change = 'insert') AS inserted,
                  count(*) FILTER (change = 'update') AS updated FROM merged""",
        "e_orders",
        merged=MERGED,
    ),
)
def upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.change_counts(_merged(spark, sf_dir))


@query(
    "updated_at_change",
    with_parts(
        f"""SELECT change, updated_at = TIMESTAMP '{NOW}' AS moved, count(*) AS rows
            FROM merged GROUP BY ALL""",
        "e_orders",
        merged=MERGED,
    ),
)
def updated_at_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Restated but unchanged orders keep their updated_at."""
    moved = F.col("updated_at") == F.lit(NOW).cast("timestamp")
    return (
        _merged(spark, sf_dir)
        .groupBy(F.col(merge.CHANGE).alias("change"), moved.alias("moved"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query(
    "insert_only",
    with_parts(
        """SELECT order_id, order_date, status FROM merged WHERE change = 'insert'""",
        "e_orders",
        merged=MERGED,
    ),
)
def insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.insert_only(
        _stored_orders(spark, sf_dir), _staged_orders(spark, sf_dir), model.ORDERS.key
    ).select("order_id", "order_date", "status")


@query(
    "cascade_delete",
    with_parts(
        """SELECT 'customers' AS table_name, count(*) AS rows FROM e_customers
               WHERE state <> 'AFRICA'
           UNION ALL SELECT 'customer_metrics', count(*) FROM e_metrics m
               JOIN e_customers c USING (customer_id) WHERE c.state <> 'AFRICA'
           UNION ALL SELECT 'orders', count(*) FROM e_orders o
               JOIN e_customers c USING (customer_id) WHERE c.state <> 'AFRICA'
           UNION ALL SELECT 'order_items', count(*) FROM e_items i
               JOIN e_orders o USING (order_id) JOIN e_customers c USING (customer_id)
               WHERE c.state <> 'AFRICA'""",
        "e_metrics",
        "e_items",
    ),
)
def cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deleting the customers of a region takes metrics, orders and lines along."""
    customers, orders = sample.customers(spark, sf_dir), sample.orders(spark, sf_dir)
    gone = customers.filter("state = 'AFRICA'").select("customer_id")
    gone_orders = orders.join(gone, "customer_id", "left_semi").select("order_id", "order_date")
    left = {
        "customers": merge.delete_keys(customers, gone, ["customer_id"]),
        "customer_metrics": merge.delete_keys(metrics(spark, sf_dir), gone, ["customer_id"]),
        "orders": merge.delete_keys(orders, gone, ["customer_id"]),
        "order_items": merge.delete_keys(
            sample.order_items(spark, sf_dir), gone_orders, ["order_id", "order_date"]
        ),
    }
    result = None
    for name, df in left.items():
        count = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        result = count if result is None else result.unionByName(count)
    return result


def changes_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change row per product of certain sizes, good and bad ones."""
    size = F.col("inventory_count")
    price = F.col("price")

    def only(sizes: list[int], value: object) -> object:
        return F.when(size.isin(*sizes), value)

    return (
        sample.products(spark, sf_dir)
        .filter(size.isin(5, 10, 15, 20, 25, 30, 35, 40, 45, 50))
        .select(
            F.when(size == 40, -F.col("product_id")).otherwise(F.col("product_id")).alias("product_id"),
            only([25, 40], F.concat("name", F.lit(" II"))).alias("name"),
            F.when(size == 5, F.lit(-1)).when(size == 25, price * 2).cast("decimal(10,2)").alias("price"),
            only([35], F.lit(-5)).cast("decimal(10,2)").alias("cost"),
            only([15], F.lit(12345)).cast("bigint").alias("category_id"),
            F.when(size.isin(10, 35), "SKU-0")
            .when(size == 45, F.concat(F.lit("NEW-"), "name"))
            .alias("sku"),
            only([50], F.lit(-1)).cast("decimal(8,2)").alias("weight"),
            only([30], F.lit(False)).alias("is_active"),
        )
    )


OUTCOME = """
    SELECT CASE WHEN inventory_count = 40 THEN -product_id ELSE product_id END AS product_id,
           CASE inventory_count WHEN 20 THEN 'No updatable fields supplied.'
               WHEN 40 THEN 'No product with id -' || product_id || '.'
               WHEN 5 THEN 'Update rejected: chk_products_price_non_negative.'
               WHEN 35 THEN 'Update rejected: chk_products_cost_non_negative.'
               WHEN 50 THEN 'Update rejected: chk_products_weight_non_negative.'
               WHEN 15 THEN 'Update rejected: the referenced category does not exist.'
               WHEN 10 THEN CASE WHEN product_id = 1 THEN 'Product updated.'
                                 ELSE 'Update rejected: that SKU is already in use.' END
               WHEN 45 THEN CASE WHEN product_id = min(product_id) OVER (
                                     PARTITION BY inventory_count, name)
                                 THEN 'Product updated.'
                                 ELSE 'Update rejected: that SKU is already in use.' END
               ELSE 'Product updated.' END AS message,
           product_id AS id, name, price, sku, is_active, inventory_count
    FROM e_products WHERE inventory_count IN (5, 10, 15, 20, 25, 30, 35, 40, 45, 50)"""


@query(
    "update_outcomes",
    with_parts(
        "SELECT product_id, message = 'Product updated.' AS success, message FROM outcome",
        "e_products",
        outcome=OUTCOME,
    ),
)
def update_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return updates.outcomes(
        changes_of(spark, sf_dir), sample.products(spark, sf_dir), sample.categories(spark, sf_dir)
    )


@query(
    "partial_update",
    with_parts(
        """SELECT product_id, CASE WHEN inventory_count = 25 THEN name || ' II' ELSE name END
                  AS name,
                  (CASE WHEN inventory_count = 25 THEN price * 2 ELSE price END)::DOUBLE AS price,
                  CASE inventory_count WHEN 10 THEN 'SKU-0' WHEN 45 THEN 'NEW-' || name
                       ELSE sku END AS sku,
                  CASE WHEN inventory_count = 30 THEN FALSE ELSE is_active END AS is_active
           FROM outcome WHERE message = 'Product updated.'""",
        "e_products",
        outcome=OUTCOME,
    ),
)
def partial_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = updates.apply_updates(
        changes_of(spark, sf_dir), sample.products(spark, sf_dir), sample.categories(spark, sf_dir)
    )
    return plain(changed.select("product_id", "name", "price", "sku", "is_active"))


@query(
    "range_rebuild",
    with_parts(
        f"""SELECT sale_date, product_id, units_sold, net_revenue::DOUBLE AS net_revenue
            FROM e_daily WHERE {IN_PERIOD}
            UNION ALL
            SELECT sale_date, product_id, -1, 0.0 FROM e_daily WHERE NOT ({IN_PERIOD})""",
        "e_daily",
    ),
)
def range_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stale rollup is rebuilt for a day range; other days stay as stored."""
    stored = (
        daily(spark, sf_dir)
        .withColumn("units_sold", F.lit(-1).cast("bigint"))
        .withColumn("net_revenue", F.lit(0).cast("decimal(14,2)"))
    )
    rebuilt = incremental.rebuild_days(stored, daily(spark, sf_dir, START, END), START, END)
    return plain(rebuilt.select("sale_date", "product_id", "units_sold", "net_revenue"))


@query(
    "scoped_customer_refresh",
    with_parts(
        f"""SELECT customer_id, total_orders, {METRIC_COLUMNS} FROM e_metrics
            WHERE customer_id IN (
                SELECT customer_id FROM e_orders
                WHERE order_date >= TIMESTAMP '2001-07-01'
                  AND order_date < TIMESTAMP '2001-08-02')""",
        "e_metrics",
    ),
)
def scoped_customer_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = sample.orders(spark, sf_dir)
    touched = incremental.touched_customers(orders, "2001-07-01", "2001-08-01")
    return plain(rollups.customer_metrics(sample.customers(spark, sf_dir), orders, touched))


@query(
    "touched_customers",
    with_parts(
        f"""SELECT DISTINCT customer_id FROM e_orders
            WHERE order_date >= TIMESTAMP '{START}'
              AND order_date < DATE '{END}' + INTERVAL 1 DAY""",
        "e_orders",
    ),
)
def touched_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.touched_customers(sample.orders(spark, sf_dir), START, END)


@query(
    "orders_in_range",
    with_parts(
        f"""SELECT count(*) AS orders FROM e_orders
            WHERE order_date >= TIMESTAMP '{START}'
              AND order_date < DATE '{END}' + INTERVAL 1 DAY""",
        "e_orders",
    ),
)
def orders_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.orders_in_range(sample.orders(spark, sf_dir), START, END)


@query(
    "order_span",
    """SELECT min(o_orderdate)::DATE AS start, max(o_orderdate)::DATE AS "end" FROM orders""",
)
def order_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.day_span(sample.orders(spark, sf_dir), "order_date")


EVENT_MARK = "2024-01-20 12:00:00"


@query(
    "incremental_filter",
    f"""SELECT event_id, ts::TIMESTAMP AS ts, user_id, event_type, value FROM events
        WHERE ts > TIMESTAMP '{EVENT_MARK}'""",
)
def incremental_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = sample.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    fresh = incremental.newer_than(events, "ts", EVENT_MARK)
    return fresh.select("event_id", "ts", "user_id", "event_type", "value")


@query(
    "late_rows",
    f"""SELECT event_type, count(*) AS late FROM events
        WHERE ts <= TIMESTAMP '{EVENT_MARK}' GROUP BY 1""",
)
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = sample.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    late = incremental.late_rows(events, "ts", EVENT_MARK)
    return late.groupBy("event_type").agg(F.count(F.lit(1)).alias("late"))


def _marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highest watermark per event type of each day, one entry per day."""
    return (
        sample.table(spark, sf_dir, "events")
        .select("event_type", F.col("ts").cast("timestamp").alias("ts"))
        .groupBy(F.col("event_type").alias("entity"), F.to_date("ts").alias("day"))
        .agg(F.max("ts").alias("watermark_ts"))
    )


@query(
    "watermark_merge",
    """SELECT event_type AS entity, max(ts)::TIMESTAMP AS watermark_ts FROM events GROUP BY 1""",
)
def watermark_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watermarks of the first half of the month advanced by those of the
    second half and by replayed older ones."""
    marks = _marks(spark, sf_dir)
    early = marks.filter("day < DATE '2024-01-16'")
    current = early.groupBy("entity").agg(F.max("watermark_ts").alias("watermark_ts"))
    return incremental.advance(current, marks.filter("day >= DATE '2024-01-16'").unionByName(early))


@query(
    "max_watermarks",
    with_parts(
        """SELECT 'customers' AS entity, max(registration_date) AS watermark_ts FROM e_customers
           UNION ALL SELECT 'orders', max(order_date) FROM e_orders
           UNION ALL SELECT 'order_items', max(order_date) FROM e_items""",
        "e_customers",
        "e_orders",
        "e_items",
    ),
)
def max_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = None
    for entity in (model.CUSTOMERS, model.ORDERS, model.ORDER_ITEMS):
        rows = getattr(sample, entity.name)(spark, sf_dir)
        mark = incremental.next_watermark(rows, entity.watermark).select(
            F.lit(entity.name).alias("entity"), "watermark_ts"
        )
        result = mark if result is None else result.unionByName(mark)
    return result


@query(
    "refresh_window",
    """SELECT min(o_orderdate)::DATE AS start, max(o_orderdate)::DATE AS "end",
              count(*) AS orders FROM orders WHERE o_orderdate > TIMESTAMP '2001-05-01'""",
)
def refresh_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days an incremental run must rebuild: those of the orders it loaded."""
    loaded = incremental.newer_than(
        sample.orders(spark, sf_dir), "order_date", "2001-05-01 00:00:00"
    )
    span = incremental.day_span(loaded, "order_date")
    return span.withColumn("orders", loaded.agg(F.count(F.lit(1)).alias("n")).scalar())


@query(
    "line_revenue_audit",
    with_parts(
        """SELECT count(*) AS lines, sum(line_revenue)::DOUBLE AS revenue,
                  sum(abs(line_revenue - (unit_price * quantity - discount)))::DOUBLE AS drift
           FROM e_items""",
        "e_items",
    ),
)
def line_revenue_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = F.col("unit_price") * F.col("quantity") - F.col("discount")
    return plain(
        sample.order_items(spark, sf_dir).agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("line_revenue").alias("revenue"),
            F.sum(F.abs(F.col("line_revenue") - expected)).alias("drift"),
        )
    )


@query(
    "daily_rollup_semi_join",
    with_parts(f"SELECT {DAILY_COLUMNS} FROM e_daily WHERE {IN_PERIOD}", "e_daily"),
)
def daily_rollup_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup as the load job computes it: stored lines against stored orders."""
    items = rollups.in_days(sample.order_items(spark, sf_dir), "order_date", START, END)
    orders = rollups.in_days(sample.orders(spark, sf_dir), "order_date", START, END)
    return plain(
        rollups.daily_sales(rollups.sold_lines(items, orders), sample.products(spark, sf_dir))
    )


@query(
    "revenue_bearing_orders",
    with_parts(
        """SELECT status, status NOT IN ('Cancelled', 'Returned') AS bears_revenue,
                  count(*) AS orders, sum(total_amount)::DOUBLE AS total
           FROM e_orders GROUP BY 1""",
        "e_orders",
    ),
)
def revenue_bearing_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        sample.orders(spark, sf_dir)
        .groupBy("status", revenue_bearing(F.col("status")).alias("bears_revenue"))
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("total"))
    )
