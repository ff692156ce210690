"""What is kept per month or per run, after rounds of changes, beside a full rebuild.

Each query stores the supplied orders, lines and rollup as month tables, changes
some of it, brings the stored results up to date, and returns these. The oracle
states the same changes and computes the results from nothing.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse import model
from tallyhouse.functions.money import from_cents
from tallyhouse.operators import audits, calendar_dim, order_directory, paging, rollups
from tallyhouse.operators.hierarchy import category_closure
from tallyhouse.plans import changes, check_ledger, edits, job, maintained, monitoring, quality, reports, statistics
from tallyhouse.plans.load import EntityReport
from tallyhouse.registry import query
from tallyhouse.registry.cleaning import ENTITY_PARTS, _duplicate_sql
from tallyhouse.registry.common import END, START, plain
from tallyhouse.registry.health import HISTORY, _history
from tallyhouse.registry.oracle import PARTS, REVENUE, with_parts
from tallyhouse.registry.sales import METRIC_COLUMNS, PROMO
from tallyhouse.session import remove_scratch, scratch_path
from tallyhouse.sources import sample
from tallyhouse.sources.ledger import SUCCEEDED, RunLedger
from tallyhouse.sources.warehouse import Warehouse
from tallyhouse.streaming import stream_load

NOW = datetime(2001, 7, 15, tzinfo=timezone.utc)
# Changes: lines of one month go, orders of one month go with their lines, totals of one
# month rise, and every order of one month comes back under another id without lines.
NO_LINES, NO_ORDERS, DEARER, COPIED = "1996-02", "1996-08", "1997-03", "1998-05"
FAR = 1_000_000_000


def facts(spark: SparkSession, sf_dir: str, declared: tuple[str, str] = ("1995-01-01", "2001-12-01")) -> Warehouse:
    """The supplied orders and lines as month tables, lines whose keys repeat included."""
    warehouse = Warehouse(spark, scratch_path(spark, "month-tables"), 4, *declared)
    stamp = F.lit(NOW).cast("timestamp")
    for entity, rows in (
        (model.ORDERS, sample.orders(spark, sf_dir)),
        (model.ORDER_ITEMS, sample.order_items(spark, sf_dir)),
    ):
        stamped = rows.withColumns({"created_at": stamp, "updated_at": stamp, "month": warehouse.partition_of(entity)})
        warehouse.replace_partitions(entity.name, stamped, "month", touched=[])
    for entity in (model.CATEGORIES, model.PRODUCTS, model.CUSTOMERS):
        rows = sample.entity_rows(entity, spark, sf_dir).withColumn("shard", warehouse.shard(entity.key[0]))
        warehouse.replace_partitions(entity.name, rows.withColumns({"created_at": stamp, "updated_at": stamp}), "shard")
    return warehouse


def _in_month(warehouse: Warehouse, table: str, month: str) -> DataFrame:
    return warehouse.read(table).filter(F.col("month") == month)


def change(warehouse: Warehouse) -> None:
    """The four changes, each to one month."""
    warehouse.drop_partitions("order_items", "month", [NO_LINES])
    for table in ("order_items", "orders"):
        warehouse.drop_partitions(table, "month", [NO_ORDERS])
    dearer = _in_month(warehouse, "orders", DEARER).withColumn(
        "total_amount", (F.col("total_amount") + F.lit(1).cast("decimal(2,0)")).cast("decimal(12,2)")
    )
    warehouse.replace_partitions("orders", dearer, "month", touched=[DEARER])
    stored = _in_month(warehouse, "orders", COPIED)
    copies = stored.withColumn("order_id", F.col("order_id") + FAR)
    warehouse.replace_partitions("orders", stored.unionByName(copies), "month", touched=[COPIED])


def _month(column: str, month: str) -> str:
    return f"strftime({column}, '%Y-%m') = '{month}'"


COLUMNS = "order_id, customer_id, order_date, status, total_amount"
CHANGED_ORDERS = f"""
    SELECT order_id, customer_id, order_date, status,
           (total_amount + CASE WHEN {_month("order_date", DEARER)} THEN 1 ELSE 0 END)::DECIMAL(12,2) AS total_amount
    FROM e_orders WHERE NOT {_month("order_date", NO_ORDERS)}
    UNION ALL
    SELECT order_id + {FAR}, customer_id, order_date, status, total_amount
    FROM e_orders WHERE {_month("order_date", COPIED)}"""
CHANGED_ITEMS = f"""SELECT * FROM e_items WHERE NOT {_month("order_date", NO_LINES)} AND NOT {_month("order_date", NO_ORDERS)}"""
PER_CHANGED = """(SELECT o.order_id, o.order_date, any_value(o.total_amount) AS total_amount,
        count(i.order_item_id) AS lines, coalesce(sum(i.line_revenue), 0) AS line_sum
    FROM c_orders o LEFT JOIN c_items i ON i.order_id = o.order_id AND i.order_date = o.order_date
    GROUP BY 1, 2)"""
OUTSIDE = "(order_date < TIMESTAMP '1995-03-01' OR order_date >= TIMESTAMP '2001-07-01')"
LEDGER_SQL = {
    "orphan_order_items": """SELECT count(*) FROM c_items i WHERE NOT EXISTS (SELECT 1
        FROM c_orders o WHERE o.order_id = i.order_id AND o.order_date = i.order_date)""",
    "orders_without_items": f"SELECT count(*) FROM {PER_CHANGED} WHERE lines = 0",
    "default_partition_rows": f"""SELECT (SELECT count(*) FROM c_orders WHERE {OUTSIDE})
        + (SELECT count(*) FROM c_items WHERE {OUTSIDE})
        + (SELECT count(*) FROM e_daily WHERE {OUTSIDE.replace("order_date", "sale_date")})""",
    "order_total_mismatch": f"SELECT count(*) FROM {PER_CHANGED} WHERE lines > 0 AND abs(total_amount - line_sum) > 0.02",
    "negative_revenue_lines": "SELECT count(*) FROM c_items WHERE line_revenue < 0",
    "duplicate_customer_emails": _duplicate_sql("e_customers", "lower(email)"),
    "products_without_category": """SELECT count(*) FROM e_products WHERE category_id NOT IN (
        SELECT category_id FROM e_categories)""",
    "future_dated_orders": "SELECT count(*) FROM c_orders WHERE order_date > TIMESTAMP '2001-07-16'",
    "unaggregated_selling_days": f"""SELECT count(*) FROM (
        SELECT DISTINCT order_date::DATE AS d FROM c_orders WHERE {REVENUE}
        EXCEPT SELECT DISTINCT sale_date FROM e_daily) missing""",
}
LEDGER_RESULTS = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS check_name, ({sql})::DOUBLE AS observed" for name, sql in LEDGER_SQL.items()
)


@query(
    "check_ledger_changes",
    with_parts(
        """SELECT check_name, observed, observed <= 0 AS passed,
                  (SELECT count(DISTINCT strftime(order_date, '%Y-%m')) FROM e_orders
                   WHERE strftime(order_date, '%Y-%m') IN ('1996-02', '1996-08', '1997-03', '1998-05')) AS months_read
           FROM results""",
        *ENTITY_PARTS,
        "e_daily",
        c_orders=CHANGED_ORDERS,
        c_items=CHANGED_ITEMS,
        results=LEDGER_RESULTS,
    ),
)
def check_ledger_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts after four months changed, and how many months were read for them."""
    warehouse = facts(spark, sf_dir, ("1995-03-01", "2001-06-01"))
    changes.refresh_changed_months(warehouse, NOW)
    check_ledger.refresh(warehouse)
    change(warehouse)
    months = check_ledger.refresh(warehouse)
    verdicts = quality.results(check_ledger.observations(warehouse, NOW))
    return verdicts.select("check_name", "observed", "passed", F.lit(len(months)).cast("bigint").alias("months_read"))


LATE = ("1995-07", "1999-11")


@query(
    "rollup_changed_months",
    with_parts(
        f"""SELECT strftime(i.order_date, '%Y-%m') AS month, sum(i.quantity)::BIGINT AS units,
                   sum(i.line_revenue)::DOUBLE AS net_revenue,
                   strftime(i.order_date, '%Y-%m') IN {LATE} AS rebuilt
            FROM (SELECT * EXCLUDE (quantity, line_revenue),
                      (quantity + CASE WHEN strftime(order_date, '%Y-%m') IN {LATE} THEN 1 ELSE 0 END)::INTEGER AS quantity,
                      (line_revenue + CASE WHEN strftime(order_date, '%Y-%m') IN {LATE} THEN unit_price ELSE 0 END)
                          AS line_revenue FROM e_items) i
            JOIN e_orders o ON o.order_id = i.order_id AND o.order_date = i.order_date
            JOIN e_products p ON p.product_id = i.product_id
            WHERE {REVENUE} GROUP BY ALL""",
        "e_orders",
        "e_items",
        "e_products",
    ),
)
def rollup_changed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late edits of lines in two months; a third one is rewritten with equal rows and stays."""
    warehouse = facts(spark, sf_dir)
    changes.refresh_changed_months(warehouse, NOW)
    for month in LATE:
        more = F.col("quantity") + 1
        edited = _in_month(warehouse, "order_items", month).withColumns(
            {"quantity": more, "line_revenue": (F.col("line_revenue") + F.col("unit_price")).cast("decimal(12,2)")}
        )
        warehouse.replace_partitions("order_items", edited, "month", touched=[month])
    same = _in_month(warehouse, "order_items", COPIED)
    warehouse.replace_partitions("order_items", same.orderBy(F.rand(1)), "month", touched=[COPIED])
    months = changes.refresh_changed_months(warehouse, NOW)
    totals = warehouse.read("daily_sales").groupBy("month").agg(
        F.sum("units_sold").alias("units"), F.sum("net_revenue").alias("net_revenue")
    )
    return plain(totals.withColumn("rebuilt", F.col("month").isin(*months)))


CHANGED_DAILY = f"""
    SELECT i.order_date::DATE AS sale_date, i.product_id, sum(i.quantity)::BIGINT AS units_sold,
           sum(i.line_revenue) AS net_revenue, sum(i.discount) AS discount_total,
           count(DISTINCT i.order_id) AS order_count
    FROM c_items i JOIN c_orders o ON o.order_id = i.order_id AND o.order_date = i.order_date
    WHERE {REVENUE} GROUP BY 1, 2"""


def _three_rounds(warehouse: Warehouse, kept: maintained.Maintained) -> None:
    """Everything, then the four changes, then nothing, then the first and the last month go."""
    changes.refresh_changed_months(warehouse, NOW)
    maintained.refresh(warehouse, kept)
    change(warehouse)
    changes.refresh_changed_months(warehouse, NOW)
    maintained.refresh(warehouse, kept)
    if maintained.refresh(warehouse, kept):
        raise ValueError("months were aggregated without a change")
    months = warehouse.partitions("orders", "month")
    for table in ("order_items", "orders"):
        warehouse.drop_partitions(table, "month", [months[0], months[-1]])
    changes.refresh_changed_months(warehouse, NOW)
    maintained.refresh(warehouse, kept)


WITHOUT_ENDS = """SELECT * FROM {table} WHERE strftime(order_date, '%Y-%m') NOT IN (
    (SELECT min(strftime(order_date, '%Y-%m')) FROM e_orders), (SELECT max(strftime(order_date, '%Y-%m')) FROM e_orders))"""


@query(
    "maintained_product_totals",
    with_parts(
        """SELECT p.product_id, p.sku, r.root_category_name, coalesce(sum(d.units_sold), 0)::BIGINT AS total_units_sold,
                  coalesce(sum(d.net_revenue), 0)::DOUBLE AS total_revenue,
                  coalesce(sum(d.discount_total), 0)::DOUBLE AS total_discount,
                  coalesce(sum(d.order_count), 0)::BIGINT AS order_count,
                  min(d.sale_date) AS first_sale_date, max(d.sale_date) AS last_sale_date
           FROM e_products p JOIN e_closure r USING (category_id) LEFT JOIN c_daily d ON d.product_id = p.product_id
           GROUP BY 1, 2, 3""",
        "e_orders",
        "e_items",
        "e_products",
        "e_closure",
        a_orders=CHANGED_ORDERS,
        a_items=CHANGED_ITEMS,
        c_orders=WITHOUT_ENDS.format(table="a_orders"),
        c_items=WITHOUT_ENDS.format(table="a_items"),
        c_daily=CHANGED_DAILY,
    ),
)
def maintained_product_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = facts(spark, sf_dir)
    _three_rounds(warehouse, maintained.PRODUCTS)
    totals = warehouse.read("product_totals").withColumns(
        {"revenue": from_cents(F.col("revenue_cents")), "discount": from_cents(F.col("discount_cents"))}
    )
    categories = warehouse.read("product_categories")
    summary = rollups.summary_of(totals, warehouse.read("products"), categories, category_closure(categories))
    return plain(summary.drop("product_name", "category_id", "category_name", "root_category_id"))


@query(
    "maintained_customer_metrics",
    with_parts(
        f"SELECT customer_id, total_orders, {METRIC_COLUMNS} FROM c_metrics",
        "e_orders",
        "e_customers",
        a_orders=CHANGED_ORDERS,
        c_orders=WITHOUT_ENDS.format(table="a_orders"),
        c_metrics=PARTS["e_metrics"].replace("e_orders", "c_orders"),
    ),
)
def maintained_customer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = facts(spark, sf_dir)
    _three_rounds(warehouse, maintained.CUSTOMERS)
    totals = warehouse.read("customer_totals").withColumn("value", from_cents(F.col("value_cents")))
    return plain(rollups.metrics_of(warehouse.read("customers").select("customer_id"), totals))


@query(
    "stream_batch_repeated",
    with_parts(
        """SELECT 'run_events' AS kind, 2::BIGINT AS n, 'succeeded' AS status FROM (SELECT count(*) FROM e_orders) t
           UNION ALL SELECT 'check_results', 9, 'succeeded'
           UNION ALL SELECT 'orders', count(*), 'succeeded' FROM e_orders
           UNION ALL SELECT 'rows_extracted', count(*), 'succeeded' FROM e_orders""",
        "e_orders",
    ),
)
def stream_batch_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream whose only batch runs twice, since its commit in the checkpoint is lost."""
    source, checkpoint = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-checkpoint")
    warehouse = Warehouse(spark, scratch_path(spark, "stream-tables"), 4)
    text = sample.source_text(model.ORDERS, sample.orders(spark, sf_dir))
    text.write.parquet(source)
    customers = sample.customers(spark, sf_dir).withColumn("shard", warehouse.shard("customer_id"))
    stamp = F.lit(NOW).cast("timestamp")
    warehouse.replace_partitions("customers", customers.withColumns({"created_at": stamp, "updated_at": stamp}), "shard")
    for _ in range(2):
        rows = spark.readStream.schema(text.schema).parquet(source)
        stream_load.start_load(warehouse, model.ORDERS, rows, checkpoint, blocking=False).awaitTermination()
        remove_scratch(spark, f"{checkpoint}/commits/0")
        remove_scratch(spark, f"{checkpoint}/commits/.0.crc")
    remove_scratch(spark, source)
    ledger = RunLedger(warehouse)
    history = monitoring.run_history(ledger.events())
    status = history.select("status").distinct()
    counted = [
        ledger.events().agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("run_events")),
        ledger.committed("check_results").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("check_results")),
        warehouse.read("orders").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("orders")),
        history.agg(F.sum("rows_extracted").alias("n")).withColumn("kind", F.lit("rows_extracted")),
    ]
    return audits.stacked(counted).withColumn("status", status.scalar()).select("kind", "n", "status")


@query(
    "gate_holds_watermarks",
    with_parts(
        """SELECT 'blocked' AS step, 'orders' AS entity, NULL::TIMESTAMP AS watermark_ts, 'failed' AS status
           UNION ALL SELECT 'passed', 'orders', (SELECT max(order_date) FROM e_orders), 'succeeded'
           UNION ALL SELECT 'passed, then marked failed', 'orders', (SELECT max(order_date) FROM e_orders), 'failed'""",
        "e_orders",
    ),
)
def gate_holds_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that a blocking check stops, one that passes, and one marked failed by its id alone."""
    warehouse = facts(spark, sf_dir)
    changes.refresh_changed_months(warehouse, NOW)
    ledger, out = RunLedger(warehouse), []
    newest = warehouse.read("orders").agg(F.max("order_date")).first()[0]
    stray = _in_month(warehouse, "orders", DEARER).withColumns(
        {"order_date": F.lit("2045-01-01").cast("timestamp"), "month": F.lit("2045-01")}
    )
    for run_id, step in ((1, "blocked"), (2, "passed"), (3, "passed, then marked failed")):
        report = job.RunReport(run_id, ledger.begin(run_id, "by_month", sf_dir))
        report.entities = [EntityReport("orders", watermark=newest)]
        if step == "blocked":
            warehouse.replace_partitions("orders", stray, "month", touched=["2045-01"])
        try:
            # Line keys repeat in the supplied tables, which no check here looks at.
            verdicts = job.check(warehouse, run_id, report.attempt, NOW, ["default_partition_rows", "orphan_order_items"])
            report.blocking = quality.gate(verdicts)
            job.finalise(warehouse, report, NOW, blocking=True)
        except quality.QualityGateError as error:
            job.mark_failed(warehouse, report, error)
            warehouse.drop_partitions("orders", "month", ["2045-01"])
        if run_id == 3:
            RunLedger(Warehouse(spark, warehouse.root)).mark_failed(run_id, "found wrong afterwards")
        out.append((step, "orders", job.read_watermark(warehouse, "orders"), run_id))
    steps = spark.createDataFrame(out, "step string, entity string, watermark_ts timestamp, run_id bigint")
    history = monitoring.run_history(ledger.events()).select("run_id", "status")
    return steps.join(history, "run_id").drop("run_id")


@query(
    "run_constraints",
    with_parts(
        """SELECT 'run_finished' AS "check", count(*) FILTER ((status = 'running') <> (finished_at IS NULL)) AS violations
           FROM h""",
        h=HISTORY,
    ),
)
def run_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.run_constraints(_history(spark, sf_dir))


@query(
    "rows_outside_seeded_months",
    """SELECT date_trunc('month', moment)::DATE AS month_start, count(*) AS row_count
       FROM (SELECT o_orderdate::TIMESTAMP AS moment FROM orders UNION ALL SELECT ts::TIMESTAMP FROM events) every
       WHERE moment < TIMESTAMP '2019-01-01' OR moment >= TIMESTAMP '2031-01-01' GROUP BY 1""",
)
def rows_outside_seeded_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders lie before the seeded range of months, events inside it."""
    orders = sample.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("timestamp").alias("moment"))
    events = sample.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("moment"))
    return calendar_dim.undeclared_rows(orders.unionByName(events), "moment", calendar_dim.declared_months(spark))


TREND_DAILY = f"""
    SELECT i.order_date::DATE AS sale_date, i.product_id, p.category_id, sum(i.quantity)::BIGINT AS units_sold,
           sum(i.line_revenue) AS net_revenue, sum(i.line_revenue + i.discount) AS gross_revenue,
           sum(i.discount) AS discount_total, count(DISTINCT i.order_id) AS order_count
    FROM c_items i JOIN c_orders o ON o.order_id = i.order_id AND o.order_date = i.order_date
    JOIN e_products p ON p.product_id = i.product_id
    WHERE {REVENUE} AND i.order_date::DATE BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY 1, 2, 3"""


def _trend_sql(name: str, unit: str, where: str = "TRUE") -> str:
    return f"""SELECT '{name}' AS trend, date_trunc('{unit}', sale_date)::DATE AS bucket_start,
        sum(units_sold)::BIGINT AS units_sold, sum(net_revenue)::DOUBLE AS net_revenue,
        sum(gross_revenue)::DOUBLE AS gross_revenue, sum(discount_total)::DOUBLE AS discount_total,
        sum(order_count)::BIGINT AS order_count, count(DISTINCT product_id) AS distinct_products
        FROM d WHERE {where} GROUP BY ALL"""


IN_PROMO = f"category_id IN (SELECT category_id FROM e_closure WHERE category_id = {PROMO} OR root_category_id = {PROMO})"
TREND_PARTS = {"c_orders": CHANGED_ORDERS, "c_items": CHANGED_ITEMS, "d": TREND_DAILY}


def _changed_category_days(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Bitmaps of all months, then again of the months that the changes touch."""
    warehouse = facts(spark, sf_dir)
    for step in (lambda: None, lambda: change(warehouse)):
        step()
        changes.refresh_changed_months(warehouse, NOW)
        changes.refresh_category_days(warehouse)
    if changes.refresh_category_days(warehouse):
        raise ValueError("bitmaps were made again without a change")
    return warehouse


@query(
    "sales_trends_from_bitmaps",
    with_parts(
        "\nUNION ALL\n".join(
            [*(_trend_sql(g, g.lower()) for g in reports.GRANULARITIES), _trend_sql("PROMO", "quarter", IN_PROMO)]
        ),
        "e_orders",
        "e_items",
        "e_products",
        "e_closure",
        **TREND_PARTS,
    ),
)
def sales_trends_from_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five granularities and a subtree from the same stored rows, after months changed."""
    warehouse = _changed_category_days(spark, sf_dir)
    days = warehouse.read("product_bits")
    closed = category_closure(warehouse.read("product_categories"))
    trends = {g: reports.sales_trends_stored(days, START, END, g) for g in reports.GRANULARITIES}
    trends["PROMO"] = reports.sales_trends_stored(
        days, START, END, "QUARTER", closed, sample.text_id(F.lit("PROMO"))
    )
    return plain(audits.stacked([t.select(F.lit(name).alias("trend"), "*") for name, t in trends.items()]))


# Pages of all orders, dearest first: the first, one across a border of ranges, a deep one, one
# in the middle and one past the end.
PAGES = {"first": (0, 50), "border": (990, 20), "deep": (10_000, 200), "past": (10_000_000, 10)}


@query(
    "order_directory_pages",
    f"""SELECT p.page, o.order_id, o.total_amount::DOUBLE AS total_amount, o.total_count,
               o.total_count > p.skip + p.size AS has_next_page
        FROM (SELECT o_orderkey + 1 AS order_id, o_totalprice::DECIMAL(12,2) AS total_amount,
                     count(*) OVER () AS total_count,
                     row_number() OVER (ORDER BY o_totalprice::DECIMAL(12,2) DESC NULLS LAST, o_orderkey) AS n
              FROM orders) o
        JOIN (SELECT 'first' AS page, 0 AS skip, 50 AS size UNION ALL SELECT 'border', 990, 20
              UNION ALL SELECT 'deep', 10000, 200 UNION ALL SELECT 'past', 10000000, 10
              UNION ALL SELECT 'last', greatest(count(*) - 7, 0), 50 FROM orders) p
        ON o.n > p.skip AND o.n <= p.skip + p.size""",
)
def order_directory_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of one stored order in ranges of about 1,000 rows."""
    warehouse = Warehouse(spark, scratch_path(spark, "directories"))
    listing = sample.orders(spark, sf_dir).select("order_id", "total_amount")
    order = paging.sort_columns("TOTAL", {"TOTAL": "total_amount"}, True, "order_id")
    order_directory.build(warehouse, "orders", listing, order, rows_per_range=1000)
    last = {"last": (max(listing.count() - 7, 0), 50)}
    return plain(
        audits.stacked(
            [
                order_directory.page(warehouse, "orders", listing, size, skip).select(F.lit(page).alias("page"), "*")
                for page, (skip, size) in (PAGES | last).items()
            ]
        )
    )


def _bounds(table: str, column: str, number: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) AS rows,
        count(*) - count({column}) AS nulls, min({number})::DOUBLE AS low, max({number})::DOUBLE AS high,
        TRUE AS distinct_near, TRUE AS median_near, parts_read
        FROM c_{table}, (SELECT count(DISTINCT strftime(order_date, '%Y-%m')) AS parts_read FROM e_orders
            WHERE strftime(order_date, '%Y-%m') IN {{parts}}) GROUP BY parts_read"""


STATISTICS_OF = {
    "orders": (("order_id", "order_id"), ("customer_id", "customer_id"), ("total_amount", "total_amount"), ("order_date", "epoch_us(order_date)")),
    "items": (("product_id", "product_id"), ("quantity", "quantity"), ("unit_price", "unit_price")),
}


@query(
    "column_statistics_merged",
    with_parts(
        "\nUNION ALL\n".join(
            _bounds(table, column, number).format(parts=parts)
            for table, parts in (("orders", (DEARER, COPIED)), ("items", ("", "")))
            for column, number in STATISTICS_OF[table]
        ),
        "e_orders",
        "e_items",
        c_orders=CHANGED_ORDERS,
        c_items=CHANGED_ITEMS,
    ),
)
def column_statistics_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of whole tables after months changed, from sketches per month.

    Two months of orders are read again, none of the lines, of which months only
    went. Estimates are held against the exact values: distinct counts within 5
    percent (three standard errors), the median's rank within 3 percent of the rows.
    """
    warehouse = facts(spark, sf_dir)
    for table in ("orders", "order_items"):
        statistics.refresh(warehouse, table)
    change(warehouse)
    out = []
    for table, stored in (("orders", "orders"), ("items", "order_items")):
        read = len(statistics.refresh(warehouse, stored))
        rows = warehouse.read(stored)
        for column, _ in STATISTICS_OF[table]:
            number = F.unix_micros(column) if column == "order_date" else F.col(column)
            values = rows.select(number.cast("double").alias("v"), F.col(column).alias("raw"))
            kept = statistics.of_table(warehouse, stored).filter(F.col("column_name") == column)
            one = kept.select("column_name", "rows", "nulls", "low", "high", "distinct_estimate", F.get("quantiles", F.lit(1)).alias("median"))
            median = one.select("median").scalar()
            exact = values.agg(
                F.count_distinct("raw").alias("n"),
                F.count_if(F.col("v") < median).alias("below"),
                F.count_if(F.col("v") <= median).alias("upto"),
            )
            out.append((table, read, one, exact))
    frames = []
    for table, read, one, exact in out:
        near = F.abs(F.col("distinct_estimate") - exact.select("n").scalar()) <= 0.05 * exact.select("n").scalar() + 1
        share = F.col("rows") * 0.5
        slack = F.col("rows") * 0.03 + 1
        median_near = (exact.select("below").scalar() <= share + slack) & (exact.select("upto").scalar() >= share - slack)
        frames.append(
            one.select(
                F.lit(table).alias("table_name"), "column_name", "rows", "nulls", "low", "high",
                near.alias("distinct_near"), median_near.alias("median_near"),
                F.lit(read).cast("bigint").alias("parts_read"),
            )
        )
    return audits.stacked(frames)
