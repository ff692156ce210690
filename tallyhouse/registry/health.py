"""Data-quality checks and run monitoring over the supplied tables.

Run events and check results are derived from the tables: a run is one day of
orders in one state, a check result one day of one event type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.operators.calendar_dim import months_between
from tallyhouse.plans import monitoring, quality
from tallyhouse.registry import query
from tallyhouse.registry.cleaning import ENTITY_PARTS, PAYING, PER_ORDER, _duplicate_sql, entity_tables
from tallyhouse.registry.common import daily
from tallyhouse.registry.oracle import with_parts
from tallyhouse.sources import sample

NOW = "2001-07-15 00:00:00"
OUTSIDE = "(order_date < TIMESTAMP '1995-03-01' OR order_date >= TIMESTAMP '2001-07-01')"
CHECK_SQL = {
    "orphan_order_items": """SELECT count(*) FROM e_items i WHERE NOT EXISTS (SELECT 1
        FROM e_orders o WHERE o.order_id = i.order_id AND o.order_date = i.order_date)""",
    "orders_without_items": f"SELECT count(*) FROM {PER_ORDER} WHERE lines = 0",
    "default_partition_rows": f"""SELECT (SELECT count(*) FROM e_orders WHERE {OUTSIDE})
        + (SELECT count(*) FROM e_items WHERE {OUTSIDE})
        + (SELECT count(*) FROM recent WHERE {OUTSIDE.replace("order_date", "sale_date")})""",
    "order_total_mismatch": f"""SELECT count(*) FROM {PER_ORDER}
        WHERE abs(total_amount - line_sum) > 0.02""",
    "negative_revenue_lines": "SELECT count(*) FROM e_items WHERE line_revenue < 0",
    "duplicate_customer_emails": _duplicate_sql("e_customers", "lower(email)"),
    "products_without_category": """SELECT count(*) FROM e_products WHERE category_id NOT IN (
        SELECT category_id FROM e_categories)""",
    "future_dated_orders": f"""SELECT count(*) FROM e_orders
        WHERE order_date > TIMESTAMP '{NOW}' + INTERVAL 1 DAY""",
    "unaggregated_selling_days": f"""SELECT count(*) FROM (
        SELECT DISTINCT order_date::DATE AS d FROM e_orders WHERE {PAYING}
        EXCEPT SELECT DISTINCT sale_date FROM recent) missing""",
}
SEVERITY = {c.name: c.severity for c in quality.CHECKS}
RESULTS = "\nUNION ALL\n".join(
    f"""SELECT '{name}' AS check_name, '{SEVERITY[name]}' AS severity,
               ({sql})::DOUBLE AS observed, 0.0::DOUBLE AS threshold"""
    for name, sql in CHECK_SQL.items()
)
# Days taken out of the rollup, so that a check fails: as many as sold anything are expected.
MISSING_DAYS = ("1995-04-03", "1996-02-29", "1997-07-04")
RECENT = f"SELECT * FROM e_daily WHERE sale_date NOT IN ({', '.join(f"DATE '{d}'" for d in MISSING_DAYS)})"


def _checked(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> DataFrame:
    """The rollup lacks the planted days, and nothing else."""
    declared = months_between(spark, "1995-03-01", "2001-06-30")
    rollup = daily(spark, sf_dir).filter(~F.col("sale_date").cast("string").isin(*MISSING_DAYS))
    observed = quality.observations(
        entity_tables(spark, sf_dir),
        rollup,
        {"orders": declared, "order_items": declared, "daily_sales": declared},
        NOW,
        names,
    )
    return quality.results(observed)


@query(
    "dq_results",
    with_parts(
        "SELECT *, observed <= threshold AS passed FROM results",
        *ENTITY_PARTS,
        "e_daily",
        recent=RECENT,
        results=RESULTS,
    ),
)
def dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).drop("details")


@query(
    "dq_subset",
    with_parts(
        """SELECT *, observed <= threshold AS passed FROM results
           WHERE check_name IN ('orders_without_items', 'duplicate_customer_emails')""",
        *ENTITY_PARTS,
        "e_daily",
        recent=RECENT,
        results=RESULTS,
    ),
)
def dq_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["orders_without_items", "duplicate_customer_emails"]
    return _checked(spark, sf_dir, names).drop("details")


@query(
    "dq_summary",
    with_parts(
        """SELECT count(*) FILTER (observed <= threshold) AS passed,
                  count(*) FILTER (observed > threshold AND severity = 'warning') AS warnings,
                  count(*) FILTER (observed > threshold AND severity = 'error') AS errors
           FROM results""",
        *ENTITY_PARTS,
        "e_daily",
        recent=RECENT,
        results=RESULTS,
    ),
)
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summarise(_checked(spark, sf_dir))


EVENT_NOW = "2024-02-01 00:00:00"


def _event_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One watermark entry per event type and day."""
    return (
        sample.table(spark, sf_dir, "events")
        .select("event_type", F.col("ts").cast("timestamp").alias("ts"))
        .groupBy(F.col("event_type").alias("entity"), F.to_date("ts").alias("day"))
        .agg(F.max("ts").alias("watermark_ts"))
        .select(
            "entity",
            "watermark_ts",
            F.date_format("day", "yyyyMMdd").cast("bigint").alias("run_id"),
            F.col("day").cast("timestamp").alias("updated_at"),
        )
    )


@query(
    "freshness",
    f"""SELECT entity || '_freshness' AS check_name, 'warning' AS severity, observed,
               2.0::DOUBLE AS threshold, observed <= 2.0 AS passed
        FROM (SELECT w.entity, coalesce((epoch_us(TIMESTAMP '{EVENT_NOW}') - epoch_us(max(e.ts)))
                  / 86400000000.0::DOUBLE, 1e9::DOUBLE) AS observed
              FROM (SELECT unnest(['view', 'click', 'refund']) AS entity) w
              LEFT JOIN events e ON e.event_type = w.entity GROUP BY 1) aged""",
)
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = monitoring.latest_watermarks(_event_marks(spark, sf_dir))
    return quality.freshness(marks, ["view", "click", "refund"], EVENT_NOW, 2.0).drop("details")


@query(
    "watermark_lag",
    f"""SELECT event_type AS entity, max(ts)::TIMESTAMP AS watermark_ts,
               (epoch_us(TIMESTAMP '{EVENT_NOW}') - epoch_us(max(ts))) / 3600000000.0::DOUBLE
                   AS lag_hours,
               (epoch_us(TIMESTAMP '{EVENT_NOW}') - epoch_us(max(ts))) / 3600000000.0::DOUBLE > 26
                   AS alert
        FROM events GROUP BY 1""",
)
def watermark_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.watermark_lag(
        monitoring.latest_watermarks(_event_marks(spark, sf_dir)), EVENT_NOW
    )


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load run per day and order state."""
    day = F.to_date("o_orderdate")
    state = F.col("o_orderstatus")
    return (
        sample.table(spark, sf_dir, "orders")
        .groupBy(day.alias("day"), state.alias("workflow"))
        .agg(
            F.count(F.lit(1)).alias("extracted"),
            F.count_if(F.col("o_orderpriority").isin("5-LOW", "4-NOT SPECIFIED")).alias("rejected"),
            F.max("o_totalprice").alias("largest"),
        )
        .withColumn(
            "run_id",
            F.date_format("day", "yyyyMMdd").cast("bigint") * 10
            + F.when(F.col("workflow") == "F", 1).when(F.col("workflow") == "O", 2).otherwise(3),
        )
    )


def _run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, optional failure and end of each run, as separate events. The
    failure comes first and the success after it must not revive the run."""
    runs = _runs(spark, sf_dir)
    start = F.col("day").cast("timestamp")
    none = F.lit(None)

    def event(status: str, hours: int, with_counts: bool, message: str | None) -> DataFrame:
        def count(column: str):
            return (F.col(column) if with_counts else none).cast("bigint")

        return runs.select(
            "run_id",
            "workflow",
            F.lit("orders").alias("source"),
            F.lit(status).alias("status"),
            F.timestamp_add("HOUR", F.lit(hours), start).alias("at"),
            count("extracted").alias("rows_extracted"),
            (F.col("extracted") - F.col("rejected") if with_counts else none)
            .cast("bigint")
            .alias("rows_loaded"),
            count("rejected").alias("rows_rejected"),
            F.lit(message).cast("string").alias("error_message"),
            "largest",
        )

    failed = event("failed", 1, False, "amount too large").filter("largest > 450000")
    return (
        event("running", 0, False, None)
        .unionByName(failed)
        .unionByName(event("succeeded", 2, True, None))
        .drop("largest")
    )


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.run_history(_run_events(spark, sf_dir))


HISTORY = """
    SELECT strftime(o_orderdate, '%Y%m%d')::BIGINT * 10
               + CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS run_id,
           o_orderstatus AS workflow, 'orders' AS source,
           CASE WHEN max(o_totalprice) > 450000 THEN 'failed' ELSE 'succeeded' END AS status,
           o_orderdate::TIMESTAMP AS started_at,
           o_orderdate::TIMESTAMP + INTERVAL 2 HOUR AS finished_at,
           count(*) AS rows_extracted,
           count(*) FILTER (o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED')) AS rows_loaded,
           count(*) FILTER (o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED')) AS rows_rejected,
           CASE WHEN max(o_totalprice) > 450000 THEN 'amount too large' END AS error_message
    FROM orders GROUP BY o_orderdate, o_orderstatus"""


@query("run_history", HISTORY)
def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir)


@query(
    "run_history_latest",
    with_parts("SELECT * FROM h ORDER BY started_at DESC, run_id DESC LIMIT 20", h=HISTORY),
)
def run_history_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.recent_runs(_history(spark, sf_dir))


@query(
    "reject_rate",
    with_parts(
        """SELECT run_id, workflow, rows_extracted, rows_rejected,
                  rows_rejected::DOUBLE / rows_extracted AS reject_rate,
                  rows_rejected::DOUBLE / rows_extracted > 0.01 AS alert FROM h""",
        h=HISTORY,
    ),
)
def reject_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.reject_rates(_history(spark, sf_dir))


@query(
    "slow_loads",
    """WITH runs AS (
           SELECT strftime(o_orderdate, '%Y%m%d')::BIGINT * 10
                      + CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS run_id,
                  o_orderstatus AS workflow, o_orderdate::TIMESTAMP AS started_at,
                  max(o_totalprice) AS seconds
           FROM orders GROUP BY o_orderdate, o_orderstatus),
       with_median AS (
           SELECT *, median(seconds) OVER (PARTITION BY workflow ORDER BY started_at
               RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)
               AS trailing_median FROM runs)
       SELECT *, coalesce(seconds > 2.0 * trailing_median, FALSE) AS alert FROM with_median""",
)
def slow_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    durations = _runs(spark, sf_dir).select(
        "run_id",
        "workflow",
        F.col("day").cast("timestamp").alias("started_at"),
        F.col("largest").alias("seconds"),
    )
    return monitoring.slow_runs(durations)


def _check_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One check result per event type and day: the largest value against 100."""
    return (
        sample.table(spark, sf_dir, "events")
        .select("event_type", F.col("ts").cast("timestamp").alias("ts"), "value")
        .groupBy(F.to_date("ts").alias("day"), F.col("event_type").alias("check_name"))
        .agg(F.max("value").alias("observed"))
        .select(
            F.date_format("day", "yyyyMMdd").cast("bigint").alias("run_id"),
            "check_name",
            F.when(F.col("check_name") == "error", "error").otherwise("warning").alias("severity"),
            (F.col("observed") <= 100).alias("passed"),
            "observed",
            F.lit(100.0).alias("threshold"),
            F.col("day").cast("timestamp").alias("checked_at"),
        )
    )


CHECK_LOG = """
    SELECT event_type AS check_name, CASE event_type WHEN 'error' THEN 'error'
               ELSE 'warning' END AS severity, max(value) AS observed, 100.0::DOUBLE AS threshold,
           ts::DATE::TIMESTAMP AS checked_at
    FROM events GROUP BY event_type, ts::DATE"""


@query(
    "failing_checks",
    with_parts(
        """SELECT * FROM log WHERE observed > 100
           AND checked_at > TIMESTAMP '2024-01-30' - INTERVAL 7 DAY""",
        log=CHECK_LOG,
    ),
)
def failing_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.failing_checks(_check_log(spark, sf_dir), "2024-01-30 00:00:00")


@query(
    "run_alerts",
    with_parts(
        """SELECT 'failed_runs' AS alert, 'page' AS severity,
                  (SELECT count(*) FROM h WHERE status = 'failed') AS count
           UNION ALL SELECT 'no_recent_success', 'page', (SELECT (count(*) = 0)::BIGINT FROM h
               WHERE status = 'succeeded'
                 AND finished_at >= TIMESTAMP '2001-08-20' - INTERVAL 26 HOUR)
           UNION ALL SELECT 'blocking_checks', 'page',
               (SELECT count(*) FROM log WHERE observed > 100 AND severity = 'error')
           UNION ALL SELECT 'warning_checks', 'ticket',
               (SELECT count(*) FROM log WHERE observed > 100 AND severity = 'warning')""",
        h=HISTORY,
        log=CHECK_LOG,
    ),
)
def run_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.run_alerts(
        _history(spark, sf_dir), _check_log(spark, sf_dir), "2001-08-20 00:00:00"
    )
