"""Category tree, date dimension and month partitions over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.functions.holidays import holiday_name
from tallyhouse.operators import calendar_dim
from tallyhouse.operators.hierarchy import category_closure
from tallyhouse.plans.incremental import day_span
from tallyhouse.registry import query
from tallyhouse.registry.common import closure
from tallyhouse.registry.oracle import text_id, with_parts
from tallyhouse.sources import sample


def _path_text(df: DataFrame) -> DataFrame:
    path = F.array_join(F.transform("path", lambda x: x.cast("string")), "/")
    return df.withColumn("path", path)


@query(
    "category_hierarchy",
    with_parts(
        """SELECT category_id, name, parent_id, root_category_id, root_category_name, depth,
                  CASE WHEN parent_id IS NULL THEN category_id::VARCHAR
                       ELSE parent_id || '/' || category_id END AS path
           FROM e_closure""",
        "e_closure",
    ),
)
def category_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _path_text(closure(spark, sf_dir))


REGION = text_id("'region/' || {}")
NATION = text_id("'nation/' || {}")
SEGMENT = text_id("'segment/' || c_nationkey || '/' || c_mktsegment")
REGION_TREE = f"""
    SELECT {REGION.format("r_regionkey")} AS category_id, r_name AS name,
           NULL::BIGINT AS parent_id
    FROM region
    UNION ALL
    SELECT {NATION.format("n_nationkey")}, n_name, {REGION.format("n_regionkey")} FROM nation
    UNION ALL
    SELECT DISTINCT {SEGMENT}, c_mktsegment, {NATION.format("c_nationkey")} FROM customer"""


@query(
    "region_hierarchy",
    f"""WITH RECURSIVE tree_rows AS ({REGION_TREE}),
        tree AS (
            SELECT category_id, name, parent_id, category_id AS root_category_id,
                   name AS root_category_name, 1 AS depth, category_id::VARCHAR AS path
            FROM tree_rows WHERE parent_id IS NULL
            UNION ALL
            SELECT c.category_id, c.name, c.parent_id, t.root_category_id,
                   t.root_category_name, t.depth + 1, t.path || '/' || c.category_id
            FROM tree_rows c JOIN tree t ON c.parent_id = t.category_id)
        SELECT * FROM tree""",
)
def region_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three levels, so that the closure needs several rounds."""
    return _path_text(category_closure(sample.region_tree(spark, sf_dir)))


@query(
    "deep_hierarchy",
    with_parts(
        """SELECT customer_id AS category_id, email AS name,
                  CASE WHEN customer_id % 100 > 0 THEN customer_id - 1 END AS parent_id,
                  customer_id - customer_id % 100 AS root_category_id,
                  (SELECT any_value(r.email) FROM e_customers r
                   WHERE r.customer_id = c.customer_id - c.customer_id % 100) AS root_category_name,
                  (customer_id % 100 + 1)::INTEGER AS depth,
                  array_to_string(range(customer_id - customer_id % 100, customer_id + 1), '/') AS path
           FROM e_customers c WHERE customer_id >= 100 AND customer_id % 1000 < 990""",
        "e_customers",
    ),
)
def deep_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in chains a hundred levels deep, ten of each thousand in a ring, the first chain without its root."""
    number = F.col("customer_id")
    ring = F.when(number % 1000 == 999, number - 9).when(number % 1000 >= 990, number + 1)
    above = F.coalesce(ring, F.when(number % 100 > 0, number - 1))
    tree = sample.customers(spark, sf_dir).select(
        number.alias("category_id"), F.col("email").alias("name"), above.alias("parent_id")
    )
    return _path_text(category_closure(tree))


DAYS = """
    SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE,
                                  INTERVAL 1 DAY))::DATE AS date
    FROM orders"""
WEEKDAY_OF_MONTH = """CASE
    WHEN m = 1 AND d = 1 THEN 'New Year''s Day'
    WHEN m = 6 AND d = 19 THEN 'Juneteenth'
    WHEN m = 7 AND d = 4 THEN 'Independence Day'
    WHEN m = 11 AND d = 11 THEN 'Veterans Day'
    WHEN m = 12 AND d = 25 THEN 'Christmas Day'
    WHEN w = 1 AND m = 1 AND nth = 3 THEN 'Martin Luther King Jr. Day'
    WHEN w = 1 AND m = 2 AND nth = 3 THEN 'Presidents Day'
    WHEN w = 1 AND m = 5 AND d + 7 > 31 THEN 'Memorial Day'
    WHEN w = 1 AND m = 9 AND nth = 1 THEN 'Labor Day'
    WHEN w = 1 AND m = 10 AND nth = 2 THEN 'Columbus Day'
    WHEN w = 4 AND m = 11 AND nth = 4 THEN 'Thanksgiving Day' END"""
CALENDAR = f"""
    SELECT strftime(date, '%Y%m%d')::INTEGER AS date_key, date, w AS day_of_week,
           dayname(date) AS day_name, d AS day_of_month,
           dayofyear(date)::INTEGER AS day_of_year,
           weekofyear(date)::INTEGER AS week_of_year, m AS month, monthname(date) AS month_name,
           quarter(date)::INTEGER AS quarter, year(date)::INTEGER AS year,
           w IN (6, 7) AS is_weekend, {WEEKDAY_OF_MONTH} AS holiday_name
    FROM (SELECT date, month(date)::INTEGER AS m, day(date)::INTEGER AS d,
                 isodow(date)::INTEGER AS w, (day(date)::INTEGER - 1) // 7 + 1 AS nth
          FROM days) parts"""


def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = day_span(sample.orders(spark, sf_dir), "order_date")
    return calendar_dim.describe_days(calendar_dim.days_between(span))


@query(
    "dim_time",
    with_parts(
        "SELECT *, holiday_name IS NOT NULL AS is_holiday FROM calendar",
        days=DAYS,
        calendar=CALENDAR,
    ),
)
def dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _calendar(spark, sf_dir)


@query(
    "us_holidays",
    with_parts(
        """SELECT c.holiday_name, count(*) AS orders, count(DISTINCT c.date) AS days
           FROM e_orders o JOIN calendar c ON c.date = o.order_date::DATE
           WHERE c.holiday_name IS NOT NULL GROUP BY 1""",
        "e_orders",
        days=DAYS,
        calendar=CALENDAR,
    ),
)
def us_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per holiday, with the holiday computed from the order date."""
    day = F.to_date("order_date")
    return (
        sample.orders(spark, sf_dir)
        .select(day.alias("day"), holiday_name(day).alias("holiday_name"))
        .filter("holiday_name IS NOT NULL")
        .groupBy("holiday_name")
        .agg(F.count(F.lit(1)).alias("orders"), F.count_distinct("day").alias("days"))
    )


@query(
    "dim_time_refresh",
    with_parts(
        """SELECT date_key, date, CASE WHEN date < DATE '1998-01-01' THEN 'old' ELSE day_name END
                  AS day_name, holiday_name, holiday_name IS NOT NULL AS is_holiday
           FROM calendar""",
        days=DAYS,
        calendar=CALENDAR,
    ),
)
def dim_time_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known days keep their attributes and only get fresh holiday fields."""
    fresh = _calendar(spark, sf_dir)
    known = (
        fresh.filter("date < DATE '1998-01-01'")
        .withColumn("day_name", F.lit("old"))
        .withColumn("holiday_name", F.lit("stale"))
        .withColumn("is_holiday", F.lit(False))
    )
    return calendar_dim.refresh_date_dimension(known, fresh).select(
        "date_key", "date", "day_name", "holiday_name", "is_holiday"
    )


@query(
    "declared_months",
    """WITH span AS (SELECT date_trunc('month', min(o_orderdate))::DATE AS a,
                            date_trunc('month', max(o_orderdate))::DATE AS b FROM orders)
       SELECT month_start FROM (
           SELECT unnest(generate_series(a, b, INTERVAL 1 MONTH))::DATE AS month_start FROM span)
       WHERE month_start NOT BETWEEN DATE '1997-01-01' AND DATE '1998-12-01'""",
)
def declared_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months the order dates need beyond those already declared (1997 and 1998)."""
    declared = calendar_dim.months_between(spark, "1997-01-15", "1998-12-31")
    return calendar_dim.new_months(declared, day_span(sample.orders(spark, sf_dir), "order_date"))


@query(
    "out_of_range_rows",
    with_parts(
        """SELECT 'orders' AS table_name, date_trunc('month', order_date)::DATE AS month_start,
                  count(*) AS row_count FROM e_orders
           WHERE order_date < TIMESTAMP '1996-01-01' OR order_date >= TIMESTAMP '2001-01-01'
           GROUP BY ALL
           UNION ALL
           SELECT 'order_items', date_trunc('month', order_date)::DATE, count(*) FROM e_items
           WHERE order_date < TIMESTAMP '1996-01-01' OR order_date >= TIMESTAMP '2001-01-01'
           GROUP BY ALL""",
        "e_orders",
        "e_items",
    ),
)
def out_of_range_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = calendar_dim.months_between(spark, "1996-01-01", "2000-12-31")

    def outside(name: str, df: DataFrame) -> DataFrame:
        counts = calendar_dim.undeclared_rows(df, "order_date", declared)
        return counts.select(F.lit(name).alias("table_name"), "month_start", "row_count")

    return outside("orders", sample.orders(spark, sf_dir)).unionByName(
        outside("order_items", sample.order_items(spark, sf_dir))
    )


@query(
    "retention_candidates",
    """SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS month_start,
              (date_trunc('month', o_orderdate) + INTERVAL 1 MONTH)::DATE AS upper_bound
       FROM orders WHERE date_trunc('month', o_orderdate) + INTERVAL 1 MONTH <= DATE '1997-07-15'""",
)
def retention_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = (
        sample.orders(spark, sf_dir)
        .select(F.trunc("order_date", "month").alias("month_start"))
        .distinct()
    )
    return calendar_dim.months_before(months, "1997-07-15")
