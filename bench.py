"""Headline timings as one JSON line.

Environment: BENCH_SF_DIR (table folder), BENCH_CPUS (local threads). Queries
are timed warm, median of three; the load job runs once and reports rows/s.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse import model
from tallyhouse.operators import merge, validate
from tallyhouse.operators.hierarchy import category_closure
from tallyhouse.plans import job, reports
from tallyhouse.registry import QUERIES, load_all
from tallyhouse.registry.common import END, START
from tallyhouse.registry.jobs import write_csv
from tallyhouse.session import scratch_path
from tallyhouse.sources import csv_source, sample
from tallyhouse.sources.warehouse import Warehouse

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = 3


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tallyhouse-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def warm_median(run: Callable[[], object]) -> float:
    run()
    seconds = []
    for _ in range(REPEATS):
        started = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - started)
    return statistics.median(seconds)


def main() -> None:
    load_all()
    spark = session()
    folder = write_csv(spark, SF_DIR)
    root = scratch_path(spark, "bench-tables")
    declared = ("1995-01-01", "2001-12-01")

    timings: dict[str, float] = {}
    started = time.perf_counter()
    report = job.run(spark, folder, root, declared=declared, blocking=False)
    timings["load_job_full"] = time.perf_counter() - started
    load_rate = report.extracted / timings["load_job_full"]
    started = time.perf_counter()
    job.run(spark, folder, root, declared=declared, is_incremental=True, blocking=False)
    timings["load_job_incremental"] = time.perf_counter() - started

    tables = Warehouse(spark, root, 8, *declared)
    closure = category_closure(tables.read("product_categories"))
    products, rollup, orders = (tables.read(t) for t in ("products", "daily_sales", "orders"))
    now = job.utc_now()

    def on_sample(name: str) -> Callable[[], None]:
        return lambda: consume(QUERIES[name](spark, SF_DIR))

    def top_on_rollup() -> None:
        top = reports.top_products_by_category(rollup, products, closure, START, END)
        top.collect()

    def trend_on_rollup() -> None:
        reports.sales_trends(rollup, START, END, "MONTH").collect()

    def page_on_rollup() -> None:
        sales = reports.product_sales(
            rollup, products, tables.read("product_categories"), START, END
        )
        reports.product_sales_page(sales).collect()

    def validate_lines() -> None:
        raw = csv_source.read(spark, model.ORDER_ITEMS, folder)
        validate.reason_counts(validate.classify(model.ORDER_ITEMS, raw)).collect()

    def upsert_orders() -> None:
        staged = sample.orders(spark, SF_DIR).withColumn(
            "month", F.date_format("order_date", "yyyy-MM")
        )
        key = [*model.ORDERS.key, "month"]
        consume(merge.merge(orders, staged, key, model.ORDERS.update_columns, now))

    for name, run in {
        "daily_rollup": on_sample("daily_sales_rollup"),
        "customer_metrics": on_sample("customer_metrics"),
        "top_products_raw_lines": on_sample("top_products_by_category"),
        "top_products_on_rollup": top_on_rollup,
        "sales_trend_month_on_rollup": trend_on_rollup,
        "product_sales_page_on_rollup": page_on_rollup,
        "purchase_history_page": lambda: reports.purchase_history(orders, 8, first=20).collect(),
        "recent_orders_per_customer": on_sample("recent_orders_per_customer"),
        "dedupe_lines": on_sample("dedupe_last"),
        "validate_lines_csv": validate_lines,
        "upsert_orders_rerun": upsert_orders,
    }.items():
        timings[name] = warm_median(run)

    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_seconds_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in timings.items()},
                "load_rows_per_sec": round(load_rate),
                "load_rows": report.extracted,
                "sf": SF_DIR.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    sys.exit(main())
