"""Results kept per month and per run: digests, totals after crashes, the run ledger, periods."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tallyhouse import model
from tallyhouse.operators import digests
from tallyhouse.plans import changes, check_ledger, maintained, monitoring, reports
from tallyhouse.sources.ledger import FAILED, SUCCEEDED, RunLedger
from tallyhouse.sources.warehouse import Warehouse

START = datetime(2026, 1, 5, tzinfo=timezone.utc)


def put_orders(spark, warehouse, rows, touched=None):
    """rows: (order_id, customer_id, days after the start, status, total)."""
    named = [(o, c, START + timedelta(days=d), s, str(t)) for o, c, d, s, t in rows]
    frame = spark.createDataFrame(named, "order_id long, customer_id long, order_date timestamp, status string, total string")
    frame = frame.withColumn("total_amount", F.col("total").cast("decimal(12,2)"))
    frame = frame.withColumn("month", warehouse.partition_of(model.ORDERS))
    for f in warehouse.schema("orders").fields:
        if f.name not in frame.columns:
            frame = frame.withColumn(f.name, F.lit(None).cast(f.dataType))
    warehouse.replace_partitions("orders", frame, "month", touched=touched)


def totals(warehouse):
    columns = ["customer_id", "orders", "value_cents", "first_order_date", "last_order_date"]
    return {tuple(r) for r in warehouse.read("customer_totals").select(*columns).collect()}


def rebuilt(warehouse):
    rows = maintained.CUSTOMERS.of_month(warehouse.read("orders").withColumn("month", F.lit("")))
    columns = ["customer_id", "orders", "value_cents", "first_order_date", "last_order_date"]
    return {tuple(r) for r in rows.select(*columns).collect()}


FIRST = [(1, 1, 0, "Shipped", 10), (2, 1, 40, "Shipped", 20), (3, 2, 3, "Pending", 5), (4, 3, 75, "Shipped", 7), (5, 4, 2, "Cancelled", 9)]
# January again: customer 1 loses its first order, 2 its only one, 5 is new, 3 gets an earlier one.
JANUARY = [(6, 5, 1, "Shipped", 3), (7, 3, 4, "Shipped", 8), (8, 4, 6, "Shipped", 1)]


def test_digests_do_not_depend_on_order(spark):
    rows = [("2026-01", 1, None), ("2026-01", 2, "x"), ("2026-01", 2, "x"), ("2026-02", None, "1")]
    schema = "month string, a int, b string"
    one = digests.by_month(spark.createDataFrame(rows, schema), ["a", "b"])
    two = digests.by_month(spark.createDataFrame(rows[::-1], schema).repartition(5), ["a", "b"])
    assert set(one.collect()) == set(two.collect())
    for changed in (rows[:1] + rows[2:], rows[:3] + [("2026-02", 1, None)], [("2026-01", None, "1"), *rows[1:]]):
        other = digests.by_month(spark.createDataFrame(changed, schema), ["a", "b"])
        assert set(one.collect()) != set(other.collect())
    assert digests.by_month(spark.createDataFrame([], schema), ["a", "b"]).collect() == []


@pytest.mark.parametrize("dies", [None, "before totals", "after totals"])
def test_totals_survive_a_crash(spark, tmp_path, dies):
    warehouse = Warehouse(spark, str(tmp_path / dies if dies else tmp_path / "whole"), 2)
    kept = maintained.CUSTOMERS
    put_orders(spark, warehouse, FIRST)
    assert maintained.refresh(warehouse, kept) == ["2026-01", "2026-02", "2026-03"]
    assert totals(warehouse) == rebuilt(warehouse) and len(totals(warehouse)) == 3
    put_orders(spark, warehouse, JANUARY, ["2026-01"])
    if dies:
        current, months = maintained.stale(warehouse, kept)
        assert months == ["2026-01"]
        maintained.write_pending(warehouse, kept, current, months)
        if dies == "after totals":
            maintained.switch_totals(warehouse, kept, months)
    assert maintained.refresh(warehouse, kept) == ([] if dies == "after totals" else ["2026-01"])
    assert totals(warehouse) == rebuilt(warehouse)
    assert not warehouse.exists(kept.pending) and maintained.refresh(warehouse, kept) == []
    warehouse.drop_partitions("orders", "month", ["2026-02", "2026-03"])
    assert maintained.refresh(warehouse, kept) == ["2026-02", "2026-03"]
    assert totals(warehouse) == rebuilt(warehouse)
    warehouse.drop_partitions("orders", "month", ["2026-01"])
    maintained.refresh(warehouse, kept)
    assert totals(warehouse) == set()


def test_only_changed_months_are_checked_again(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "tables"), 2)
    now = START + timedelta(days=60)
    put_orders(spark, warehouse, FIRST)
    assert check_ledger.refresh(warehouse) == ["2026-01", "2026-02", "2026-03"]
    assert check_ledger.refresh(warehouse) == []
    # Rewritten with equal rows: the digest is made again, the month is not.
    put_orders(spark, warehouse, [r for r in FIRST if r[2] == 40], ["2026-02"])
    assert warehouse.forgotten("orders") == {"2026-02"}
    assert check_ledger.refresh(warehouse) == [] and warehouse.forgotten("orders") == set()
    put_orders(spark, warehouse, JANUARY, ["2026-01"])
    assert check_ledger.refresh(warehouse) == ["2026-01"]
    found = {r.check: r.violations for r in check_ledger.observations(warehouse, now).collect()}
    assert found["orders_without_items"] == 5 and found["future_dated_orders"] == 1
    assert found["unaggregated_selling_days"] == 5 and found["default_partition_rows"] == 0
    plan = warehouse.read("check_ledger").groupBy("check_name").count()._jdf.queryExecution().toString()
    assert "/orders/" not in plan
    with pytest.raises(ValueError):
        check_ledger.observations(warehouse, now, ["no such check"])


def test_empty_warehouse_has_nothing_to_refresh(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "tables"), 2)
    assert check_ledger.refresh(warehouse) == []
    assert maintained.refresh(warehouse, maintained.PRODUCTS) == []
    assert changes.refresh_changed_months(warehouse, START) == []
    found = {r.check: r.violations for r in check_ledger.observations(warehouse, START).collect()}
    assert len(found) == 9 and set(found.values()) == {0}


def test_a_run_is_recorded_once(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "tables"), 2)
    ledger = RunLedger(warehouse)
    log = spark.createDataFrame([(0, "c", "error", True, 0.0, 0.0, "", START)], model.CHECK_SCHEMA)

    def status(run_id):
        history = monitoring.run_history(ledger.events()).filter(F.col("run_id") == run_id)
        return [(r.status, r.rows_extracted, r.error_message) for r in history.collect()]

    dead = ledger.begin(1, "w", "s")
    ledger.log("check_results", 1, dead, log.unionByName(log))
    assert status(1) == [("running", 0, None)] and ledger.committed("check_results").count() == 0
    attempt = ledger.begin(1, "w", "s")
    # What the dead attempt logged is not this one's, even before it is replaced.
    ledger.finish(1, SUCCEEDED, (3, 2, 1))
    assert ledger.committed("check_results").count() == 0
    ledger.log("check_results", 1, attempt, log)
    assert ledger.committed("check_results").count() == 1
    assert status(1) == [("succeeded", 3, None)] and ledger.events().count() == 2
    ledger.begin(2, "w", "s")
    RunLedger(Warehouse(spark, warehouse.root)).mark_failed(1, "found wrong afterwards")
    ledger.mark_failed(2, "killed")
    assert status(1) == [("failed", 3, "found wrong afterwards")] and status(2) == [("failed", 0, "killed")]
    ledger.finish(2, SUCCEEDED)
    assert status(2)[0][0] == FAILED
    with pytest.raises(ValueError, match="unknown run"):
        ledger.mark_failed(99, "no such run")


def test_reports_without_a_period_take_the_last_days(spark):
    days = "sale_date date, product_id long, category_id long, units_sold long, gross_revenue decimal(14,2), "
    days += "discount_total decimal(14,2), net_revenue decimal(14,2), order_count int"
    rollup = spark.createDataFrame([], days)
    products = spark.createDataFrame([], "product_id long, name string, sku string, category_id long")
    categories = spark.createDataFrame([], "category_id long, name string")
    today = START.date()
    plan = reports.product_sales(rollup, products, categories, today=today)._jdf.queryExecution().analyzed().toString()
    assert str(today) in plan and str(today - timedelta(days=90)) in plan
    for bad in (("2026-02-01", "2026-01-01"), ("2026-02-01", None)):
        with pytest.raises(ValueError):
            reports.product_sales(rollup, products, categories, *bad)
        with pytest.raises(ValueError):
            reports.sales_trends(rollup, *bad)
        with pytest.raises(ValueError):
            reports.top_products_by_category(rollup, products, categories, *bad)


def test_digests_add_up_without_a_decimal_per_row(spark):
    """The sum of signed hashes, exact beyond 64 bits, from whole-number sums per row."""
    rows = spark.range(5000).select(F.col("id").alias("a"), F.when(F.col("id") % 7 > 0, F.lit("x")).alias("b"), F.lit("m").alias("month"))
    made = digests.by_month(rows, ["a", "b"])
    got = made.first()
    hashes = [r[0] for r in rows.select(digests.row_hash(["a", "b"])).collect()]
    assert (got.rows, int(got.hash_sum)) == (5000, sum(hashes))
    assert dict(made.dtypes)["hash_sum"] == "decimal(38,0)"
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "as decimal(20,0))) AS" not in plan.split("Aggregate", 1)[1].split("bit_xor")[0]
