"""Edits on stored tables."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import fixtures
from tallyhouse import model
from tallyhouse.operators import rollups, validate
from tallyhouse.plans import edits, job
from tallyhouse.plans.load import upsert
from tallyhouse.sources.ledger import SUCCEEDED, RunLedger
from tallyhouse.sources.warehouse import Warehouse

NOW = datetime(2026, 7, 1)
LATER = datetime(2026, 7, 2)


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    """Tables filled straight from clean rows."""
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("edits") / "tables"), 2)
    for name, rows in fixtures.rows(40).items():
        entity = model.BY_NAME[name]
        texts = [tuple(str(r[c]) if r[c] != "" else None for c in entity.source_columns) for r in rows]
        raw = spark.createDataFrame(texts, ", ".join(f"{c} string" for c in entity.source_columns))
        clean = validate.accepted(validate.classify(entity, raw))
        assert upsert(warehouse, entity, clean.select(*entity.columns), NOW) == (len(rows), 0)
    metrics = rollups.customer_metrics(warehouse.read("customers"), warehouse.read("orders"))
    warehouse.replace_partitions(
        "customer_metrics",
        metrics.withColumn("refreshed_at", F.lit(NOW)).withColumn("shard", warehouse.shard("customer_id")),
        "shard",
    )
    return warehouse


def test_line_revenue_is_derived_on_write(warehouse):
    off = F.col("line_revenue") != F.col("unit_price") * F.col("quantity") - F.col("discount")
    assert warehouse.read("order_items").filter(off).count() == 0


def test_update_products_moves_updated_at_of_changed_rows(spark, warehouse):
    changes = spark.createDataFrame(
        [(1, "Renamed", None), (2, "Product, \"2\"", None), (3, None, "SKU-4")],
        "product_id long, name string, sku string",
    )
    got = {r.product_id: r.success for r in edits.update_products(warehouse, changes, LATER).collect()}
    assert got == {1: True, 2: True, 3: False}
    rows = {r.product_id: r for r in warehouse.read("products").collect()}
    assert len(rows) == 20
    assert rows[1].name == "Renamed" and rows[1].updated_at == LATER and rows[1].created_at == NOW
    assert rows[2].updated_at == NOW and rows[3].sku == "SKU-3"


def test_deleting_orders_takes_their_lines(warehouse):
    first = warehouse.partitions("orders", "month")[0]
    gone = warehouse.read("orders").filter(F.col("month") == first)
    orders, lines = warehouse.read("orders").count(), warehouse.read("order_items").count()
    n, m = gone.count(), warehouse.read("order_items").filter(F.col("month") == first).count()
    edits.delete_orders(warehouse, gone)
    assert warehouse.read("orders").count() == orders - n
    assert warehouse.read("order_items").count() == lines - m
    assert first not in warehouse.partitions("orders", "month")


def test_customers_with_orders_stay(spark, warehouse):
    keys = spark.createDataFrame([(1,), (40,)], "customer_id long")
    kept = edits.delete_customers(warehouse, keys)
    assert [r.customer_id for r in kept.collect()] == [1]
    left = {r.customer_id for r in warehouse.read("customers").select("customer_id").collect()}
    assert left == set(range(1, 40))
    assert warehouse.read("customer_metrics").count() == 39


def test_deleting_runs_takes_their_checks(spark, warehouse):
    ledger = RunLedger(warehouse)
    for run_id in (1, 2):
        attempt = ledger.begin(run_id, "w", "s")
        checks = spark.createDataFrame([(run_id, "c", "error", True, 0.0, 0.0, "", NOW)], model.CHECK_SCHEMA)
        ledger.log("check_results", run_id, attempt, checks)
        ledger.finish(run_id, SUCCEEDED)
    edits.delete_runs(warehouse, [1])
    assert {r.run_id for r in warehouse.read("run_events").collect()} == {2}
    assert [r.run_id for r in ledger.committed("check_results").collect()] == [2]


def test_tables_can_be_named_and_analyzed(spark, warehouse):
    warehouse.register("orders")
    try:
        assert spark.table("orders").count() == warehouse.read("orders").count()
        warehouse.analyze(["orders", "not_registered"])
        described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED orders").collect()}
        assert "rows" in described["Statistics"]
    finally:
        spark.sql("DROP TABLE IF EXISTS orders")
