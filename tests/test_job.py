"""End to end: load, reload, incremental, quarantine, gate, stream."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import fixtures
from tallyhouse import model
from tallyhouse.plans import job, monitoring, quality
from tallyhouse.plans.load import load_entity, upsert
from tallyhouse.sources import csv_source, sinks
from tallyhouse.sources.warehouse import Warehouse
from tallyhouse.streaming import stream_load

TABLES = [e.name for e in model.ENTITIES] + ["daily_sales", "customer_metrics"]


@pytest.fixture(scope="module")
def data():
    return fixtures.rows(60)


@pytest.fixture(scope="module")
def source(data, tmp_path_factory):
    return fixtures.write(tmp_path_factory.mktemp("src") / "csv", data)


@pytest.fixture(scope="module")
def loaded(spark, source, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("wh") / "tables")
    return Warehouse(spark, root, 2), job.run(spark, source, root, shards=2)


def counts(warehouse: Warehouse) -> dict[str, int]:
    return {t: warehouse.read(t).count() for t in TABLES}


def test_full_load_inserts_every_row(loaded, data):
    warehouse, report = loaded
    assert report.rejected == 0
    for entity in report.entities:
        assert entity.extracted == entity.inserted == len(data[entity.entity])
        assert entity.updated == 0
    assert report.checks and all(report.checks.values())
    assert {r.status for r in monitoring.run_history(warehouse.read("run_events")).collect()} == {
        "succeeded"
    }
    assert warehouse.read("check_results").count() == len(quality.CHECKS)


def test_derived_tables_reconcile(loaded, data):
    warehouse, _ = loaded
    bearing = {o["order_id"] for o in data["orders"] if o["status"] not in ("Cancelled", "Returned")}
    lines = sum(round(float(i["total"]) * 100) for i in data["order_items"] if i["order_id"] in bearing)
    rollup = warehouse.read("daily_sales").agg(F.sum("net_revenue")).first()[0]
    assert round(float(rollup) * 100) == lines
    values = sum(round(float(o["total_amount"]) * 100) for o in data["orders"] if o["order_id"] in bearing)
    ltv = warehouse.read("customer_metrics").agg(F.sum("lifetime_value")).first()[0]
    assert round(float(ltv) * 100) == values
    assert warehouse.read("product_sales_summary").count() == len(data["products"])
    assert warehouse.read("customers").filter("email = 'person1@example.com'").count() == 1


def test_reload_updates_and_keeps_updated_at(spark, loaded, source, data):
    warehouse, _ = loaded
    before = counts(warehouse)
    stamps = warehouse.read("orders").select("order_id", "updated_at")
    old = {r.order_id: r.updated_at for r in stamps.collect()}
    second = job.run(spark, source, warehouse.root, shards=2)
    assert counts(warehouse) == before
    for entity in second.entities:
        assert (entity.inserted, entity.updated) == (0, len(data[entity.entity]))
    assert {r.order_id: r.updated_at for r in warehouse.read("orders").collect()} == old


def test_incremental_run_skips_what_is_loaded(spark, loaded, source):
    warehouse, _ = loaded
    newest = warehouse.read("orders").agg(F.max("order_date")).first()[0]
    assert job.read_watermark(warehouse, "orders") == newest
    report = job.run(
        spark, source, warehouse.root, is_incremental=True, skip_quality=True, shards=2
    )
    for entity in report.entities:
        if model.BY_NAME[entity.entity].watermark:
            assert entity.loaded == 0 and entity.late == entity.extracted


def test_gate_fails_the_run_and_keeps_watermarks(spark, loaded, source):
    warehouse, _ = loaded
    stray = (
        warehouse.read("orders").limit(1)
        .withColumn("order_id", F.lit(990001).cast("bigint"))
        .withColumn("order_date", F.lit("2045-01-01").cast("timestamp"))
    )
    upsert(warehouse, model.ORDERS, stray.select(*model.ORDERS.columns), job.utc_now())
    marks = warehouse.read("watermarks").count()
    with pytest.raises(quality.QualityGateError, match="default_partition_rows"):
        job.run(spark, source, warehouse.root, is_incremental=True, skip_transform=True, shards=2)
    last = monitoring.recent_runs(monitoring.run_history(warehouse.read("run_events")), 1).first()
    assert last.status == "failed" and "default_partition_rows" in last.error_message
    assert warehouse.read("watermarks").count() == marks
    names = ["default_partition_rows", "future_dated_orders"]
    verdicts = job.check(warehouse, 1, "by-hand", job.utc_now(), names)
    assert quality.gate(verdicts, blocking=False) == ["default_partition_rows"]
    assert job.drop_old_months(warehouse, "1999-01-01") == []
    warehouse.drop_partitions("orders", "month", ["2045-01"])


def test_rollup_rebuild_drops_months_left_empty(loaded):
    warehouse, _ = loaded
    job.refresh_daily_sales(
        warehouse, fixtures.START.date(), fixtures.START.date().replace(month=12), job.utc_now()
    )
    months = warehouse.partitions("daily_sales", "month")
    assert "2026-02" in months
    warehouse.drop_partitions("order_items", "month", ["2026-02"])
    job.refresh_daily_sales(
        warehouse, fixtures.START.date(), fixtures.START.date().replace(month=12), job.utc_now()
    )
    assert warehouse.partitions("daily_sales", "month") == [m for m in months if m != "2026-02"]


def test_quarantine_and_replayable_rejects(spark, data, tmp_path):
    """A bad customer reference costs the order, and the order its lines."""
    broken = {name: [dict(r) for r in rows] for name, rows in data.items()}
    broken["orders"][0]["customer_id"] = 999999
    broken["order_items"][5]["quantity"] = 0
    broken["products"][1]["sku"] = broken["products"][0]["sku"]
    broken["orders"].append({**broken["orders"][3], "status": "Shipped"})
    lost_product = broken["products"][1]["product_id"]
    first_order = broken["orders"][0]["order_id"]
    source = fixtures.write(tmp_path / "src", broken)
    warehouse = Warehouse(spark, str(tmp_path / "wh"), 2)
    rejects = str(tmp_path / "rejects")
    reports = {}
    for entity in model.ENTITIES:
        raw = csv_source.read(spark, entity, source)
        reports[entity.name] = load_entity(
            warehouse, entity, raw, 7, job.utc_now(), reject_dir=rejects
        )
    assert reports["products"].reasons == {"duplicate_sku": 1}
    assert reports["orders"].reasons == {"missing_customer_id": 1}
    items = [i for n, i in enumerate(broken["order_items"]) if n != 5]
    orphans = [i for i in items if i["order_id"] == first_order]
    stray = [i for i in items if i["product_id"] == lost_product and i["order_id"] != first_order]
    assert reports["order_items"].reasons == {
        "quantity_invalid": 1,
        "missing_order_id_order_date": len(orphans),
        "missing_product_id": len(stray),
    }
    # The repeated order is collapsed to its last statement.
    repeated = broken["orders"][3]["order_id"]
    assert [r.status for r in warehouse.read("orders").filter(F.col("order_id") == repeated).collect()] == [
        "Shipped"
    ]
    stored = sinks.read_rejects(spark, rejects)
    by_reason = {(r.entity, r.reason): r["count"] for r in stored.groupBy("entity", "reason").count().collect()}
    assert by_reason[("orders", "missing_customer_id")] == 1
    assert by_reason[("order_items", "quantity_invalid")] == 1
    raw = stored.filter("reason = 'missing_customer_id'").first().raw_row
    assert '"customer_id":"999999"' in raw
    (replayed,) = sinks.replay(stored.filter("reason = 'missing_customer_id'"), model.ORDERS).collect()
    assert replayed.asDict() == {k: str(v) if v != "" else None for k, v in broken["orders"][0].items()}


def test_sources_are_verified_first(spark, source, data, tmp_path):
    totals = {r.entity: r.rows for r in csv_source.verify(spark, source).collect()}
    assert totals == {name: len(rows) for name, rows in data.items()}
    with pytest.raises(FileNotFoundError):
        csv_source.verify(spark, str(tmp_path / "nowhere"))
    renamed = {
        "orders": [{("date_of_order" if k == "order_date" else k): v for k, v in r.items()} for r in data["orders"]]
    }
    bad = fixtures.write(tmp_path / "bad", {**data, **renamed})
    with pytest.raises(ValueError, match=r"missing column\(s\): order_date"):
        csv_source.verify(spark, bad)
    assert job.main(["--source", str(tmp_path / "nowhere"), "--warehouse", str(tmp_path / "w")]) == job.NO_SOURCE


def test_stream_loads_new_files_once(spark, loaded, data, tmp_path):
    """Files arriving in a folder are merged; a second start reads only new ones."""
    base, _ = loaded
    warehouse = Warehouse(spark, str(tmp_path / "wh"), 2)
    for name in ("product_categories", "products", "customers"):
        column = model.BY_NAME[name].partition_column
        warehouse.replace_partitions(name, base.read(name), column)
    folder = tmp_path / "orders"
    fixtures.write(folder, {"part-1": data["orders"][:20]})
    reports = []

    def load() -> None:
        rows = stream_load.csv_stream(spark, model.ORDERS, str(folder))
        stream_load.start_load(
            warehouse, model.ORDERS, rows, str(tmp_path / "ckpt"), on_report=reports.append
        ).awaitTermination()

    load()
    fixtures.write(folder, {"part-2": data["orders"][10:40]})
    load()
    assert [(r.extracted, r.inserted, r.updated) for r in reports] == [(20, 20, 0), (30, 20, 10)]
    assert reports[1].late == 10
    assert warehouse.read("orders").count() == 40


def test_staged_rows_carry_source_text_for_a_quarantine_only(spark, source, tmp_path, monkeypatch):
    """Without a folder for rejects nobody reads the text; with one every row still has it."""
    from tallyhouse.operators.validate import RAW
    from tallyhouse.plans import load

    texts = []
    whole = load._load_staged

    def seen(warehouse, entity, staged, *rest):
        texts.append((staged.count(), staged.filter(F.col(RAW).isNotNull()).count()))
        return whole(warehouse, entity, staged, *rest)

    monkeypatch.setattr(load, "_load_staged", seen)
    reports = []
    for n, folder in enumerate((None, str(tmp_path / "rejects"))):
        warehouse = Warehouse(spark, str(tmp_path / f"wh{n}"), 2)
        raw = csv_source.read(spark, model.CUSTOMERS, source)
        reports.append(load_entity(warehouse, model.CUSTOMERS, raw, 7, job.utc_now(), reject_dir=folder))
    (rows, without), (again, kept) = texts
    assert rows == again == kept > 0 and without == 0
    assert reports[0].inserted == reports[1].inserted == rows
