"""Operators on small frames with known answers."""

from __future__ import annotations

import itertools
import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse import model
from tallyhouse.functions.holidays import holiday_name
from tallyhouse.functions.money import from_cents, ratio_2dp, sum_money
from tallyhouse.operators import (
    calendar_dim,
    hierarchy,
    lookups,
    merge,
    paging,
    references,
    rollups,
    updates,
)
from tallyhouse.plans import incremental, monitoring, quality, reports
from tallyhouse.plans.load import upsert
from tallyhouse.session import cut_lineage
from tallyhouse.sources.warehouse import Warehouse

NOW = datetime(2026, 6, 1)


def orders(spark, rows):
    return spark.createDataFrame(
        [(i, c, d, s, Decimal(t)) for i, c, d, s, t in rows],
        "order_id long, customer_id long, order_date timestamp, status string, total_amount decimal(12,2)",
    )


def items(spark, rows):
    return spark.createDataFrame(
        [(n, o, d, p, q, Decimal(u), Decimal(x), Decimal(u) * q - Decimal(x)) for n, o, d, p, q, u, x in rows],
        "order_item_id long, order_id long, order_date timestamp, product_id long, quantity int, "
        "unit_price decimal(10,2), discount decimal(10,2), line_revenue decimal(12,2)",
    )


def test_rollup_counts_bearing_orders_once(spark):
    day, later = datetime(2026, 3, 15, 10), datetime(2026, 3, 15, 23, 59)
    heads = orders(
        spark,
        [(1, 1, day, "Delivered", "185"), (2, 1, day, "Cancelled", "9"), (1, 1, later, "Shipped", "5")],
    )
    lines = items(
        spark,
        [
            (1, 1, day, 1, 2, "100.00", "15.00"),
            (2, 2, day, 1, 1, "9.00", "0"),
            (3, 1, later, 1, 1, "5.00", "0"),
            (4, 7, day, 1, 1, "5.00", "0"),
        ],
    )
    products = spark.createDataFrame([(1, 4)], "product_id long, category_id long")
    (row,) = rollups.daily_sales(rollups.sold_lines(lines, heads), products).collect()
    assert (row.sale_date, row.date_key, row.category_id) == (date(2026, 3, 15), 20260315, 4)
    assert (row.units_sold, row.gross_revenue, row.discount_total, row.net_revenue) == (
        3, Decimal("205.00"), Decimal("15.00"), Decimal("190.00"),
    )
    # One order id, though it occurs at two moments of the day.
    assert row.order_count == 1
    assert row.avg_unit_price == Decimal("68.33")


def test_customer_metrics(spark):
    heads = orders(
        spark,
        [
            (1, 1, datetime(2026, 3, 15), "Delivered", "185"),
            (2, 1, datetime(2026, 3, 25), "Shipped", "100"),
            (3, 1, datetime(2026, 4, 4), "Pending", "100"),
            (4, 1, datetime(2026, 5, 4), "Returned", "100"),
            (5, 2, datetime(2026, 5, 4), "Pending", "10.01"),
        ],
    )
    customers = spark.createDataFrame([(1,), (2,), (3,)], "customer_id long")
    got = {r.customer_id: r for r in rollups.customer_metrics(customers, heads).collect()}
    assert (got[1].total_orders, got[1].lifetime_value) == (3, Decimal("385.00"))
    assert got[1].avg_days_between_orders == Decimal("10.00")
    assert got[1].avg_order_value == Decimal("128.33")
    assert got[2].avg_days_between_orders is None and got[2].total_orders == 1
    assert got[3].lifetime_value == 0 and got[3].first_order_date is None
    only = spark.createDataFrame([(2,)], "customer_id long")
    assert [r.customer_id for r in rollups.customer_metrics(customers, heads, only).collect()] == [2]


def test_money_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(Decimal("0.05"), 10), (Decimal("-0.05"), 10), (Decimal("1.00"), 0)], "a decimal(12,2), n long")
    got = [r[0] for r in df.select(ratio_2dp(F.col("a"), F.col("n"), 10)).collect()]
    assert got == [Decimal("0.01"), Decimal("-0.01"), None]
    assert df.agg(sum_money(F.col("a"))).first()[0] == Decimal("1.00")
    assert df.select(from_cents(F.lit(-5))).first()[0] == Decimal("-0.05")


def test_closure_has_roots_depths_and_no_cycles(spark):
    rows = [(1, "Root", None), (2, "Child", 1), (3, "Leaf", 2), (7, "A", 8), (8, "B", 7)]
    tree = spark.createDataFrame(rows, "category_id long, name string, parent_id long")
    closure = hierarchy.category_closure(tree)
    got = {r.category_id: (r.root_category_name, r.depth, list(r.path)) for r in closure.collect()}
    assert got == {1: ("Root", 1, [1]), 2: ("Root", 2, [1, 2]), 3: ("Root", 3, [1, 2, 3])}
    # The subtree test is on the root: a mid-level category matches itself only.
    assert {r[0] for r in hierarchy.subtree(closure, 2).collect()} == {2}
    assert {r[0] for r in hierarchy.subtree(closure, 1).collect()} == {1, 2, 3}


def test_closure_of_a_deep_tree(spark):
    """A chain of 1,000, hung upside down so that ids tell nothing, beside a ring and an orphan."""
    chain = [(i, f"n{i}", i + 1 if i < 1000 else None) for i in range(1, 1001)]
    rest = [(2001, "a", 2002), (2002, "b", 2003), (2003, "c", 2001), (2004, "below a ring", 2001), (3001, "orphan", 3000), (4, "self", 4)]
    tree = spark.createDataFrame(chain[:3] + chain[4:] + rest, "category_id long, name string, parent_id long")
    got = {r.category_id: r for r in hierarchy.category_closure(tree).collect()}
    assert set(got) == set(range(5, 1001))
    assert got[5].depth == 996 and got[5].root_category_name == "n1000"
    assert list(got[998].path) == [1000, 999, 998]
    assert hierarchy.category_closure(tree.limit(0)).count() == 0


def test_stored_lookup_reads_only_the_shards_of_its_keys(spark, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/tables", 64)
    rows = spark.range(2000).select(F.col("id").alias("category_id"), F.concat(F.lit("c"), "id").alias("name"))
    rows = rows.withColumn("description", F.lit("")).withColumn("parent_id", F.lit(None).cast("bigint"))
    upsert(warehouse, model.CATEGORIES, rows, datetime(2026, 1, 1))
    keys = spark.createDataFrame([(3,), (3,), (700,), (-1,), (None,)], "category_id long")
    found = lookups.lookup_stored(warehouse, model.CATEGORIES, keys)
    assert {(r.category_id, r.name) for r in found.collect()} == {(3, "c3"), (700, "c700"), (-1, None)}
    scan = found._jdf.queryExecution().toString()
    wanted = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "shard" in wanted and wanted.count(",") <= 3
    assert lookups.lookup_stored(warehouse, model.CATEGORIES, keys.limit(0)).count() == 0


def test_date_dimension(spark):
    got = {r.date: r for r in calendar_dim.date_dimension(spark, "2026-01-01", "2026-12-31").collect()}
    assert len(got) == 365
    assert got[date(2026, 1, 19)].holiday_name == "Martin Luther King Jr. Day"
    assert got[date(2026, 11, 26)].holiday_name == "Thanksgiving Day"
    assert got[date(2026, 3, 15)].is_weekend and not got[date(2026, 3, 15)].is_holiday
    for day, row in got.items():
        iso = day.isocalendar()
        assert (row.date_key, row.day_of_week, row.week_of_year) == (
            int(day.strftime("%Y%m%d")), iso.weekday, iso.week,
        )
        assert (row.day_name, row.month_name, row.day_of_year) == (
            day.strftime("%A"), day.strftime("%B"), int(day.strftime("%j")),
        )
    with pytest.raises(ValueError, match="precedes"):
        calendar_dim.date_dimension(spark, "2026-02-01", "2026-01-01")
    assert calendar_dim.declared_months(spark).count() == 144
    days = calendar_dim.date_dimension(spark)
    assert days.count() == 7670
    assert days.filter(F.year("date") == 2026).filter(holiday_name(F.col("date")).isNotNull()).count() == 11


def test_months(spark):
    declared = calendar_dim.months_between(spark, "2026-01-15", "2026-03-01")
    span = spark.createDataFrame([(date(2026, 2, 10), date(2026, 5, 1))], "start date, end date")
    assert [r[0] for r in calendar_dim.new_months(declared, span).orderBy("month_start").collect()] == [
        date(2026, 4, 1), date(2026, 5, 1),
    ]
    old = calendar_dim.months_before(declared, "2026-03-01").collect()
    assert [r.month_start for r in old] == [date(2026, 1, 1), date(2026, 2, 1)]


def table(spark, rows):
    return spark.createDataFrame(
        rows, "category_id long, name string, parent_id long, created_at timestamp, updated_at timestamp"
    )


def test_merge_keeps_created_and_moves_updated_on_real_change(spark):
    old = datetime(2026, 1, 1)
    stored = table(spark, [(1, "a", None, old, old), (2, "b", None, old, old), (3, "c", 1, old, old)])
    staged = spark.createDataFrame([(2, "b", None), (3, "C", 1), (4, "d", 1)], "category_id long, name string, parent_id long")
    merged = merge.merge(stored, staged, ["category_id"], ["name", "parent_id"], NOW)
    got = {r.category_id: (r.name, r.created_at, r.updated_at, r[merge.CHANGE]) for r in merged.collect()}
    assert got == {
        1: ("a", old, old, "keep"),
        2: ("b", old, old, "update"),
        3: ("C", old, NOW, "update"),
        4: ("d", NOW, NOW, "insert"),
    }
    assert tuple(merge.change_counts(merged).first()) == (1, 2)
    assert [r[0] for r in merge.insert_only(stored, staged, ["category_id"]).select("category_id").collect()] == [4]
    again = merge.merge(merged.drop(merge.CHANGE), staged, ["category_id"], ["name", "parent_id"], NOW + timedelta(1))
    assert {r.category_id: r.updated_at for r in again.collect()} == {k: v[2] for k, v in got.items()}


def test_last_row_of_a_hot_key_wins(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 4000, 1).otherwise(F.col("id")).alias("k"), "id")
    last = merge.last_per_key(df, ["k"], [F.col("id").desc()])
    assert last.count() == 1001
    assert last.filter("k = 1").first().id == 3999
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_update_outcomes(spark):
    products = spark.createDataFrame(
        [(i, f"P{i}", None, Decimal("5.00"), None, 1, f"S{i}", 3, None, True) for i in (1, 2, 3)],
        ", ".join(f"{f.name} {f.type}" for f in model.PRODUCTS.fields),
    )
    categories = spark.createDataFrame([(1,)], "category_id long")
    changes = spark.createDataFrame(
        [
            (1, "New", None, None, None), (2, None, Decimal("-1.00"), "S1", None), (3, None, None, "S1", None),
            (4, "x", None, None, None), (5, None, None, None, None),
        ],
        "product_id long, name string, price decimal(10,2), sku string, category_id long",
    )
    got = {r.product_id: (r.success, r.message) for r in updates.outcomes(changes, products, categories).collect()}
    assert got == {
        1: (True, updates.UPDATED),
        2: (False, "Update rejected: chk_products_price_non_negative."),
        3: (False, updates.DUPLICATE_SKU),
        4: (False, "No product with id 4."),
        5: (False, updates.NO_FIELDS),
    }
    lost = spark.createDataFrame([(1, 99)], "product_id long, category_id long")
    assert updates.outcomes(lost, products, categories).first().message == updates.MISSING_CATEGORY
    (row,) = updates.apply_updates(changes, products, categories).collect()
    assert (row.product_id, row.name, row.price, row.sku) == (1, "New", Decimal("5.00"), "S1")


def history(spark):
    return orders(
        spark,
        [(i, 1 + i % 2, datetime(2026, 1, 1) + timedelta(days=i // 3), "Delivered", "1") for i in range(40)],
    ).select(
        *[F.col(c) if c in ("order_id", "customer_id", "order_date", "status", "total_amount") else F.lit(None).cast("string").alias(c) for c in reports.ORDER_COLUMNS]
    )


def test_keyset_pages_make_one_long_sort(spark):
    heads = history(spark).checkpoint()
    whole = [r.order_id for r in heads.filter("customer_id = 1").orderBy(F.desc("order_date"), F.desc("order_id")).collect()]
    seen, after = [], None
    for _ in itertools.count():
        page = reports.purchase_history(heads, 1, first=7, after=after).collect()
        seen += [r.order_id for r in page]
        if not page or not page[0].has_next_page:
            break
        after = (page[-1].order_date, page[-1].order_id)
    assert seen == whole


def test_pages_are_disjoint_and_clamped(spark):
    df = spark.range(450).select(F.col("id").alias("product_id"), F.lit(None).cast("string").alias("product_name"))
    order = paging.sort_columns("NAME", reports.PRODUCT_SALES_SORTS, True, "product_id")
    first, second = (paging.page(df, order, 5000, o).collect() for o in (0, 200))
    assert len(first) == len(second) == 200 and first[0].total_count == 450
    assert not {r.product_id for r in first} & {r.product_id for r in second}
    assert first[0].has_next_page and not paging.page(df, order, 200, 300).first().has_next_page
    assert paging.page(df, order, 10, 9999).collect() == []
    with pytest.raises(ValueError, match="unsupported sort"):
        paging.sort_columns("COLOUR", reports.PRODUCT_SALES_SORTS, True, "product_id")
    with pytest.raises(ValueError, match="unsupported granularity"):
        reports.sales_trends(df, "2026-01-01", "2026-01-02", "HOUR")
    assert paging.clamp_per_category(900) == 50 and paging.clamp_page(0, -3) == (1, 0)
    today = date(2026, 6, 1)
    assert paging.resolve_period(None, None, today) == (date(2026, 3, 3), today)
    for start, end in ((today, date(2026, 5, 1)), (today, None), (None, today)):
        with pytest.raises(ValueError):
            paging.resolve_period(start, end)


def test_pages_follow_each_other(spark):
    df = spark.range(0, 1000, 1, 7).select(
        (F.col("id") * 37 % 1000).alias("product_id"), (F.col("id") % 3).alias("units_sold")
    )
    order = paging.sort_columns("UNITS", reports.PRODUCT_SALES_SORTS, True, "product_id")
    whole = [r[:2] for r in df.orderBy(*order).collect()]
    for offset in (0, 150, 333, 960, 2000):
        got = [r[:2] for r in paging.page(df, order, 90, offset).collect()]
        assert got == whole[offset : offset + 90]


def test_nested_orders_have_a_row_per_line(spark):
    day = datetime(2026, 1, 1)
    page = orders(spark, [(1, 1, day, "Shipped", "1"), (2, 1, day, "Shipped", "1")])
    lines = items(spark, [(n, 1, day, 1, 1, "1.00", "0") for n in range(1, 101)])
    products = spark.createDataFrame([(1, "P")], "product_id long, name string")
    customers = spark.createDataFrame(
        [(1, "e", "f", "l", "US")], "customer_id long, email string, first_name string, last_name string, country string"
    )
    got = lookups.nested_order_page(page, lines, products, customers).collect()
    assert sorted(r["item"].order_item_id for r in got if r.order_id == 1) == list(range(1, 101))
    (empty,) = [r for r in got if r.order_id == 2]
    assert empty["item"] is None and empty.customer.email == "e"


def test_uniqueness_to_a_fixpoint(spark):
    """A row that is rejected keeps its stored value, which others then cannot take."""
    schema = "product_id long, sku string"
    stored = spark.createDataFrame([(1, "X"), (3, "Y")], schema)
    batch = spark.createDataFrame([(1, "Y"), (2, "X")], schema)
    lost = references.duplicate_claims(batch, stored, "product_id", "sku")
    assert {r.product_id for r in lost.collect()} == {1, 2}
    swap = spark.createDataFrame([(1, "Y"), (3, "X")], schema)
    assert references.duplicate_claims(swap, stored, "product_id", "sku").isEmpty()


def lost_round_by_round(batch, stored):
    """Remove every row whose value is another's, until nothing more is removed."""
    alive, lost = dict(batch), set()
    while True:
        claims = {}
        for k, v in alive.items():
            claims.setdefault(v, []).append((1, k))
        for k, v in stored.items():
            if k not in alive:
                claims.setdefault(v, []).append((0, k))
        gone = {k for k, v in alive.items() if v is not None and min(claims[v])[1] != k}
        if not gone:
            return lost
        lost |= gone
        alive = {k: v for k, v in alive.items() if k not in gone}


def test_claims_equal_removal_round_by_round(spark):
    """Many small cases at once: keys and values carry the number of their case."""
    pick, schema = random.Random(5), "product_id long, sku string"
    batch, stored, want = [], [], set()
    for case in range(300):
        keys, values = range(case * 100, case * 100 + 7), [f"{case}-{n}" for n in range(6)]
        held = dict(zip(keys, pick.sample(values, pick.randint(0, 6))))
        asked = {k: pick.choice([*values, None]) for k in keys if pick.random() < 0.7}
        want |= lost_round_by_round(asked, held)
        batch += asked.items()
        stored += held.items()
    lost = references.duplicate_claims(
        spark.createDataFrame(batch, schema), spark.createDataFrame(stored, schema), "product_id", "sku"
    ).collect()
    assert len(lost) == len(want) and {r.product_id for r in lost} == want
    assert all(dict(batch)[r.product_id] == r.sku for r in lost)


@pytest.mark.parametrize("end", ["free", "taken", "ring"])
def test_long_chain_of_swaps(spark, monkeypatch, end):
    """1,000 rows in a row end in about ten rounds, whatever the last one wants."""
    rounds = []
    monkeypatch.setattr(references, "cut_lineage", lambda df: rounds.append(1) or cut_lineage(df))
    schema, n = "product_id long, sku string", 1000
    stored = spark.createDataFrame([(i, f"S{i}") for i in range(n + 1)], schema)
    last = {"free": "new", "taken": f"S{n}", "ring": "S0"}[end]
    batch = spark.createDataFrame([(i, f"S{i + 1}" if i < n - 1 else last) for i in range(n)], schema)
    lost = references.duplicate_claims(batch, stored, "product_id", "sku")
    assert lost.count() == (n if end == "taken" else 0)
    assert len(rounds) <= 15


def test_claims_on_empty_frames(spark):
    schema = "product_id long, sku string"
    none, some = spark.createDataFrame([], schema), spark.createDataFrame([(1, None), (2, "a")], schema)
    for batch, stored in ((none, some), (some, none), (none, none), (some, some)):
        assert references.duplicate_claims(batch, stored, "product_id", "sku").isEmpty()


def test_change_sets_fold_and_claim(spark):
    products = spark.createDataFrame(
        [(i, f"n{i}", None, 1.0, None, 1, f"S{i}", 1, None, True) for i in range(1, 5)],
        "product_id long, " + ", ".join(
            f"{c} {t}"
            for c, t in zip(
                updates.UPDATABLE,
                ("string", "string", "double", "double", "long", "string", "long", "double", "boolean"),
            )
        ),
    )
    categories = spark.createDataFrame([(1,)], "category_id long")
    changes = spark.createDataFrame(
        [(-5, "FREE", None, 0), (2, "FREE", None, 1), (1, None, "a", 2), (1, None, "b", 3), (3, "S4", None, 4)],
        "product_id long, sku string, name string, change_no long",
    )
    got = [(r.product_id, r.success) for r in updates.outcomes(changes, products, categories).collect()]
    assert sorted(got) == [(-5, False), (1, True), (1, True), (2, True), (3, False)]
    new = {r.product_id: (r.name, r.sku) for r in updates.apply_updates(changes, products, categories).collect()}
    assert new == {1: ("b", "S1"), 2: ("n2", "FREE")}


def test_run_verdicts_and_watermarks(spark):
    at = [datetime(2026, 1, 1, h) for h in range(4)]
    events = spark.createDataFrame(
        [
            (1, "w", "s", "running", at[0], None, None, None, None),
            (1, "w", "s", "failed", at[1], None, None, None, "boom" * 1000),
            (1, "w", "s", "succeeded", at[2], 10, 9, 1, None),
            (2, "w", "s", "running", at[0], None, None, None, None),
            (3, "w", "s", "succeeded", at[0], 10, 10, 0, None),
            (3, "w", "s", "failed", at[1], None, None, None, "gate"),
        ],
        model.RUN_EVENTS_SCHEMA,
    )
    got = {r.run_id: r for r in monitoring.run_history(events).collect()}
    assert (got[1].status, got[1].rows_loaded, len(got[1].error_message)) == ("failed", 9, 2000)
    assert (got[2].status, got[2].finished_at) == ("running", None)
    assert (got[3].status, got[3].error_message, got[3].rows_extracted) == ("failed", "gate", 10)
    seconds = {r.run_id: r.seconds for r in monitoring.run_durations(monitoring.run_history(events)).collect()}
    assert seconds == {1: 7200.0, 3: 3600.0}
    marks = spark.createDataFrame(
        [("e", datetime(2026, 3, 15), 1, at[0]), ("e", datetime(2026, 1, 1), 2, at[1])], model.WATERMARK_SCHEMA
    )
    row = monitoring.latest_watermarks(marks).first()
    assert (row.watermark_ts, row.last_run_id) == (datetime(2026, 3, 15), 2)
    fresh = {r.check_name: r for r in quality.freshness(marks, ["e", "never"], datetime(2026, 3, 17), 3).collect()}
    assert fresh["e_freshness"].observed == 2.0 and fresh["e_freshness"].passed
    assert fresh["never_freshness"].observed == 1e9 and not fresh["never_freshness"].passed


def test_slow_runs_use_the_trailing_week(spark):
    start = datetime(2026, 1, 1)
    runs = [(i, "w", start + timedelta(days=i), 10.0 if i != 20 else 25.0) for i in range(30)]
    df = spark.createDataFrame(runs, "run_id long, workflow string, started_at timestamp, seconds double")
    got = {r.run_id: r for r in monitoring.slow_runs(df).collect()}
    assert len(got) == 30 and [n for n, r in got.items() if r.alert] == [20]
    assert got[0].trailing_median is None and got[7].trailing_median == 10.0


def test_incremental_helpers(spark):
    rows = spark.createDataFrame([(datetime(2026, 1, d),) for d in (1, 2, 3)], "order_date timestamp")
    mark = datetime(2026, 1, 2)
    assert incremental.newer_than(rows, "order_date", mark).count() == 1
    assert incremental.late_rows(rows, "order_date", mark).count() == 2
    assert incremental.late_rows(rows, "order_date", None).count() == 0
    assert incremental.day_span(rows.limit(0), "order_date").first().start is None
    with pytest.raises(ValueError, match="precedes"):
        incremental.rebuild_days(rows, rows, "2026-02-01", "2026-01-01")


def test_trends_keep_totals_at_every_granularity(spark):
    days = [(date(2026, 1, 1) + timedelta(days=n), n % 5, Decimal(n)) for n in range(200)]
    rollup = spark.createDataFrame(days, "sale_date date, product_id long, net_revenue decimal(14,2)").select(
        "*", F.lit(1).cast("bigint").alias("units_sold"), F.col("net_revenue").alias("gross_revenue"),
        F.lit(0).cast("decimal(14,2)").alias("discount_total"), F.lit(1).alias("order_count"),
    ).checkpoint()
    for unit in reports.GRANULARITIES:
        got = reports.sales_trends(rollup, "2026-01-01", "2026-12-31", unit).collect()
        assert sum(r.net_revenue for r in got) == sum(range(200))
    assert got[0].distinct_products == 5
