"""Each rule: the bad row gets its reason, the neighbours survive."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse import model
from tallyhouse.functions import parsing
from tallyhouse.operators import references, validate
from tallyhouse.operators.validate import MISMATCH, RAW, REASON

CATEGORY = {"category_id": "2", "name": "Audio", "description": "d2", "parent_id": "1"}
PRODUCT = {
    "product_id": "1", "name": "Widget", "description": "d", "price": "10.00", "cost": "4.00",
    "category_id": "1", "sku": "SKU-1", "inventory_count": "5", "weight": "1.0", "is_active": "true",
}
CUSTOMER = {
    "customer_id": "1", "email": "A@Example.COM", "first_name": "Ada", "last_name": "Lovelace",
    "street_address": None, "city": None, "state": None, "zip_code": None, "country": "UK",
    "phone": None, "registration_date": "2024-01-01T00:00:00", "last_login": "2025-01-01T00:00:00",
}
ORDER = {
    "order_id": "1", "customer_id": "1", "order_date": "2026-03-15T10:00:00", "status": "Delivered",
    "payment_method": "PayPal", "shipping_address": "1 St", "shipping_city": "T",
    "shipping_state": "CA", "shipping_zip": "90210", "shipping_country": "US",
    "processing_date": "2026-03-16T10:00:00", "shipping_date": "2026-03-17T10:00:00",
    "delivery_date": "2026-03-18T10:00:00", "total_amount": "100.00",
}
ITEM = {
    "order_item_id": "1", "order_id": "1", "order_date": "2026-03-15T10:00:00", "product_id": "1",
    "quantity": "2", "price": "50.00", "discount": "0.00", "total": "100.00",
}

CASES = {
    "product_categories": (
        CATEGORY,
        [
            ({}, None),
            ({"parent_id": None}, None),
            ({"category_id": "2.0"}, None),
            ({"category_id": "abc"}, "category_id_invalid"),
            ({"category_id": "1.5"}, "category_id_invalid"),
            ({"name": " \t "}, "name_blank"),
            ({"name": None, "parent_id": "2"}, "name_blank"),
            ({"parent_id": "-3"}, "parent_id_invalid"),
            ({"parent_id": "1.5"}, "parent_id_invalid"),
            ({"parent_id": "2"}, "parent_is_self"),
            ({"name": "x" * 101}, "name_too_long"),
        ],
    ),
    "products": (
        PRODUCT,
        [
            ({}, None),
            ({"price": "0.00", "cost": None, "weight": None}, None),
            ({"price": "1e3"}, None),
            ({"price": "-1.00"}, "price_invalid"),
            ({"price": "not-a-number"}, "price_invalid"),
            ({"price": "inf"}, "price_invalid"),
            ({"price": "1,000"}, "price_invalid"),
            ({"price": "123456789.00"}, "price_out_of_range"),
            ({"sku": " "}, "sku_blank"),
            ({"cost": "-0.01"}, "cost_invalid"),
            ({"inventory_count": None}, None),
            ({"inventory_count": "-1"}, "inventory_invalid"),
            ({"weight": "-1"}, "weight_invalid"),
            ({"category_id": None}, "category_id_invalid"),
            ({"product_id": "9007199254740993"}, None),
            ({"product_id": "99999999999999999999"}, "product_id_invalid"),
            ({"is_active": "perhaps"}, None),
        ],
    ),
    "customers": (
        CUSTOMER,
        [
            ({}, None),
            ({"email": "not-an-email"}, "email_invalid"),
            ({"email": "no@tld"}, "email_invalid"),
            ({"email": "@example.com"}, "email_invalid"),
            ({"email": "a b@x.com"}, "email_invalid"),
            ({"email": None}, "email_invalid"),
            ({"last_login": "2000-01-01T00:00:00"}, "last_login_before_registration"),
            ({"last_login": None}, None),
            ({"registration_date": "12:30:00"}, "registration_date_invalid"),
            ({"last_name": "NA"}, None),
            ({"last_name": "null"}, None),
            ({"first_name": ""}, "first_name_blank"),
        ],
    ),
    "orders": (
        ORDER,
        [
            ({}, None),
            ({"status": "Teleported"}, "status_unknown"),
            ({"payment_method": "Barter"}, "payment_method_unknown"),
            ({"total_amount": "-1.00"}, "total_amount_invalid"),
            ({"order_date": "nonsense"}, "order_date_invalid"),
            ({"delivery_date": "2000-01-01T00:00:00"}, "date_sequence_invalid"),
            ({"processing_date": None, "shipping_date": None, "delivery_date": None}, None),
            ({"shipping_address": None}, "shipping_address_blank"),
            ({"shipping_state": " "}, "shipping_state_blank"),
        ],
    ),
    "order_items": (
        ITEM,
        [
            ({}, None),
            ({"quantity": "0"}, "quantity_invalid"),
            ({"quantity": "0", "discount": "9999"}, "quantity_invalid"),
            ({"discount": "500"}, "discount_invalid"),
            ({"discount": "100"}, None),
            ({"discount": "100.01"}, "discount_invalid"),
            ({"discount": "-1"}, "discount_invalid"),
            ({"discount": None}, None),
            ({"total": "999.99"}, None),
            ({"price": None}, "unit_price_invalid"),
        ],
    ),
}


def frame(spark, entity, rows):
    schema = ", ".join(f"{c} string" for c in [*entity.source_columns, "n"])
    return spark.createDataFrame([tuple(r[c] for c in [*entity.source_columns, "n"]) for r in rows], schema)


@pytest.mark.parametrize("name", list(CASES))
def test_rules(spark, name):
    entity, (base, cases) = model.BY_NAME[name], CASES[name]
    rows = [{**base, **override, "n": str(i)} for i, (override, _) in enumerate(cases)]
    raw = frame(spark, entity, rows).withColumn(validate.POSITION, F.col("n"))
    got = {r[validate.POSITION]: r for r in validate.classify(entity, raw).collect()}
    assert {n: r[REASON] for n, r in got.items()} == {
        str(i): reason for i, (_, reason) in enumerate(cases)
    }
    for n, row in got.items():
        override = cases[int(n)][0]
        for column, text in override.items():
            assert row[RAW][column] == text
    if name == "order_items":
        assert {n for n, r in got.items() if r[MISMATCH] and r[REASON] is None} == {"4", "8"}
        assert got["7"].discount == 0
    if name == "products":
        assert got["14"].product_id == 9007199254740993
        assert got["10"].inventory_count == 0 and got["16"].is_active is True
    if name == "customers":
        assert got["0"].email == "a@example.com"


def test_empty_input_and_unknown_entity(spark):
    empty = frame(spark, model.ORDERS, []).drop("n")
    assert validate.classify(model.ORDERS, empty).count() == 0
    with pytest.raises(ValueError, match="no rules"):
        validate.rules_for(model.Entity("nothing", (), ()), {})


def test_classify_partitions_the_input(spark):
    entity, (base, cases) = model.ORDERS, CASES["orders"]
    rows = [{**base, **o, "n": "x"} for o, _ in cases]
    classified = validate.classify(entity, frame(spark, entity, rows))
    clean, bad = validate.accepted(classified).count(), validate.rejected(classified).count()
    assert clean + bad == len(cases)
    assert sum(r.rows for r in validate.reason_counts(classified).collect()) == bad


def test_timestamps(spark):
    texts = {
        "2026": datetime(2026, 1, 1),
        "2026-03": datetime(2026, 3, 1),
        "20260315": datetime(2026, 3, 15),
        "20260315T101112": datetime(2026, 3, 15, 10, 11, 12),
        "2026-03-15T10:00:00+02:00": datetime(2026, 3, 15, 8),
        "2026-03-15 10:00:00Z": datetime(2026, 3, 15, 10),
        "2026-03-15T10:00:00": datetime(2026, 3, 15, 10),
        "2026-13-01": None,
        "12:30:00": None,
        "": None,
        "now": None,
    }
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", parsing.timestamp(F.col("t")).alias("ts")
    )
    assert {r.t: r.ts for r in got.collect()} == texts


def test_booleans_and_trim(spark):
    words = {" TRUE ": True, "t": True, "1": True, "Yes": True, "F": False, "0": False, "no": False, "x": None}
    got = spark.createDataFrame([(w,) for w in words], "w string").select(
        "w", parsing.boolean(F.col("w")).alias("b")
    )
    assert {r.w: r.b for r in got.collect()} == words
    padded = spark.createDataFrame([(" \t x y  \n",)], "w string")
    assert padded.select(parsing.trimmed(F.col("w"))).first()[0] == "x y"


def open_rows(spark, rows, schema):
    return spark.createDataFrame(rows, schema).withColumn(REASON, F.lit(None).cast("string"))


def test_orphans_are_charged_to_the_first_broken_reference(spark):
    day = datetime(2026, 3, 15)
    items = open_rows(
        spark,
        [(1, 1, day, 1), (2, 9, day, 1), (3, 1, datetime(2026, 3, 16), 1), (4, 1, day, 8), (5, 9, day, 8)],
        "order_item_id long, order_id long, order_date timestamp, product_id long",
    )
    parents = {
        "orders": spark.createDataFrame([(1, day)], "order_id long, order_date timestamp"),
        "products": spark.createDataFrame([(1,)], "product_id long"),
    }
    got = references.check_references(model.ORDER_ITEMS, items, parents).collect()
    assert {r.order_item_id: r[REASON] for r in got} == {
        1: None,
        2: "missing_order_id_order_date",
        3: "missing_order_id_order_date",
        4: "missing_product_id",
        5: "missing_order_id_order_date",
    }


def test_broken_category_chains_are_removed_whole(spark):
    """99 is nowhere: 10 goes, then its child, then its grandchild. A cycle
    and a child of a stored category stay."""
    staged = open_rows(
        spark,
        [(1, None), (2, 1), (10, 99), (11, 10), (12, 11), (20, 21), (21, 20), (30, 500)],
        "category_id long, parent_id long",
    )
    stored = spark.createDataFrame([(500,)], "category_id long")
    got = references.check_references(model.CATEGORIES, staged, {model.CATEGORIES.name: stored})
    assert {r.category_id for r in got.collect() if r[REASON]} == {10, 11, 12}


def test_natural_keys(spark):
    """A stored row keeps its value, else the lowest id; moving away frees it."""
    rows = open_rows(
        spark, [(1, "a"), (2, "a"), (3, "b"), (4, "c"), (5, "d")], "product_id long, sku string"
    )
    stored = spark.createDataFrame([(90, "b"), (4, "d")], "product_id long, sku string")
    got = references.check_unique(model.PRODUCTS, rows, stored).collect()
    assert {r.product_id: r[REASON] for r in got} == {
        1: None, 2: "duplicate_sku", 3: "duplicate_sku", 4: None, 5: None,
    }


def test_rules_do_not_run_on_copied_parsing(spark):
    """A filter on the reason stays above the parsing, also when the rows come from a join."""
    columns = model.ORDER_ITEMS.source_columns
    lines = spark.createDataFrame([("1",) * len(columns)], list(columns))
    days = spark.createDataFrame([("1", "2026-01-01")], "order_id string, day string")
    raw = lines.drop("order_date").join(days, "order_id").withColumnRenamed("day", "order_date")
    classified = validate.classify(model.ORDER_ITEMS, raw)
    parsing = [
        df._jdf.queryExecution().optimizedPlan().toString().count("trim(")
        for df in (classified, validate.accepted(classified), validate.rejected(classified))
    ]
    assert parsing[0] == parsing[1] == parsing[2] > 0
