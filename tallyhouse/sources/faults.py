"""Source rows as text, with faults planted by the values of the tables.

Every row of the supplied tables is present; rows with certain sizes, nations,
priorities or line numbers carry a defect that the rules must attribute.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyhouse.sources import sample


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _iso(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")


def _plant(case: Column, normal: Column, faults: dict[object, Column | str | None]) -> Column:
    """``normal`` unless ``case`` equals one of the fault keys."""

    def as_column(value: Column | str | None) -> Column:
        return value if isinstance(value, Column) else F.lit(value).cast("string")

    expr = reduce(
        lambda e, item: e.when(case == item[0], as_column(item[1])),
        faults.items(),
        F.when(F.lit(False), normal),
    )
    return expr.otherwise(normal)


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = sample.categories(spark, sf_dir)
    brand = F.coalesce("description", F.lit(""))
    identity = _text("category_id")
    return base.select(
        _plant(brand, identity, {"Brand#9": "abc", "Brand#10": F.concat(identity, F.lit(".0"))}).alias(
            "category_id"
        ),
        _plant(brand, F.col("name"), {"Brand#3": " \t ", "Brand#9": None}).alias("name"),
        F.col("description"),
        _plant(brand, _text("parent_id"), {"Brand#5": "-5", "Brand#7": identity}).alias("parent_id"),
        F.col("category_id").alias("row_id"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = sample.products(spark, sf_dir)
    size = F.col("inventory_count")
    identity = _text("product_id")
    return base.select(
        _plant(size, identity, {1: "abc", 12: F.concat(identity, F.lit(".0"))}).alias("product_id"),
        _plant(size, F.col("name"), {2: "  ", 16: None, 18: F.repeat("name", 60)}).alias("name"),
        F.col("description"),
        _plant(
            size,
            _text("price"),
            {
                5: "-1.00",
                6: "not-a-number",
                12: "1e3",
                14: " 12.345 ",
                15: "1,000",
                16: "-2",
                17: "99999999999",
                19: "inf",
                20: "0.00",
            },
        ).alias("price"),
        _plant(size, _text("cost"), {7: "-3", 20: None}).alias("cost"),
        _plant(size, _text("category_id"), {4: "0"}).alias("category_id"),
        _plant(size, F.col("sku"), {3: None}).alias("sku"),
        _plant(size, _text("inventory_count"), {8: "-1", 13: None}).alias("inventory_count"),
        _plant(size, _text("weight"), {9: "-0.5", 20: None}).alias("weight"),
        _plant(size, _text("is_active"), {10: "maybe", 11: " F ", 21: "YES"}).alias("is_active"),
        F.col("product_id").alias("row_id"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = sample.customers(spark, sf_dir)
    nation = F.regexp_extract("country", r"(\d+)$", 1).cast("int")
    registered = _iso(F.col("registration_date"))
    return base.select(
        _plant(nation, _text("customer_id"), {12: "-4"}).alias("customer_id"),
        _plant(
            nation,
            F.col("email"),
            {
                1: "not-an-email",
                2: "no@tld",
                3: "a b@x.com",
                9: F.upper(F.concat(F.lit("  "), "email")),
                13: "@example.com",
            },
        ).alias("email"),
        _plant(nation, F.col("first_name"), {4: ""}).alias("first_name"),
        _plant(nation, F.col("last_name"), {5: " ", 16: "NA"}).alias("last_name"),
        F.col("street_address"),
        F.col("city"),
        F.col("state"),
        _plant(nation, F.col("zip_code"), {15: "1234567890123456789012345"}).alias("zip_code"),
        F.col("country"),
        F.col("phone"),
        _plant(
            nation,
            registered,
            {
                6: "nonsense",
                10: "1995-03-15T10:00:00+02:00",
                11: "19950315",
                14: "12:30:00",
                17: "1995-03",
            },
        ).alias("registration_date"),
        _plant(
            nation, F.lit("2001-01-01T00:00:00"), {7: "1994-01-01T00:00:00", 8: None}
        ).alias("last_login"),
        F.col("customer_id").alias("row_id"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = sample.table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") + 1).alias("order_id"),
        F.concat("o_orderstatus", F.substring("o_orderpriority", 1, 1)).alias("kind"),
    )
    base = sample.orders(spark, sf_dir).join(source, "order_id")
    kind = F.col("kind")
    return base.select(
        _plant(kind, _text("order_id"), {"O1": "zz"}).alias("order_id"),
        _plant(kind, _text("customer_id"), {"O2": "0"}).alias("customer_id"),
        _plant(kind, _iso(F.col("order_date")), {"O3": "nonsense"}).alias("order_date"),
        _plant(kind, F.col("status"), {"O4": "Teleported"}).alias("status"),
        _plant(kind, F.col("payment_method"), {"O5": "Barter"}).alias("payment_method"),
        _plant(kind, F.col("shipping_address"), {"F2": " "}).alias("shipping_address"),
        _plant(kind, F.col("shipping_city"), {"F4": ""}).alias("shipping_city"),
        F.col("shipping_state"),
        _plant(kind, F.col("shipping_zip"), {"F5": None}).alias("shipping_zip"),
        F.col("shipping_country"),
        _plant(kind, _iso(F.col("processing_date")), {"P1": None}).alias("processing_date"),
        _iso(F.col("shipping_date")).alias("shipping_date"),
        _plant(kind, _iso(F.col("delivery_date")), {"F3": "1994-01-01T00:00:00"}).alias(
            "delivery_date"
        ),
        _plant(kind, _text("total_amount"), {"F1": "-1.00", "P2": "abc"}).alias("total_amount"),
        F.col("order_id").alias("row_id"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = sample.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    base = (
        sample.table(spark, sf_dir, "lineitem")
        .join(dates, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            *sample.line_columns(),
            F.concat(F.col("l_linenumber").cast("string"), "l_returnflag").alias("kind"),
        )
    )
    kind = F.col("kind")
    gross = (F.col("unit_price") * F.col("quantity")).cast("decimal(12,2)")
    cent = F.lit("0.01").cast("decimal(2,2)")
    return base.select(
        _plant(kind, _text("order_item_id"), {"4R": "inf"}).alias("order_item_id"),
        _plant(kind, _text("order_id"), {"1R": "x"}).alias("order_id"),
        _plant(kind, _iso(F.col("order_date")), {"2R": ""}).alias("order_date"),
        _plant(kind, _text("product_id"), {"3R": "-1"}).alias("product_id"),
        _plant(kind, _text("quantity"), {"1A": "0", "7A": "2.5", "5R": "0"}).alias("quantity"),
        _plant(kind, _text("unit_price"), {"2A": "-5"}).alias("price"),
        _plant(
            kind,
            _text("discount"),
            {
                "3A": "99999999.99",
                "4A": "-1",
                "5A": None,
                "5R": "9999",
                "6R": gross.cast("string"),
                "7R": (gross + cent).cast("string"),
            },
        ).alias("discount"),
        _plant(kind, _text("line_revenue"), {"6A": "1.00"}).alias("total"),
        F.col("order_item_id").alias("row_id"),
        F.col("kind"),
    )
