"""Batched lookups by key, and nested assembly of a page of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyhouse.model import Entity
from tallyhouse.session import broadcast_if_small, cut_lineage
from tallyhouse.sources.warehouse import Warehouse


def lookup(keys: DataFrame, table: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row per distinct key; a key without a match keeps a row of nulls."""
    return keys.select(*on).distinct().join(table, list(on), "left")


def lookup_stored(warehouse: Warehouse, entity: Entity, keys: DataFrame) -> DataFrame:
    """As ``lookup``, against a stored table, reading only partitions that can hold a key.

    The key shards (or months) of the asked keys are literals of the scan, so files
    of other partitions are not opened; there are never more of them than the table
    has partitions. Null keys are left out.
    """
    on = list(entity.key)
    asked = cut_lineage(keys.select(*on).dropna().distinct())
    column = entity.partition_column
    places = [r[0] for r in asked.select(warehouse.partition_of(entity)).distinct().collect()]
    table = warehouse.read(entity.name).filter(F.col(column).isin(*places))
    found = table.join(broadcast_if_small(asked), on, "left_semi")
    return asked.join(found, on, "left")


def rows_of_ids(warehouse: Warehouse, table: str, column: str, ids: Sequence[int | str]) -> DataFrame:
    """Rows of a handful of ids that do not tell their partition.

    Ten ids at a time become a filter that Parquet checks against its Bloom filters
    (``BLOOM_COLUMNS``) before a row group is read; more are not passed on to it.
    """
    unique = list(dict.fromkeys(ids))
    stored = warehouse.read(table)
    lots = [stored.filter(F.col(column).isin(*unique[i : i + 10])) for i in range(0, len(unique), 10)]
    out = lots[0] if lots else stored.limit(0)
    for lot in lots[1:]:
        out = out.unionByName(lot)
    return out


def lines_of(orders: DataFrame, items: DataFrame) -> DataFrame:
    """All lines of many orders, by the composite key (and month, so that the
    orders' months prune the line partitions)."""
    keys = ["order_id", "order_date"]
    if "month" in orders.columns and "month" in items.columns:
        keys.append("month")
    return items.join(orders.select(*keys), keys, "left_semi").orderBy("order_id", "order_item_id")


def nested_product_sales(sales: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Sales rows with the product, and its category inside, as structs."""
    category = categories.select("category_id", F.struct("category_id", "name").alias("category"))
    nested = products.join(category, "category_id", "left").select(
        "product_id",
        F.struct("product_id", "name", "sku", "price", "category").alias("product"),
    )
    measures = ["product_id", "units_sold", "net_revenue", "order_count"]
    return sales.select(*measures).join(nested, "product_id", "left")


def nested_order_page(
    page: DataFrame, items: DataFrame, products: DataFrame, customers: DataFrame
) -> DataFrame:
    """Orders with customer struct, one row per order and line; the line is a
    struct, null for an order without lines, so no row grows with an order."""
    buyer = customers.select(
        "customer_id",
        F.struct("customer_id", "email", "first_name", "last_name", "country").alias("customer"),
    )
    return order_lines_flat(page.join(buyer, "customer_id", "left"), items, products)


def order_lines_flat(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """The same nesting for any number of orders: one row per order and line,
    with the line as a struct that is null for an order without lines."""
    keys = ["order_id", "order_date"]
    line = items.join(products.select("product_id", "name"), "product_id", "left").select(
        *keys,
        F.struct(
            "order_item_id",
            "product_id",
            F.col("name").alias("product_name"),
            "quantity",
            "unit_price",
            "discount",
            "line_revenue",
        ).alias("item"),
    )
    # An inner join can be split on both sides when one order is hot; a left
    # join from orders could not split the lines.
    with_lines = orders.join(line, keys)
    without = orders.join(items.select(*keys).distinct(), keys, "left_anti").withColumn(
        "item", F.lit(None).cast(line.schema["item"].dataType)
    )
    return with_lines.unionByName(without)
