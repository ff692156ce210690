"""Edits of stored tables: product updates and cascading deletes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tallyhouse import model
from tallyhouse.operators import merge, updates
from tallyhouse.plans.load import upsert
from tallyhouse.session import cut_lineage
from tallyhouse.sources.warehouse import Warehouse


def update_products(warehouse: Warehouse, changes: DataFrame, now: datetime) -> DataFrame:
    """Apply a change set and return (product_id, success, message) per row.

    The change rows are numbered, and the outcomes fixed, before the table
    changes under them.
    """
    changes = cut_lineage(updates.numbered(changes))
    products = warehouse.read("products")
    categories = warehouse.read("product_categories")
    outcome = cut_lineage(updates.outcomes(changes, products, categories))
    changed = updates.apply_updates(changes, products, categories)
    upsert(warehouse, model.PRODUCTS, changed.select(*model.PRODUCTS.columns), now)
    return outcome


def delete_rows(
    warehouse: Warehouse, table: str, keys: DataFrame, on: Sequence[str], column: str
) -> None:
    """Delete by key: rewrite the partitions that hold such rows, drop emptied ones."""
    stored = warehouse.read(table)
    hit = stored.join(keys.select(*on), list(on), "left_semi").select(column).distinct()
    touched = {row[0] for row in hit.collect()}
    if not touched:
        return
    left = merge.delete_keys(stored.filter(F.col(column).isin(*touched)), keys, on)
    filled = {row[0] for row in left.select(column).distinct().collect()}
    warehouse.replace_partitions(table, left, column, touched=sorted(touched) if column == "month" else None)
    warehouse.drop_partitions(table, column, [str(value) for value in touched - filled])


def delete_orders(warehouse: Warehouse, keys: DataFrame) -> None:
    """Delete orders by (order_id, order_date), their lines first."""
    keys = cut_lineage(keys.select("order_id", "order_date"))
    for table in ("order_items", "orders"):
        delete_rows(warehouse, table, keys, ["order_id", "order_date"], "month")


def delete_customers(warehouse: Warehouse, keys: DataFrame) -> DataFrame:
    """Delete customers and their metrics; those with orders are kept and returned."""
    keys = keys.select("customer_id").distinct()
    in_use = cut_lineage(
        keys.join(warehouse.read("orders").select("customer_id"), "customer_id", "left_semi")
    )
    free = cut_lineage(keys.join(in_use, "customer_id", "left_anti"))
    for table in ("customer_metrics", "customers"):
        delete_rows(warehouse, table, free, ["customer_id"], "shard")
    return in_use


def delete_runs(warehouse: Warehouse, run_ids: Sequence[int]) -> None:
    """Delete runs from the control tables, their check results first."""
    for table in ("check_results", "run_events"):
        warehouse.drop_partitions(table, "run_id", [str(i) for i in run_ids])
