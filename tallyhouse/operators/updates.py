"""Partial product updates as a batch: a change set in, outcomes and products out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# The fields a change set may carry, and the outcome messages.
UPDATABLE = (
    "name",
    "description",
    "price",
    "cost",
    "category_id",
    "sku",
    "inventory_count",
    "weight",
    "is_active",
)
UPDATED = "Product updated."
NO_FIELDS = "No updatable fields supplied."
DUPLICATE_SKU = "Update rejected: that SKU is already in use."
MISSING_CATEGORY = "Update rejected: the referenced category does not exist."
CHECKS = (
    ("cost", "chk_products_cost_non_negative"),
    ("inventory_count", "chk_products_inventory_non_negative"),
    ("price", "chk_products_price_non_negative"),
    ("weight", "chk_products_weight_non_negative"),
)


CHANGE_NO = "change_no"


def numbered(changes: DataFrame) -> DataFrame:
    """Change set with every updatable column (an absent one means untouched) and
    the order of its rows: its own ``change_no``, or the order they are stated in."""
    order = F.col(CHANGE_NO) if CHANGE_NO in changes.columns else F.monotonically_increasing_id()
    return changes.select(
        "product_id",
        order.cast("bigint").alias(CHANGE_NO),
        *[F.col(c) if c in changes.columns else F.lit(None).alias(c) for c in UPDATABLE],
    )


def _folded(changes: DataFrame) -> DataFrame:
    """One row per product; of several rows the later one that sets a field wins."""
    latest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(CHANGE_NO))).alias(c) for c in UPDATABLE]
    return changes.groupBy("product_id").agg(*latest)


def _taken_skus(valid: DataFrame, products: DataFrame) -> DataFrame:
    """Products asking for a SKU that another product has, or that a lower id
    asks for; rows that fail another rule claim nothing."""
    asked = _folded(valid).filter(F.col("sku").isNotNull()).select("product_id", "sku")
    stored = products.select(F.col("product_id").alias("owner"), "sku")
    lowest = asked.groupBy("sku").agg(F.min("product_id").alias("owner"))
    return (
        asked.join(stored.unionByName(lowest.select("owner", "sku")), "sku")
        .filter(F.col("owner") != F.col("product_id"))
        .select("product_id")
        .distinct()
        .withColumn("_taken", F.lit(True))
    )


def _judged(changes: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """The numbered change rows with the message of their failure, null if they hold."""
    changes = numbered(changes)
    known = products.select("product_id", F.lit(True).alias("_known"))
    parents = categories.select("category_id", F.lit(True).alias("_category"))
    no_fields = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in UPDATABLE])
    rules: list[tuple[Column, Column]] = [
        (no_fields, F.lit(NO_FIELDS)),
        (
            F.col("_known").isNull(),
            F.concat(F.lit("No product with id "), F.col("product_id").cast("string"), F.lit(".")),
        ),
        *[(F.col(c) < 0, F.lit(f"Update rejected: {name}.")) for c, name in CHECKS],
    ]
    no_category = F.when(F.col("category_id").isNotNull() & F.col("_category").isNull(), F.lit(MISSING_CATEGORY))
    checked = (
        changes.join(known, "product_id", "left")
        .join(parents, "category_id", "left")
        .withColumn("_failure", F.coalesce(*[F.when(failed, message) for failed, message in rules]))
        .withColumn("_no_category", no_category)
        .drop("_known", "_category")
    )
    valid = checked.filter("_failure IS NULL AND _no_category IS NULL")
    taken = F.when(F.col("_taken") & F.col("sku").isNotNull(), F.lit(DUPLICATE_SKU))
    return checked.join(_taken_skus(valid, products), "product_id", "left").select(
        *changes.columns, F.coalesce("_failure", taken, "_no_category").alias("failure")
    )


def outcomes(changes: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """(product_id, success, message) per change row; never echoes row values."""
    return _judged(changes, products, categories).select(
        "product_id",
        F.col("failure").isNull().alias("success"),
        F.coalesce("failure", F.lit(UPDATED)).alias("message"),
    )


def apply_updates(changes: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """The updated products only, each once; fields left null keep their value."""
    wanted = _folded(_judged(changes, products, categories).filter("failure IS NULL"))
    new = wanted.select("product_id", *[F.col(c).alias(f"_new_{c}") for c in UPDATABLE])
    return products.join(new, "product_id").select(
        *[
            F.coalesce(F.col(f"_new_{c}"), F.col(c)).cast(products.schema[c].dataType).alias(c)
            if c in UPDATABLE
            else F.col(c)
            for c in products.columns
        ]
    )
