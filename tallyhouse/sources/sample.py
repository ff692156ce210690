"""The supplied order-entry tables mapped onto the retail entities.

Ids start at 0 in the supplied tables and must be positive here, so 1 is
added. Category ids are the leading 60 bits of an MD5, which needs no global
numbering pass. Every function is a lazy DataFrame over whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyhouse.functions.predicates import revenue_bearing
from tallyhouse.model import Entity
from tallyhouse.session import use_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_id(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def child_category_id(kind: str = "p_type", brand: str = "p_brand") -> Column:
    return text_id(F.concat(F.col(kind), F.lit("/"), F.col(brand)))


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two levels: part types, and brands within a type."""
    pairs = table(spark, sf_dir, "part").select("p_type", "p_brand").distinct()
    empty = F.lit(None).cast("string")
    roots = (
        pairs.select("p_type")
        .distinct()
        .select(
            text_id(F.col("p_type")).alias("category_id"),
            F.col("p_type").alias("name"),
            empty.alias("description"),
            F.lit(None).cast("bigint").alias("parent_id"),
        )
    )
    children = pairs.select(
        child_category_id().alias("category_id"),
        F.concat_ws(" - ", "p_type", "p_brand").alias("name"),
        F.col("p_brand").alias("description"),
        text_id(F.col("p_type")).alias("parent_id"),
    )
    return roots.unionByName(children)


def region_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A three-level tree: region, nation, market segment within a nation."""
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation")
    segments = (
        table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment").distinct()
    )
    region_id = text_id(F.concat(F.lit("region/"), F.col("r_regionkey").cast("string")))
    parent_region = text_id(F.concat(F.lit("region/"), F.col("n_regionkey").cast("string")))
    nation_id = text_id(F.concat(F.lit("nation/"), F.col("n_nationkey").cast("string")))
    parent_nation = text_id(F.concat(F.lit("nation/"), F.col("c_nationkey").cast("string")))
    segment_id = text_id(
        F.concat(F.lit("segment/"), F.col("c_nationkey").cast("string"), F.lit("/"), "c_mktsegment")
    )
    return (
        region.select(
            region_id.alias("category_id"),
            F.col("r_name").alias("name"),
            F.lit(None).cast("bigint").alias("parent_id"),
        )
        .unionByName(
            nation.select(
                nation_id.alias("category_id"),
                F.col("n_name").alias("name"),
                parent_region.alias("parent_id"),
            )
        )
        .unionByName(
            segments.select(
                segment_id.alias("category_id"),
                F.col("c_mktsegment").alias("name"),
                parent_nation.alias("parent_id"),
            )
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("p_retailprice").cast("decimal(10,2)")
    return table(spark, sf_dir, "part").select(
        (F.col("p_partkey") + 1).alias("product_id"),
        F.col("p_name").alias("name"),
        F.concat_ws(" ", "p_brand", "p_type").alias("description"),
        price.alias("price"),
        (price - F.lit(100).cast("decimal(5,2)")).cast("decimal(10,2)").alias("cost"),
        child_category_id().alias("category_id"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_size").cast("int").alias("inventory_count"),
        F.col("p_size").cast("decimal(8,2)").alias("weight"),
        (F.col("p_size") % 10 != 0).alias("is_active"),
        F.timestamp_add("DAY", F.col("p_size"), F.lit("1995-01-01").cast("timestamp")).alias(
            "created_at"
        ),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    empty = F.lit(None).cast("string")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name"
    )
    return (
        table(spark, sf_dir, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            (F.col("c_custkey") + 1).alias("customer_id"),
            F.concat(
                F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")
            ).alias("email"),
            F.lit("Customer").alias("first_name"),
            F.col("c_name").alias("last_name"),
            empty.alias("street_address"),
            F.col("c_mktsegment").alias("city"),
            F.col("r_name").alias("state"),
            empty.alias("zip_code"),
            F.col("n_name").alias("country"),
            empty.alias("phone"),
            F.timestamp_add(
                "DAY", F.col("c_nationkey"), F.lit("1995-01-01").cast("timestamp")
            ).alias("registration_date"),
            F.lit(None).cast("timestamp").alias("last_login"),
        )
    )


def order_status() -> Column:
    state, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return (
        F.when(state == "O", "Shipped")
        .when(state == "P", "Processing")
        .when(priority == "5-LOW", "Cancelled")
        .when(priority == "4-NOT SPECIFIED", "Returned")
        .otherwise("Delivered")
    )


def payment_method() -> Column:
    priority = F.substring("o_orderpriority", 1, 1)
    return (
        F.when(priority == "1", "Credit Card")
        .when(priority == "2", "PayPal")
        .when(priority == "3", "Apple Pay")
        .when(priority == "4", "Google Pay")
        .otherwise("Gift Card")
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = F.col("o_orderdate").cast("timestamp")
    status = order_status()

    def later(days: int, *statuses: str) -> Column:
        return F.when(status.isin(*statuses), F.timestamp_add("DAY", F.lit(days), placed))

    return table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") + 1).alias("order_id"),
        (F.col("o_custkey") + 1).alias("customer_id"),
        placed.alias("order_date"),
        status.alias("status"),
        payment_method().alias("payment_method"),
        F.concat(F.lit("Dock "), F.col("o_custkey").cast("string")).alias("shipping_address"),
        F.lit("Springfield").alias("shipping_city"),
        F.lit("IL").alias("shipping_state"),
        F.lit("62701").alias("shipping_zip"),
        F.lit("USA").alias("shipping_country"),
        later(1, "Shipped", "Delivered", "Returned", "Processing").alias("processing_date"),
        later(2, "Shipped", "Delivered", "Returned").alias("shipping_date"),
        later(5, "Delivered", "Returned").alias("delivery_date"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
    )


def line_columns() -> list[Column]:
    unit_price = F.col("l_extendedprice").cast("decimal(10,2)")
    discount = F.round(unit_price * F.col("l_discount").cast("decimal(4,2)"), 2).cast(
        "decimal(10,2)"
    )
    quantity = F.col("l_quantity").cast("int")
    return [
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("order_item_id"),
        (F.col("l_orderkey") + 1).alias("order_id"),
        F.col("o_orderdate").cast("timestamp").alias("order_date"),
        (F.col("l_partkey") + 1).alias("product_id"),
        quantity.alias("quantity"),
        unit_price.alias("unit_price"),
        discount.alias("discount"),
        (unit_price * quantity - discount).cast("decimal(12,2)").alias("line_revenue"),
    ]


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines carry their order's date, as the second half of the composite key."""
    dates = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return (
        table(spark, sf_dir, "lineitem")
        .join(dates, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(*line_columns())
    )


def sold_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of revenue-bearing orders with one join: the order's date and its
    status come from the same row, so a second join is not needed."""
    paying = (
        table(spark, sf_dir, "orders")
        .filter(revenue_bearing(order_status()))
        .select("o_orderkey", "o_orderdate")
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(paying, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(*line_columns())
    )


def source_text(entity: Entity, rows: DataFrame) -> DataFrame:
    """Typed entity rows as a source would state them: text, ISO timestamps."""

    def text(column: str, kind: str) -> Column:
        if kind == "timestamp":
            return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
        return F.col(column).cast("string")

    columns = [text(f.name, f.type).alias(f.header) for f in entity.fields]
    if "total" in entity.check_only:
        columns.append(F.col("line_revenue").cast("string").alias("total"))
    return rows.select(*columns)


def entity_rows(entity: Entity, spark: SparkSession, sf_dir: str) -> DataFrame:
    readers = {
        "product_categories": categories,
        "products": products,
        "customers": customers,
        "orders": orders,
        "order_items": order_items,
    }
    return readers[entity.name](spark, sf_dir)
