"""Violation counts on whole tables: constraints, uniqueness, dataset contracts.

Every audit ends in partial aggregates, so the shuffle carries counters. Each
is a frame of (check, violations).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.functions import predicates as p
from tallyhouse.functions.money import cents

Tables = dict[str, DataFrame]


def counted(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One pass over ``df``: how many rows satisfy each (violation) test."""
    totals = df.agg(*[F.count_if(test).alias(name) for name, test in checks.items()])
    return to_rows(totals, list(checks))


def to_rows(totals: DataFrame, names: list[str]) -> DataFrame:
    """A one-row frame of counters turned into (check, violations) rows."""
    pairs = [
        F.struct(F.lit(n).alias("check"), F.col(n).cast("bigint").alias("violations"))
        for n in names
    ]
    return totals.select(F.inline(F.array(*pairs)))


def row_count(name: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(name).alias("check"), "violations"
    )


def stacked(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def duplicates(df: DataFrame, *key: Column | str) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def constraints(t: Tables) -> DataFrame:
    """Table constraints as violation counts."""
    gross = F.col("unit_price") * F.col("quantity")
    return stacked(
        [
            counted(
                t["products"],
                {
                    "products_price_non_negative": F.col("price") < 0,
                    "products_cost_non_negative": F.col("cost") < 0,
                    "products_inventory_non_negative": F.col("inventory_count") < 0,
                    "products_weight_non_negative": F.col("weight") < 0,
                },
            ),
            counted(
                t["customers"], {"customers_email_shape": ~F.col("email").like("%_@_%.__%")}
            ),
            counted(
                t["product_categories"],
                {"category_not_self_parent": F.col("parent_id") == F.col("category_id")},
            ),
            counted(
                t["orders"],
                {
                    "orders_total_non_negative": F.col("total_amount") < 0,
                    "orders_date_sequence": ~p.in_sequence(
                        F.col("order_date"),
                        F.col("processing_date"),
                        F.col("shipping_date"),
                        F.col("delivery_date"),
                    ),
                },
            ),
            counted(
                t["order_items"],
                {
                    "order_items_quantity_positive": F.col("quantity") <= 0,
                    "order_items_price_non_negative": F.col("unit_price") < 0,
                    "order_items_discount_valid": (F.col("discount") < 0)
                    | (F.col("discount") > gross),
                },
            ),
        ]
    )


def run_constraints(runs: DataFrame) -> DataFrame:
    """A run has a finish time exactly when it is no longer running."""
    running = F.col("status") == "running"
    return counted(runs, {"run_finished": running != F.col("finished_at").isNull()})


def uniqueness(t: Tables) -> DataFrame:
    """Number of duplicated keys per natural or primary key."""
    keys = [
        ("product_categories", ["category_id"]),
        ("products", ["product_id"]),
        ("products", ["sku"]),
        ("customers", ["customer_id"]),
        ("customers", ["email"]),
        ("orders", ["order_id", "order_date"]),
        ("order_items", ["order_item_id", "order_date"]),
    ]
    return stacked(
        [row_count(f"{table}.{'+'.join(key)}", duplicates(t[table], *key)) for table, key in keys]
    )


def lines_per_order(items: DataFrame) -> DataFrame:
    """Lines reduced to one row per order, map-side first."""
    return items.groupBy("order_id", "order_date").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(cents(F.col("line_revenue"))).alias("line_cents"),
        F.count_if(F.col("line_revenue") < 0).alias("negative_lines"),
    )


def reconciled(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders beside their line totals, keeping both orphans.

    One full join of two frames that are unique on the order key answers:
    lines without order, orders without lines, totals that disagree, negative
    lines and lines per order.
    """
    heads = orders.select(
        "order_id",
        "order_date",
        p.revenue_bearing(F.col("status")).alias("bears_revenue"),
        cents(F.col("total_amount")).alias("total_cents"),
        F.lit(True).alias("_order"),
    )
    return heads.join(lines_per_order(items), ["order_id", "order_date"], "full")


def mismatch(tolerance_cents: str) -> Column:
    off = F.abs(F.col("total_cents") - F.col("line_cents")).cast("decimal(20,1)")
    return off > F.lit(tolerance_cents).cast("decimal(20,1)")


def unresolved(
    name: str, child: DataFrame, columns: list[str], parent: DataFrame, parent_columns: list[str]
) -> DataFrame:
    """Child rows without parent. Children are counted per key first, so a key
    with a third of all rows is one row in the join."""
    keys = parent.select(*[F.col(b).alias(a) for a, b in zip(columns, parent_columns)])
    per_key = child.dropna(subset=columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    missing = per_key.join(keys, columns, "left_anti")
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
        F.lit(name).alias("check"), "violations"
    )


def contracts(t: Tables, rollup: DataFrame, metrics: DataFrame, closure: DataFrame, first: str, last: str) -> DataFrame:
    """Dataset contracts: references, tree depth, keys, dates, money, totals.

    ``first``/``last`` bound the declared order days. Reconciliations report
    the difference in cents; ``mean_lines_out_of_band`` is 0 or 1.
    """
    items, orders = t["order_items"], t["orders"]
    gross = F.col("unit_price") * F.col("quantity")
    day = F.to_date("order_date")
    early = (
        orders.select("customer_id", "order_date")
        .join(t["customers"].select("customer_id", "registration_date"), "customer_id")
        .filter(F.col("order_date") < F.col("registration_date"))
    )
    beside = reconciled(orders, items)
    orphans = beside.filter(F.col("_order").isNull()).select("order_id", "lines")
    wrong_date = orphans.join(orders.select("order_id").distinct(), "order_id", "left_semi").agg(
        F.coalesce(F.sum("lines"), F.lit(0)).alias("item_date_differs")
    )
    recon = beside.agg(
        F.coalesce(F.sum(F.when(F.col("_order").isNull(), F.col("lines"))), F.lit(0)).alias(
            "item_order_missing"
        ),
        F.count_if(mismatch("1.1")).alias("order_total_mismatch"),
        F.count_if(F.col("lines").isNull()).alias("order_without_lines"),
        (
            ~F.try_divide(
                F.sum("lines").cast("double"), F.count("lines").cast("double")
            ).between(3.5, 4.7)
        )
        .cast("bigint")
        .alias("mean_lines_out_of_band"),
        F.coalesce(F.sum(F.when(F.col("bears_revenue"), F.col("line_cents"))), F.lit(0)).alias(
            "sold_cents"
        ),
    )
    paying = orders.filter(p.revenue_bearing(F.col("status")))
    month = F.date_trunc("month", "sale_date")
    by_month = rollup.groupBy(month.alias("m")).agg(F.sum(cents(F.col("net_revenue"))).alias("c"))

    def total(df: DataFrame, column: str) -> Column:
        return df.agg(F.coalesce(F.sum(cents(F.col(column))), F.lit(0)).alias("c")).scalar()

    recon = recon.withColumn("rollup_vs_lines", F.abs(total(rollup, "net_revenue") - F.col("sold_cents")))
    one = t["products"].sparkSession.range(1)
    differences = one.select(
        F.abs(total(metrics, "lifetime_value") - total(paying, "total_amount")).alias(
            "lifetime_value_vs_orders"
        ),
        F.abs(
            total(rollup, "net_revenue") - by_month.agg(F.coalesce(F.sum("c"), F.lit(0))).scalar()
        ).alias("month_totals_vs_days"),
    )
    return stacked(
        [
            unresolved(
                "category_parent_missing",
                t["product_categories"],
                ["parent_id"],
                t["product_categories"],
                ["category_id"],
            ),
            unresolved(
                "product_category_missing",
                t["products"],
                ["category_id"],
                t["product_categories"],
                ["category_id"],
            ),
            unresolved(
                "order_customer_missing", orders, ["customer_id"], t["customers"], ["customer_id"]
            ),
            unresolved(
                "item_product_missing", items, ["product_id"], t["products"], ["product_id"]
            ),
            row_count("category_too_deep", closure.filter("depth > 2")),
            uniqueness(t).withColumn("check", F.concat(F.lit("duplicate "), "check")),
            to_rows(wrong_date, ["item_date_differs"]),
            row_count("order_before_registration", early),
            counted(
                items,
                {
                    "item_quantity": F.col("quantity") <= 0,
                    "item_discount": (F.col("discount") < 0) | (F.col("discount") > gross),
                    "item_money": (F.col("unit_price") < 0) | (F.col("line_revenue") < 0),
                    "line_total_mismatch": F.abs(
                        gross - F.col("discount") - F.col("line_revenue")
                    )
                    > F.lit("0.011").cast("decimal(4,3)"),
                },
            ),
            counted(
                orders,
                {
                    "order_money": F.col("total_amount") < 0,
                    "order_dates_not_monotone": ~p.in_sequence(
                        F.col("order_date"),
                        F.col("processing_date"),
                        F.col("shipping_date"),
                        F.col("delivery_date"),
                    ),
                    "order_status_unknown": ~F.col("status").isin(*p.ORDER_STATUSES),
                    "order_date_out_of_range": (day < F.lit(first).cast("date"))
                    | (day > F.lit(last).cast("date")),
                },
            ),
            to_rows(
                recon,
                [
                    "item_order_missing",
                    "order_total_mismatch",
                    "order_without_lines",
                    "mean_lines_out_of_band",
                    "rollup_vs_lines",
                ],
            ),
            to_rows(differences, ["lifetime_value_vs_orders", "month_totals_vs_days"]),
        ]
    )
