"""Category closure and subtree filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.session import BROADCAST_ROW_LIMIT, broadcast_if_small, cut_lineage


def category_closure(categories: DataFrame) -> DataFrame:
    """Each category reachable from a root, with its root, depth and path.

    Paths double: each row knows the stretch of its path from below some ancestor
    ``above`` down to itself, and a round puts that ancestor's stretch before it.
    So a tree of depth d takes about log2(d) joins, each checkpointed, and there is
    no cap on depth or row count. While rows below a root are unfinished, a round
    finishes some of them; once it finishes none, the rest hangs on a cycle and is
    left out, as is what hangs below an absent parent. The result carries a
    broadcast hint only if the counted rows allow it.
    """
    stretches = cut_lineage(
        categories.select(
            "category_id",
            "name",
            "parent_id",
            F.col("parent_id").alias("above"),
            F.array("category_id").alias("path"),
            F.col("name").alias("top_name"),
        )
    )
    ended, pending = F.col("above").isNull(), F.col("above").isNotNull()
    done, rest = stretches.filter(ended), stretches.filter(pending)
    rows, before, unfinished = stretches.count(), -1, rest.count()
    while unfinished and unfinished != before:
        upper = done.unionByName(rest).select(
            F.col("category_id").alias("above"),
            F.col("above").alias("next_above"),
            F.col("path").alias("upper_path"),
            F.col("top_name").alias("upper_top_name"),
        )
        longer = cut_lineage(
            rest.join(broadcast_if_small(upper, rows), "above").select(
                "category_id",
                "name",
                "parent_id",
                F.col("next_above").alias("above"),
                F.concat("upper_path", "path").alias("path"),
                F.col("upper_top_name").alias("top_name"),
            )
        )
        done, rest = done.unionByName(longer.filter(ended)), longer.filter(pending)
        before, unfinished = unfinished, rest.count()
    closure = done.select(
        "category_id",
        "name",
        "parent_id",
        F.get("path", F.lit(0)).alias("root_category_id"),
        F.col("top_name").alias("root_category_name"),
        F.size("path").alias("depth"),
        "path",
    )
    return F.broadcast(closure) if rows <= BROADCAST_ROW_LIMIT else closure


def subtree(closure: DataFrame, category_id: Column | int) -> DataFrame:
    """The category itself, or every category below a root.

    A mid-level category matches only itself: the test is on the root id.
    """
    wanted = category_id if isinstance(category_id, Column) else F.lit(category_id)
    return closure.filter(
        (F.col("category_id") == wanted) | (F.col("root_category_id") == wanted)
    ).select("category_id")


def in_subtree(df: DataFrame, closure: DataFrame, category_id: Column | int) -> DataFrame:
    return df.join(broadcast_if_small(subtree(closure, category_id)), "category_id", "left_semi")
