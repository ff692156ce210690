"""Stored tables: Parquet partitioned by month (facts) or key shard (dimensions).

Parquet has no row updates, so a write replaces the partitions it touches and
no others (dynamic partition overwrite): Spark writes new files beside the old
ones and swaps partitions when the job commits. A lost executor re-runs tasks
against the old files, and every load is an idempotent upsert, so a run that
died half way is simply repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from tallyhouse import model
from tallyhouse.model import Entity
from tallyhouse.operators.digests import DIGEST
from tallyhouse.session import use_utc

LAYOUT = "_layout"
NEXT = "__next"
DEFAULT_SHARDS = 8
STALE, ALL = "_stale", "all"
STATISTICS = (
    "column_name string, rows bigint, nulls bigint, low double, high double, low_text string, high_text string, "
    "distinct_sketch binary, quantile_sketch binary, signature string, part string"
)
# Month tables whose digests are kept beside them.
DIGESTED = ("orders", "order_items", "daily_sales")
# Columns asked for by value that do not tell the partition: kept in Bloom filters.
BLOOM_COLUMNS = {
    "orders": ("order_id", "customer_id"),
    "order_items": ("order_id",),
    "products": ("sku",),
    "customers": ("email",),
}

DERIVED = {
    "daily_sales": (
        "sale_date date, date_key int, product_id bigint, category_id bigint, "
        "units_sold bigint, gross_revenue decimal(14,2), discount_total decimal(14,2), "
        "net_revenue decimal(14,2), order_count int, avg_unit_price decimal(10,2), "
        "refreshed_at timestamp, month string"
    ),
    "customer_metrics": (
        "customer_id bigint, total_orders int, lifetime_value decimal(14,2), "
        "avg_order_value decimal(12,2), first_order_date timestamp, last_order_date timestamp, "
        "avg_days_between_orders decimal(10,2), refreshed_at timestamp, shard int"
    ),
    "product_sales_summary": (
        "product_id bigint, product_name string, sku string, category_id bigint, "
        "category_name string, root_category_id bigint, root_category_name string, "
        "total_units_sold bigint, total_revenue decimal(18,2), total_discount decimal(18,2), "
        "order_count bigint, first_sale_date date, last_sale_date date"
    ),
    "product_months": (
        "product_id bigint, days bigint, units bigint, revenue_cents bigint, discount_cents bigint, "
        "orders bigint, first_sale_date date, last_sale_date date, month string"
    ),
    "product_months_inputs": "inputs string, month string",
    "product_totals": (
        "product_id bigint, days bigint, units bigint, revenue_cents bigint, discount_cents bigint, "
        "orders bigint, first_sale_date date, last_sale_date date"
    ),
    "customer_months": (
        "customer_id bigint, orders bigint, value_cents bigint, first_order_date timestamp, "
        "last_order_date timestamp, month string"
    ),
    "customer_months_inputs": "inputs string, month string",
    "customer_totals": (
        "customer_id bigint, orders bigint, value_cents bigint, first_order_date timestamp, "
        "last_order_date timestamp"
    ),
    "rollup_sources": "inputs string, month string",
    # Named apart from the bitmaps of 32,768 ids stored earlier, which are not read again.
    "product_bits": (
        "sale_date date, category_id bigint, block bigint, units bigint, revenue_cents bigint, "
        "gross_cents bigint, discount_cents bigint, orders bigint, products bigint, month string"
    ),
    "product_bits_inputs": "inputs string, month string",
    "order_ranges": (
        "directory string, version string, page_range int, rows bigint, first_row bigint, total bigint"
    ),
    "check_ledger": "check_name string, violations bigint, inputs string, month string",
    "declared_months": "table_name string, month_start date",
    "run_events": f"attempt string, {model.RUN_EVENTS_SCHEMA}",
    "watermarks": model.WATERMARK_SCHEMA,
    "check_results": f"attempt string, {model.CHECK_SCHEMA}",
    **{f"{table}_digests": DIGEST for table in DIGESTED},
    **{f"{entity.name}_statistics": STATISTICS for entity in model.ENTITIES},
}


def entity_schema(entity: Entity) -> str:
    columns = [f"{f.name} {f.type}" for f in entity.fields]
    if entity is model.ORDER_ITEMS:
        columns.append("line_revenue decimal(12,2)")
    columns.append("created_at timestamp")
    if entity.tracks_updates:
        columns.append("updated_at timestamp")
    columns.append("month string" if entity.month_of else "shard int")
    return ", ".join(columns)


class Warehouse:
    """Tables below one root folder that every executor can reach.

    ``shards`` is the number of key shards of a dimension, near its size divided
    by a file size. It is stored beside the tables when the warehouse is made,
    since it decides where a key lives; opening it with another number is an
    error, without one the stored number holds.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        shards: int | None = None,
        first_month: str = model.FIRST_MONTH,
        last_month: str = model.LAST_MONTH,
    ):
        use_utc(spark)
        self.spark, self.root = spark, root.rstrip("/")
        self.shards = self._kept_shards(shards)
        self.first_month, self.last_month = first_month, last_month

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _folder(self, path: str):
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm_path

    def _kept_shards(self, asked: int | None) -> int:
        """The stored number of shards; a new warehouse stores the one asked for."""
        layout = f"{self.root}/{LAYOUT}"
        fs, path = self._folder(layout)
        if not fs.exists(path):
            kept = DEFAULT_SHARDS if asked is None else asked
            self.spark.createDataFrame([(kept,)], "shards int").coalesce(1).write.json(layout)
            return kept
        kept = self.spark.read.schema("shards int").json(layout).first().shards
        if asked is not None and asked != kept:
            raise ValueError(f"{self.root} has {kept} shards, not {asked}")
        return kept

    def exists(self, table: str) -> bool:
        """Whether the table is there; a replacement that was cut short is finished first."""
        fs, path = self._folder(self.path(table))
        if fs.exists(path):
            return True
        _, beside = self._folder(f"{self.path(table)}{NEXT}")
        _, whole = self._folder(f"{self.path(table)}{NEXT}/_SUCCESS")
        return fs.exists(whole) and fs.rename(beside, path)

    def schema(self, table: str) -> StructType:
        ddl = DERIVED.get(table) or entity_schema(model.BY_NAME[table])
        return StructType.fromDDL(ddl)

    def read(self, table: str) -> DataFrame:
        schema = self.schema(table)
        if not self.exists(table):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(table))

    def partition_of(self, entity: Entity) -> Column:
        """Partition value of a row: its month, or a hash shard of its key."""
        if entity.month_of:
            return F.date_format(entity.month_of, "yyyy-MM")
        return self.shard(entity.key[0])

    def shard(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.shards)).cast("int")

    def replace_partitions(
        self,
        table: str,
        df: DataFrame,
        column: str,
        counts: dict[str, Column] | None = None,
        cluster_by: tuple[str, ...] = (),
        touched: Sequence[str] | None = None,
    ) -> dict[str, int]:
        """Replace the partitions present in ``df``, counting rows on the way.

        ``touched`` names a superset of these partitions, if the caller knows them:
        only their digests are dropped, else those of the whole table.

        The rebalance hint gives each partition enough tasks for its size: AQE
        splits a month that holds a third of the data and joins small ones, so
        neither one huge task nor a flood of small files results. ``df`` may
        read the table itself. The counts are observed in the writing stage,
        above every shuffle, where a task counts once however often it is tried.
        """
        self.forget_digests(table, touched)
        out = df.hint("rebalance", F.col(column))
        if cluster_by:
            out = out.sortWithinPartitions(column, *cluster_by)
        seen = Observation()
        if counts:
            out = out.observe(seen, *[c.alias(name) for name, c in counts.items()])
        bloom = {f"parquet.bloom.filter.enabled#{c}": "true" for c in BLOOM_COLUMNS.get(table, ())}
        (
            out.select(*[f.name for f in self.schema(table).fields])
            .write.mode("overwrite")
            .options(**bloom, **{"parquet.bloom.filter.adaptive.enabled": "true"} if bloom else {})
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy(column)
            .parquet(self.path(table))
        )
        return seen.get if counts else {}

    def replace(self, table: str, df: DataFrame) -> None:
        """Replace a table: write the new one beside it, then switch folders.

        A driver lost in between leaves either table whole (see ``exists``), and
        ``df`` may read the table itself.
        """
        self.exists(table)
        beside = f"{self.path(table)}{NEXT}"
        df.write.mode("overwrite").parquet(beside)
        fs, path = self._folder(self.path(table))
        fs.delete(path, True)
        fs.rename(self._folder(beside)[1], path)

    def drop_table(self, table: str) -> None:
        """Remove a table, and a replacement of it that was cut short."""
        for name in (f"{table}{NEXT}", table):
            fs, path = self._folder(self.path(name))
            fs.delete(path, True)

    def append(self, table: str, df: DataFrame) -> None:
        """Add rows to a control table."""
        columns = [f.name for f in self.schema(table).fields]
        df.select(*columns).write.mode("append").parquet(self.path(table))

    def partitions(self, table: str, column: str) -> list[str]:
        """Partition values in use, from the folder names."""
        if not self.exists(table):
            return []
        fs, path = self._folder(self.path(table))
        prefix = f"{column}="
        names = [status.getPath().getName() for status in fs.listStatus(path)]
        return sorted(n[len(prefix) :] for n in names if n.startswith(prefix))

    def signatures(self, table: str, column: str) -> dict[str, str]:
        """Per partition value a hash of its files' names and lengths, by listing folders only."""
        found = {}
        for value in self.partitions(table, column):
            fs, path = self._folder(f"{self.path(table)}/{column}={value}")
            files = sorted(f"{s.getPath().getName()} {s.getLen()}" for s in fs.listStatus(path))
            found[value] = hashlib.sha256("\n".join(files).encode()).hexdigest()
        return found

    def forget_digests(self, table: str, months: Sequence[str] | None) -> None:
        """Before months of a table change: mark their digests as out of date (None: all).

        A mark is an empty file, so forgetting costs no job, and a writer that dies
        leaves it behind; it goes when the digest was made anew.
        """
        if table in DIGESTED:
            for month in [ALL] if months is None else months:
                fs, path = self._folder(f"{self.root}/{STALE}/{table}/{month}")
                fs.create(path, True).close()

    def forgotten(self, table: str) -> set[str]:
        fs, path = self._folder(f"{self.root}/{STALE}/{table}")
        return {s.getPath().getName() for s in fs.listStatus(path)} if fs.exists(path) else set()

    def remember(self, table: str, months: Iterable[str]) -> None:
        for month in months:
            fs, path = self._folder(f"{self.root}/{STALE}/{table}/{month}")
            fs.delete(path, False)

    def replace_months(self, table: str, df: DataFrame, months: Sequence[str]) -> None:
        """A small table with a few rows per month: those of the given months become ``df``."""
        columns = [f.name for f in self.schema(table).fields]
        rest = self.read(table).filter(~F.col("month").isin(*months))
        self.replace(table, rest.unionByName(df.select(*columns)).coalesce(1))

    def drop_partitions(self, table: str, column: str, values: Iterable[str]) -> None:
        """Remove whole partitions: emptied months and retention."""
        values = list(values)
        self.forget_digests(table, values)
        for value in values:
            fs, path = self._folder(f"{self.path(table)}/{column}={value}")
            fs.delete(path, True)

    def analyze(self, tables: Iterable[str]) -> None:
        """Column statistics for tables registered in the session catalog."""
        for table in tables:
            if self.spark.catalog.tableExists(table):
                self.spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")

    def register(self, table: str) -> None:
        """Name the folder in the session catalog, with its partitions."""
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        schema = self.schema(table)
        partition = [c for c in ("month", "shard") if c in schema.fieldNames()]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = f"PARTITIONED BY ({partition[0]})" if partition else ""
        self.spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet {by} LOCATION '{self.path(table)}'"
        )
        if partition:
            self.spark.sql(f"MSCK REPAIR TABLE {table}")
