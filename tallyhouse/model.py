"""The five source entities: columns, keys, references and watermarks."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    max_length: int | None = None
    source: str | None = None  # header name where it differs

    @property
    def header(self) -> str:
        return self.source or self.name


@dataclass(frozen=True)
class Reference:
    """Foreign key: ``columns`` must exist as ``parent_columns`` of ``parent``."""

    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    nullable: bool = False

    @property
    def reason(self) -> str:
        return "missing_" + "_".join(self.columns)


@dataclass(frozen=True)
class Entity:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    references: tuple[Reference, ...] = ()
    watermark: str | None = None
    check_only: tuple[str, ...] = ()  # read from the source, not stored
    unique: tuple[str, ...] = ()  # natural keys besides the primary key
    month_of: str | None = None  # timestamp that decides the month partition
    tracks_updates: bool = True  # carries updated_at
    cluster_by: tuple[str, ...] = ()  # order within files, for min/max pruning

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def update_columns(self) -> list[str]:
        return [c for c in self.columns if c not in self.key]

    @property
    def source_columns(self) -> list[str]:
        return [f.header for f in self.fields] + list(self.check_only)

    @property
    def file_name(self) -> str:
        return f"{self.name}.csv"

    @property
    def partition_column(self) -> str:
        return "month" if self.month_of else "shard"


CATEGORIES = Entity(
    name="product_categories",
    fields=(
        Field("category_id", "bigint"),
        Field("name", "string", 100),
        Field("description", "string"),
        Field("parent_id", "bigint"),
    ),
    key=("category_id",),
    references=(Reference(("parent_id",), "product_categories", ("category_id",), nullable=True),),
)

PRODUCTS = Entity(
    name="products",
    fields=(
        Field("product_id", "bigint"),
        Field("name", "string", 255),
        Field("description", "string"),
        Field("price", "decimal(10,2)"),
        Field("cost", "decimal(10,2)"),
        Field("category_id", "bigint"),
        Field("sku", "string", 50),
        Field("inventory_count", "int"),
        Field("weight", "decimal(8,2)"),
        Field("is_active", "boolean"),
    ),
    key=("product_id",),
    references=(Reference(("category_id",), "product_categories", ("category_id",)),),
    unique=("sku",),
)

CUSTOMERS = Entity(
    name="customers",
    fields=(
        Field("customer_id", "bigint"),
        Field("email", "string", 255),
        Field("first_name", "string", 50),
        Field("last_name", "string", 50),
        Field("street_address", "string", 255),
        Field("city", "string", 100),
        Field("state", "string", 50),
        Field("zip_code", "string", 20),
        Field("country", "string", 50),
        Field("phone", "string", 50),
        Field("registration_date", "timestamp"),
        Field("last_login", "timestamp"),
    ),
    key=("customer_id",),
    watermark="registration_date",
    unique=("email",),
)

ORDERS = Entity(
    name="orders",
    fields=(
        Field("order_id", "bigint"),
        Field("customer_id", "bigint"),
        Field("order_date", "timestamp"),
        Field("status", "string"),
        Field("payment_method", "string"),
        Field("shipping_address", "string", 255),
        Field("shipping_city", "string", 100),
        Field("shipping_state", "string", 50),
        Field("shipping_zip", "string", 20),
        Field("shipping_country", "string", 50),
        Field("processing_date", "timestamp"),
        Field("shipping_date", "timestamp"),
        Field("delivery_date", "timestamp"),
        Field("total_amount", "decimal(12,2)"),
    ),
    key=("order_id", "order_date"),
    references=(Reference(("customer_id",), "customers", ("customer_id",)),),
    watermark="order_date",
    month_of="order_date",
    cluster_by=("customer_id",),
)

ORDER_ITEMS = Entity(
    name="order_items",
    fields=(
        Field("order_item_id", "bigint"),
        Field("order_id", "bigint"),
        Field("order_date", "timestamp"),
        Field("product_id", "bigint"),
        Field("quantity", "int"),
        Field("unit_price", "decimal(10,2)", source="price"),
        Field("discount", "decimal(10,2)"),
    ),
    key=("order_item_id", "order_date"),
    references=(
        Reference(("order_id", "order_date"), "orders", ("order_id", "order_date")),
        Reference(("product_id",), "products", ("product_id",)),
    ),
    watermark="order_date",
    check_only=("total",),
    month_of="order_date",
    tracks_updates=False,
    cluster_by=("order_id",),
)

# Parents before children.
ENTITIES = (CATEGORIES, PRODUCTS, CUSTOMERS, ORDERS, ORDER_ITEMS)
BY_NAME = {entity.name: entity for entity in ENTITIES}

# Declared calendar range of the month partitions (inclusive month starts).
FIRST_MONTH = "2019-01-01"
LAST_MONTH = "2030-12-01"

RUN_EVENTS_SCHEMA = (
    "run_id bigint, workflow string, source string, status string, at timestamp, "
    "rows_extracted bigint, rows_loaded bigint, rows_rejected bigint, error_message string"
)
WATERMARK_SCHEMA = "entity string, watermark_ts timestamp, run_id bigint, updated_at timestamp"
CHECK_SCHEMA = (
    "run_id bigint, check_name string, severity string, passed boolean, "
    "observed double, threshold double, details string, checked_at timestamp"
)
