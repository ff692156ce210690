"""Row rules: text in, typed columns and the first broken rule out.

``classify`` is one projection over the source; Catalyst keeps it in a single
whole-stage-codegen span behind the scan, with no shuffle and no Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.functions import parsing, predicates as p
from tallyhouse.model import Entity, Field

REASON = "_reject_reason"
RAW = "_raw"
MISMATCH = "_total_mismatch"
POSITION = "_position"

# Source totals may differ from price x quantity - discount by rounding only.
TOTAL_TOLERANCE = "0.011"

# Integer columns whose source may carry decimals, rounded on storing.
ROUNDED = ("inventory_count",)

Values = dict[str, Column]
Rules = list[tuple[str, Column]]


def _fits_int(value: Column) -> Column:
    return value.try_cast("int").isNotNull()


def _category_rules(v: Values) -> Rules:
    return [
        ("category_id_invalid", p.positive(v["category_id"])),
        ("name_blank", p.not_blank(v["name"])),
        ("parent_id_invalid", p.null_or(v["parent_id"], p.positive(v["parent_id"]))),
        ("parent_is_self", p.null_or(v["parent_id"], v["parent_id"] != v["category_id"])),
    ]


def _product_rules(v: Values) -> Rules:
    return [
        ("product_id_invalid", p.positive(v["product_id"])),
        ("name_blank", p.not_blank(v["name"])),
        ("sku_blank", p.not_blank(v["sku"])),
        ("category_id_invalid", p.positive(v["category_id"])),
        ("price_invalid", p.not_negative(v["price"])),
        ("cost_invalid", p.null_or(v["cost"], v["cost"] >= 0)),
        ("inventory_invalid", (v["inventory_count"] >= 0) & _fits_int(v["inventory_count"])),
        ("weight_invalid", p.null_or(v["weight"], v["weight"] >= 0)),
    ]


def _customer_rules(v: Values) -> Rules:
    return [
        ("customer_id_invalid", p.positive(v["customer_id"])),
        ("email_invalid", v["email"].rlike(p.EMAIL_SHAPE)),
        ("first_name_blank", p.not_blank(v["first_name"])),
        ("last_name_blank", p.not_blank(v["last_name"])),
        ("registration_date_invalid", v["registration_date"].isNotNull()),
        (
            "last_login_before_registration",
            p.null_or(v["last_login"], v["last_login"] >= v["registration_date"]),
        ),
    ]


def _order_rules(v: Values) -> Rules:
    return [
        ("order_id_invalid", p.positive(v["order_id"])),
        ("customer_id_invalid", p.positive(v["customer_id"])),
        ("order_date_invalid", v["order_date"].isNotNull()),
        ("status_unknown", v["status"].isin(*p.ORDER_STATUSES)),
        ("payment_method_unknown", v["payment_method"].isin(*p.PAYMENT_METHODS)),
        ("total_amount_invalid", p.not_negative(v["total_amount"])),
        ("shipping_address_blank", p.not_blank(v["shipping_address"])),
        (
            "date_sequence_invalid",
            p.in_sequence(
                v["order_date"], v["processing_date"], v["shipping_date"], v["delivery_date"]
            ),
        ),
        # The stored columns are required, so blanks are caught here as well.
        ("shipping_city_blank", p.not_blank(v["shipping_city"])),
        ("shipping_state_blank", p.not_blank(v["shipping_state"])),
        ("shipping_zip_blank", p.not_blank(v["shipping_zip"])),
        ("shipping_country_blank", p.not_blank(v["shipping_country"])),
    ]


def _item_rules(v: Values) -> Rules:
    gross = (v["unit_price"].try_cast("decimal(10,2)") * v["quantity"].try_cast("int")).cast(
        "decimal(24,2)"
    )
    discount = v["discount"].try_cast("decimal(10,2)")
    return [
        ("order_item_id_invalid", p.positive(v["order_item_id"])),
        ("order_id_invalid", p.positive(v["order_id"])),
        ("product_id_invalid", p.positive(v["product_id"])),
        ("order_date_invalid", v["order_date"].isNotNull()),
        ("quantity_invalid", p.positive(v["quantity"]) & _fits_int(v["quantity"])),
        ("unit_price_invalid", p.not_negative(v["unit_price"])),
        ("discount_invalid", (discount >= 0) & (discount <= gross)),
    ]


RULES: dict[str, Callable[[Values], Rules]] = {
    "product_categories": _category_rules,
    "products": _product_rules,
    "customers": _customer_rules,
    "orders": _order_rules,
    "order_items": _item_rules,
}


def _parse(field: Field) -> Column:
    text = F.col(field.header)
    if field.type == "string":
        return parsing.trimmed(text)
    if field.type == "boolean":
        return parsing.boolean(text)
    if field.type == "timestamp":
        return parsing.timestamp(text)
    if field.type in ("bigint", "int") and field.name not in ROUNDED:
        return parsing.whole(text)
    return parsing.number(text)


def _stored(field: Field, value: Column) -> Column:
    """The value in its column type; null when it does not fit."""
    if field.type in ("string", "boolean", "timestamp"):
        return value
    if field.name in ROUNDED:
        value = F.bround(value, 0)
    return value.try_cast(field.type)


def _parsed(entity: Entity) -> Values:
    """Parsed value per field, with the defaults and the one case-folded column.

    As everywhere in the rules, text that is no number counts as missing.
    """
    values = {f.name: _parse(f) for f in entity.fields}
    zero = F.lit(0).cast(parsing.NUMBER)
    if entity.name == "products":
        values["is_active"] = F.coalesce(values["is_active"], F.lit(True))
        values["inventory_count"] = F.coalesce(values["inventory_count"], zero)
    elif entity.name == "customers":
        values["email"] = F.lower(values["email"])
    elif entity.name == "order_items":
        values["discount"] = F.coalesce(values["discount"], zero)
    return values


def _storage_rules(entity: Entity, values: Values) -> Rules:
    """What the stored columns can hold; checked after every row rule."""
    rules: Rules = []
    for field in entity.fields:
        value = values[field.name]
        if field.max_length:
            rules.append(
                (f"{field.name}_too_long", p.null_or(value, F.length(value) <= field.max_length))
            )
        elif field.type.startswith("decimal"):
            rules.append(
                (f"{field.name}_out_of_range", p.null_or(value, value.try_cast(field.type).isNotNull()))
            )
    return rules


def rules_for(entity: Entity, values: Values) -> Rules:
    if entity.name not in RULES:
        raise ValueError(f"no rules for entity {entity.name!r}")
    return RULES[entity.name](values) + _storage_rules(entity, values)


def total_mismatch(values: Values, total: Column) -> Column:
    """The source total disagrees with price x quantity - discount: a signal, not a rejection."""
    expected = values["unit_price"] * values["quantity"] - values["discount"]
    return F.coalesce(
        F.abs(expected - total) > F.lit(TOTAL_TOLERANCE).cast("decimal(4,3)"), F.lit(False)
    )


def classify(entity: Entity, raw: DataFrame) -> DataFrame:
    """Typed entity columns, the source row as text, and the first broken rule.

    A value that did not parse is null in the typed column; the text in
    ``_raw`` keeps what the source said, for inspection and replay.
    """
    source = [c for c in entity.source_columns if c in raw.columns]
    has_total = "total" in entity.check_only and "total" in raw.columns
    extra = [F.col(POSITION)] if POSITION in raw.columns else []

    # Parse once, behind a generator of one row per row: no filter on the reason is pushed
    # through it, so the rules never run on parsing expressions copied into a join or a scan.
    parsed = [value.alias(f"_v_{name}") for name, value in _parsed(entity).items()]
    if has_total:
        parsed.append(parsing.number(F.col("total")).alias("_v_total"))
    wide = raw.select(F.inline(F.array(F.struct(*parsed))), F.struct(*source).alias(RAW), *extra)

    values = {f.name: F.col(f"_v_{f.name}") for f in entity.fields}
    typed = [_stored(f, values[f.name]).alias(f.name) for f in entity.fields]
    reason = p.first_failure(rules_for(entity, values))
    if "total" in entity.check_only:
        flag = total_mismatch(values, F.col("_v_total")) if has_total else F.lit(False)
        extra.append(flag.alias(MISMATCH))
    return wide.select(*typed, RAW, reason.alias(REASON), *extra)


def accepted(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col(REASON).isNull())


def rejected(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col(REASON).isNotNull())


def reason_counts(classified: DataFrame) -> DataFrame:
    return (
        rejected(classified)
        .groupBy(F.col(REASON).alias("reason"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
