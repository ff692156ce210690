"""Personal data: patterns propose, checks confirm, context words score.

Everything is an expression over the row: no shuffle, no Python. For each kind
the text is split at the pattern; the lengths of the parts between matches and
of the matches give the places in code points. Patterns are written so that a
long run of letters or digits is looked at once, and match what the plain
patterns of the kinds match, leftmost and without overlap within a kind.

Null texts count as empty, empty ones have no spans, repeated rows give repeated
results, and other columns are passed over or, in ``redact``, kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
CONTEXT_CHARS = 40


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str  # a cheap necessary condition
    score: float
    context: str  # words that raise the score when they stand before the span


KINDS = (
    Kind(
        "email",
        rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++",
        "@",
        0.8,
        "mail|contact|write|kontakt|correo|courriel",
    ),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "[0-9]\\.[0-9]", 0.6, "ip|host|server|address|adresse"),
    Kind(
        "card",
        r"(?=(?:[0-9][\x20-]?){13}[0-9])[0-9]++(?:[\x20-][0-9]++)*+",
        "[0-9][\\x20-]?[0-9][\\x20-]?[0-9]",
        0.8,
        "card|visa|mastercard|credit|karte|tarjeta|carte",
    ),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "\\+[0-9]", 0.7, "phone|call|tel|mobile|fax|telefon"),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
        "[A-Z]{2}[0-9]{2}",
        0.8,
        "iban|account|bank|konto|cuenta|compte",
    ),
)
BASE_KINDS = ("email", "ip", "card", "phone")
OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
SPAN = "struct<start:int,ord:int,end:int,kind:string,score:double>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _mod97(value: Column) -> Column:
    """Remainder of an IBAN read as a number: first four characters last, letters as 10 to 35."""
    plain = F.replace(value, F.lit(" "))
    moved = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    return F.aggregate(
        F.filter(F.split(moved, ""), lambda c: c != ""),
        F.lit(0).cast("int"),
        lambda acc, c: F.when(c.rlike("[0-9]"), acc * 10 + c.cast("int")).otherwise(acc * 100 + F.ascii(c) - 55) % 97,
    )


def _confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$")
    if kind == "card":
        digits = _digits(value)
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    if kind == "iban":
        return _mod97(value) == 1
    return F.lit(True)


def _spans(text: Column, order: int, kind: Kind) -> Column:
    """Confirmed spans of one kind in order of their start."""
    pattern = F.lit(kind.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    parts = F.zip_with(
        F.split(text, kind.pattern, -1),
        F.concat(matches, F.array(F.lit(None).cast("string"))),
        lambda gap, value: F.struct(
            F.length(gap).alias("gap"), F.right(gap, F.lit(CONTEXT_CHARS)).alias("before"), value.alias("value")
        ),
    )
    none = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<start:int,end:int,before:string,value:string>>").alias("out"))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + p["gap"]
        end = start + F.coalesce(F.length(p["value"]), F.lit(0))
        return F.struct(
            end.alias("at"),
            F.concat(
                acc["out"],
                F.array(F.struct(start.alias("start"), end.alias("end"), p["before"].alias("before"), p["value"].alias("value"))),
            ).alias("out"),
        )

    placed = F.aggregate(parts, none, step, lambda acc: acc["out"])
    kept = F.filter(placed, lambda s: s["value"].isNotNull() & _confirmed(kind.name, s["value"]))
    scored = F.transform(
        kept,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(order).alias("ord"),
            s["end"].alias("end"),
            F.lit(kind.name).alias("kind"),
            F.when(F.lower(s["before"]).rlike(kind.context), kind.score + 0.2).otherwise(kind.score).alias("score"),
        ),
    )
    empty = F.array().cast(f"array<{SPAN}>")
    needed = F.contains(text, F.lit(kind.needs)) if kind.needs == "@" else text.rlike(kind.needs)
    return F.when(needed, scored.cast(f"array<{SPAN}>")).otherwise(empty)


def find_spans(text_col: str) -> Column:
    """All confirmed spans, ordered by start and kind: start, end (exclusive), kind, score."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = [_spans(text, i, k) for i, k in enumerate(KINDS)]
    return F.array_sort(F.concat(*found))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, spans (with score), counts of the base kinds and their digest."""
    rows = docs.select(F.col(id_col).alias("doc_id"), find_spans(text_col).alias("found"))
    base = F.filter("found", lambda s: s["ord"] < len(BASE_KINDS))
    kinds = F.transform("found", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, F.lit(k).__eq__)).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"),
        "found",
    )


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with every span replaced by its kind in brackets; null stays null."""
    name = "__spans"
    while name in docs.columns:
        name += "_"
    text = F.col(text_col)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        free = s["start"] >= acc["at"]
        piece = F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(free, F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"),
        )

    replaced = F.aggregate(
        F.col(name), start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    )
    changed = F.when(F.size(name) > 0, replaced).otherwise(text)
    return (
        docs.withColumn(name, find_spans(text_col))
        .select(*[changed.alias(c) if c == text_col else F.col(c) for c in docs.columns])
    )
