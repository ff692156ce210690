"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.llm import (
    base,
    decontaminate,
    extract,
    fingerprints,
    hard_negatives,
    licenses,
    near_duplicates,
    pieces,
    pii,
    quality,
    quality_rules,
    sharding,
    token_counts,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(base.table(spark, sf_dir, "documents"))
    over = (F.col("n_tokens") > token_counts.LIMIT).alias("over_limit")
    return counts.select("doc_id", "n_bytes", "n_tokens", over, "prefix_chars")


@_query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_scan(base.table(spark, sf_dir, "documents"))
    spans = F.transform(
        "matches", lambda m: F.concat_ws(":", m["label"], m["first_word"], m["end_word"], m["edits"])
    )
    return found.withColumn("matches", F.array_join(spans, ","))


@_query
def op5_extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = extract.extract_text(base.table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@_query
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.document_fingerprints(base.table(spark, sf_dir, "documents"))


@_query
def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shuffled(base.table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        F.col("shard_size").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard_no").alias("shard"),
        F.col("shard_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(
        base.table(spark, sf_dir, "documents"), base.table(spark, sf_dir, "benchmark")
    )


_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
).format(decontaminate.UPPER, decontaminate.LOWER)

ORACLES["op3_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
iw AS (SELECT item_id, least(10, len(w)) AS l, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM i),
lengths AS (SELECT DISTINCT l FROM iw),
item_windows AS (
  SELECT DISTINCT item_id, l, g FROM (
    SELECT item_id, l, n, p, string_agg(word, ' ') OVER (
      PARTITION BY item_id ORDER BY p ROWS BETWEEN CURRENT ROW AND l - 1 FOLLOWING) AS g FROM iw)
  WHERE p <= n - l + 1),
doc_windows AS (
  SELECT doc_id, l, p, string_agg(word, ' ') OVER (
    PARTITION BY doc_id, l ORDER BY p ROWS BETWEEN CURRENT ROW AND l - 1 FOLLOWING) AS g,
    count(*) OVER (PARTITION BY doc_id, l ORDER BY p ROWS BETWEEN CURRENT ROW AND l - 1 FOLLOWING) AS n
  FROM dw, lengths),
hits AS (SELECT doc_id, item_id, l, p FROM doc_windows JOIN item_windows USING (l, g) WHERE n = l),
hit_words AS (SELECT doc_id, count(DISTINCT q) AS n FROM (
  SELECT doc_id, unnest(range(p, p + l)) AS q FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names FROM (
  SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items,
  sha256(coalesce(t.names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items t USING (doc_id)
"""


@_query
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(base.table(spark, sf_dir, "documents")).drop("found")


@_query
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(base.table(spark, sf_dir, "documents"))


ORACLES["op6_near_duplicates"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
flat AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM w),
runs AS (
  SELECT doc_id, n, p, string_agg(word, ' ') OVER (
    PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS s FROM flat),
shingles AS (SELECT DISTINCT doc_id, hash(s) AS h FROM runs WHERE p <= greatest(n - 4, 1)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b
  ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 85 * (x.n + y.n - k)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
component AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id, c.component_id = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN component c USING (doc_id)
"""


@_query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality.quality_scores(base.table(spark, sf_dir, "documents"), base.table(spark, sf_dir, "labels"))
    return scores.drop("row_key")


@_query
def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(base.table(spark, sf_dir, "documents"))


@_query
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(base.table(spark, sf_dir, "documents")).drop("lang", "source")


@_query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening(base.table(spark, sf_dir, "embeddings"))


@_query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = base.table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


ORACLES["op13_hard_negatives"] = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 10
"""
