"""From raw documents to encoded training text, in five stages.

Each stage gets what its predecessor kept, as a table read back from Parquet.
Rows without text are rejected by the first stage; an empty table passes through
as an empty table. Columns beyond those of ``documents`` are kept by all stages
but the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.llm import base, decontaminate, near_duplicates, pieces, pii, quality
from tallyhouse.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the perplexity classifier rejects."""
    base.drop_stored(spark)
    return quality.accepted(docs, base.table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of a similarity of 0.8 or more, the one with the smallest id."""
    base.drop_stored(spark)
    return near_duplicates.deduplicated(docs, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a window of a benchmark item."""
    base.drop_stored(spark)
    return decontaminate.clean(docs, base.table(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets; ``n_chars`` follows the new text."""
    base.drop_stored(spark)
    cleaned = pii.redact(docs)
    n_chars = F.length(F.coalesce("text", F.lit(""))).cast(dict(docs.dtypes).get("n_chars", "long"))
    return cleaned.withColumn("n_chars", n_chars) if "n_chars" in docs.columns else cleaned


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes every text: doc_id, n_pieces, pieces, and whether they decode to the text."""
    base.drop_stored(spark)
    return pieces.round_trip(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("pieces", encoding_stage),
]

# The classifier's model and the pieces can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; returns the last one's table."""
    docs = base.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    base.drop_stored(spark)
    return docs
