"""Benchmark decontamination with a distributed positional inverted index.

The index stores a posting (row, term, position) for every word of the corpus
that is also a word of the test set, and one posting of an end mark per row that
carries its length. Each test window looks up the posting lists of its two
rarest terms and intersects them, moved by their offsets; where they meet, the
place of the item in the document is fixed. The lists of the item's other terms
are then intersected at just these places, and runs of matches as long as a
window are exact phrase matches. Proximity matches ask for a number of the item's rarest
terms within a span, in any order.

Rows are told apart by their place in the stored index, so repeated ids give
repeated results. Null and empty texts have no words; items without words or
without id match nothing; empty tables give no rows. Only columns named in the
arguments are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.llm.base import hinted, stored

WINDOW = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
END = "END"  # no word has upper-case ASCII letters


def words(text_col: str) -> Column:
    """Words of a text, A-Z lower-cased; null has none."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    ascii_only = F.length(text) == F.octet_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lowered, NOT_WORD), "")


@dataclass
class Index:
    postings: DataFrame  # row, doc_id, term, pos
    items: DataFrame  # item_id, n, j, term

    @property
    def lengths(self) -> DataFrame:
        return self.postings.filter("term = 0").select("row", "doc_id", F.col("pos").alias("n_words"))


def build_index(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> Index:
    """Postings of the test set's terms, stored in the shared folder."""
    test = (
        items.select(F.col(item_id_col).alias("item_id"), words(item_text_col).alias("w"))
        .filter("item_id IS NOT NULL AND size(w) > 0")
        .distinct()
        .select(F.xxhash64("item_id", "w").alias("item"), "item_id", F.size("w").alias("n"), F.posexplode("w"))
        .toDF("item", "item_id", "n", "j", "word")
    )
    test = stored(test, "test-words")
    # Terms are numbered by a hash of the word; 0 is the end mark.
    term = F.when(F.col("word") == END, F.lit(0).cast("long")).otherwise(F.xxhash64("word")).alias("term")
    vocabulary = test.select("word").distinct().unionByName(
        test.sparkSession.createDataFrame([(END,)], "word string")
    )
    # Rows are numbered before their words are laid out.
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), words(text_col).alias("w")
    )
    exploded = numbered.select("row", "doc_id", F.posexplode(F.array_append("w", F.lit(END))).alias("pos", "word"))
    postings = exploded.join(hinted(vocabulary), "word").select("row", "doc_id", term, "pos")
    return Index(stored(postings, "postings"), test.withColumn("term", term).drop("word"))


def _term_counts(index: Index) -> DataFrame:
    return index.postings.groupBy("term").agg(F.count("*").alias("frequency"))


def candidates(index: Index, window: int = WINDOW) -> DataFrame:
    """(row, item, shift): places where the lists of a window's two rarest terms,
    moved by their offsets, meet."""
    start = F.explode(
        F.sequence(
            F.greatest(F.lit(0), F.col("j") - window + 1),
            F.least(F.col("j"), F.greatest(F.lit(0), F.col("n") - window)),
        )
    )
    ranked = F.array_sort(F.collect_list(F.struct("frequency", "j", "term")))
    seeds = (
        index.items.join(_term_counts(index), "term", "left")
        .select("item", "j", "term", F.coalesce("frequency", F.lit(0)).alias("frequency"), start.alias("start"))
        .groupBy("item", "start")
        .agg(ranked.alias("ranked"))  # as many as a window has words
        .select("item", F.col("ranked")[0].alias("first"), F.coalesce(F.get("ranked", F.lit(1)), F.col("ranked")[0]).alias("second"))
        .filter("first.frequency > 0")
        .select("item", "first.term", "first.j", F.col("second.term").alias("next_term"), F.col("second.j").alias("next_j"))
        .distinct()
    )
    seeds = stored(seeds, "seeds")
    shift = F.col("pos") - F.col("j")
    found = index.postings.join(hinted(seeds), "term").select(
        "row", "item", shift.alias("shift"), F.col("next_term").alias("term"), (shift + F.col("next_j")).alias("pos")
    )
    following = index.postings.join(hinted(seeds.select(F.col("next_term").alias("term")).distinct()), "term", "left_semi")
    met = found.distinct().join(following.select("row", "term", "pos"), ["row", "term", "pos"], "left_semi")
    return met.select("row", "item", "shift").distinct()


def phrase_matches(index: Index, window: int = WINDOW) -> DataFrame:
    """(row, item_id, item, j, pos): words inside an occurrence of a window."""
    places = stored(candidates(index, window), "places")
    needed = places.join(index.items, "item").select(
        "row", "term", (F.col("shift") + F.col("j")).alias("pos"), "item", "item_id", "n", "j", "shift"
    )
    near = index.postings.join(hinted(places.select("row").distinct()), "row", "left_semi")
    common = needed.filter("pos >= 0").join(near.select("row", "term", "pos"), ["row", "term", "pos"])
    along = Window.partitionBy("row", "item", "shift").orderBy("j")
    run = Window.partitionBy("row", "item", "shift", "run")
    return (
        common.withColumn("run", F.col("j") - F.row_number().over(along))
        .withColumn("length", F.count("*").over(run))
        .filter(F.col("length") >= F.least(F.lit(window), F.col("n")))
        .select("row", "item_id", "item", "j", "pos")
    )


def proximity_matches(index: Index, terms: int = 3, within: int = 20) -> DataFrame:
    """(row, item_id, pos): places where the item's ``terms`` rarest distinct terms (all, if it
    has fewer) lie within ``within`` words from the rarest one's posting at ``pos``, in any order."""
    ranked = Window.partitionBy("item").orderBy("frequency", "term")
    rare = (
        index.items.select("item", "item_id", "term")
        .distinct()
        .join(_term_counts(index), "term", "left")
        .withColumn("frequency", F.coalesce("frequency", F.lit(0)))
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= terms)
        .withColumn("wanted", F.count("*").over(Window.partitionBy("item")))
    )
    listed = index.postings.join(hinted(stored(rare, "rare-terms")), "term").select("row", "item", "item_id", "rank", "wanted", "pos")
    cell = F.floor(F.col("pos") / within)
    first = listed.filter("rank = 1").select(
        "row", "item", "item_id", "wanted", F.col("pos").alias("at"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell")
    )
    others = listed.select("row", "item", "rank", "pos", cell.alias("cell"))
    return (
        first.join(others, ["row", "item", "cell"])
        .filter(F.abs(F.col("pos") - F.col("at")) < within)
        .groupBy("row", "item", "item_id", "wanted", "at")
        .agg(F.count_distinct("rank").alias("present"))
        .filter("present = wanted")
        .select("row", "item_id", F.col("at").alias("pos"))
    )


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, **columns: str) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    index = build_index(docs, items, **columns)
    found = stored(phrase_matches(index, window), "phrase-matches")
    hits = found.select("row", "pos").distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    named = (
        found.select("row", F.col("item_id").cast("string").alias("item_id"))
        .distinct()
        .groupBy("row")
        .agg(F.array_sort(F.collect_list("item_id")).alias("names"))
    )
    none = F.array().cast("array<string>")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    names = F.coalesce("names", none)
    return (
        index.lengths.join(hits, "row", "left")
        .join(named, "row", "left")
        .select(
            "doc_id",
            F.col("n_words").cast("long").alias("n_words"),
            n_hit.alias("n_hit"),
            F.size(names).cast("long").alias("n_items"),
            F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
            (n_hit > 0).alias("contaminated"),
        )
    )


def _row_key(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """Names a row by its id and text, so that rows with equal ids or none are told apart."""
    return F.xxhash64(docs[id_col], docs[text_col])


def clean(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", **columns: str
) -> DataFrame:
    """The rows of ``docs``, whole, that are not contaminated; each row is judged by its own text."""
    named = docs.select(_row_key(docs, id_col, text_col).alias("row_key"), docs[text_col].alias("text"))
    index = build_index(named, items, id_col="row_key", **columns)
    found = phrase_matches(index, window).select("row").distinct()
    hit = index.lengths.join(found, "row", "left_semi").select(F.col("doc_id").alias("hit_key")).distinct()
    hit = stored(hit, "contaminated")
    return docs.join(hinted(hit), _row_key(docs, id_col, text_col) == hit["hit_key"], "left_anti")
