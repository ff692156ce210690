"""Quality rules: limits on a text's make-up, then robust multivariate outliers.

Words are runs of characters other than space, tab, line feed, vertical tab, form
feed and carriage return. The base rules fail a document of fewer than
``FEWEST_WORDS`` words, or with more than ``REPEATED`` percent of its words inside
5-word windows that stand twice or more in it.

The method then judges a vector of ``len(FLOORS)`` statistics: symbols, other
punctuation, capitals, characters and repeated words, each per word. A share is
drawn towards its language's median with the weight of ``PRIOR`` words, as short
texts say little, and its square root is taken, which evens out the spread of
counts. Per language and source a minimum-covariance-determinant estimate is made:
concentration steps take the ``COVERAGE`` share of documents that lie closest by
Mahalanobis distance, then their mean and covariance, until the determinants
settle. ``FLOORS`` are added to the diagonal, as most documents have no symbol at
all. Small groups borrow: a group's mean and covariance are shrunk towards those of
its language with the weight of ``BACK_OFF`` documents, a language's towards those
of all documents, so that estimates change smoothly with the number of documents.
Distances are scaled by their median, and a document beyond the chi-squared
quantile ``CUTOFF`` is rejected.

Every step is a filter and a sum per group over a stored table of one short row a
document, so a hot group is summed in all tasks. Group limits are quantiles with an
error of at most 1/``ACCURACY`` in rank; groups of fewer rows are cut exactly.

Null texts have no words and fail the base rules. A null language or source counts
as an empty name. Rows without an id are judged like all others; repeated rows give
repeated results and count as often as they stand in the fit. An empty table gives
no rows. Other columns of the table are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.base import hinted, map_batches, mix64, ship, stored, word_hashes

FEWEST_WORDS = 10
REPEATED = 20
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
# The ASCII punctuation that is not among the symbols.
PUNCTUATION = b"!\"'()+,-./:;=?@[\\]^_`{}~"
SPACE = b"\t\n\x0b\x0c\r "

PRIOR = 20
COVERAGE = 0.5
BACK_OFF = 100
MOST_STEPS = 12
SETTLED = 0.01  # of the logarithm of the determinant
ACCURACY = 10_000
# Estimates are broadcast only if a count found at most so many groups (300 bytes each).
FEW_GROUPS = 100_000
# Standard deviations added to those of the statistics, in their order below.
SHARES = ("n_symbols", "n_punctuation", "n_capitals", "word_chars", "n_repeat_words")
FLOORS = (0.08, 0.04, 0.04, 0.04, 0.08)
SIZE = len(FLOORS)
# Standard score of the quantile: one clean document in a million lies beyond it.
CUTOFF = 4.75

_STATS = "n_words long,word_chars long,n_symbols long,n_dup_lines long,n_repeat_words long,n_punctuation long,n_capitals long"


def chi_squared(score: float, size: int = SIZE) -> float:
    """Quantile of the chi-squared distribution at a standard score (Wilson and Hilferty)."""
    return size * (1 - 2 / (9 * size) + score * math.sqrt(2 / (9 * size))) ** 3


def repeated_words(words: np.ndarray) -> int:
    """Words inside windows that occur twice or more, the first occurrence included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    hashes = np.full(n, np.uint64(WINDOW), np.uint64)
    for k in range(WINDOW):
        hashes = mix64(hashes * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n])
    order = np.argsort(hashes, kind="stable")
    equal = np.diff(hashes[order]) == 0
    again = np.zeros(n, bool)
    again[order[1:][equal]] = again[order[:-1][equal]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += again
    edge[WINDOW:] -= again
    return int((np.cumsum(edge)[:-1] > 0).sum())


def repeated_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in data.split(b"\n") if x.strip(SPACE)]
    return len(lines) - len(set(lines))


def _counts(data: bytes) -> tuple[int, ...]:
    of_byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    many = lambda chars: int(of_byte[list(chars)].sum())
    chars = len(data) - int(of_byte[0x80:0xC0].sum())
    words = word_hashes(data)
    return (
        len(words),
        chars - many(SPACE),
        many(SYMBOLS),
        repeated_lines(data),
        repeated_words(words),
        many(PUNCTUATION),
        many(range(65, 91)),
    )


def text_statistics(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """Per row: doc_id, lang, source and the counts; one pass without a shuffle."""
    named = lambda c: F.col(f"`{c}`")
    rows = docs.select(
        named(id_col).alias("doc_id"),
        F.coalesce(named(lang_col), F.lit("")).alias("lang"),
        F.coalesce(named(source_col), F.lit("")).alias("source"),
        F.encode(F.coalesce(named(text_col), F.lit("")), "UTF-8").alias("text"),
    )
    names = [x.split()[0] for x in _STATS.split(",")]

    def make() -> Callable[[pa.RecordBatch], dict[str, object]]:
        def work(batch: pa.RecordBatch) -> dict[str, object]:
            found = [_counts(text.as_py()) for text in batch.column("text")]
            columns = dict(zip(names, zip(*found))) if found else {n: [] for n in names}
            return columns | {c: batch.column(c) for c in ("doc_id", "lang", "source")}

        return work

    kind = dict(rows.dtypes)["doc_id"].replace("bigint", "long")
    return map_batches(rows, f"doc_id {kind},lang string,source string,{_STATS}", make)


def _vectors(stats: DataFrame) -> DataFrame:
    """``stats`` with x0, x1, ...: square roots of shares, short texts drawn to the language's median.

    ``whole`` is the same in all rows: the group of everything.
    """
    share = lambda c: F.when(F.col("n_words") > 0, F.col(c) / F.col("n_words")).otherwise(0.0)
    usual = stored(
        stats.groupBy("lang").agg(*(F.percentile_approx(share(c), 0.5, ACCURACY).alias(f"usual_{c}") for c in SHARES)),
        "usual-shares",
    )
    drawn = lambda c: F.sqrt((F.col(c) + PRIOR * F.col(f"usual_{c}")) / (F.col("n_words") + PRIOR))
    vector = [drawn(c).alias(f"x{i}") for i, c in enumerate(SHARES)]
    return stats.join(hinted(usual), "lang").select(*stats.columns, F.lit("").alias("whole"), *vector)


_PAIRS = [(i, j) for i in range(SIZE) for j in range(i, SIZE)]
_FIT_NAMES = [*(f"m{i}" for i in range(SIZE)), *(f"p{i}{j}" for i, j in _PAIRS), "log_det", "moved"]


def _distance() -> Column:
    """Squared Mahalanobis distance of x0, ... from the estimate m0, ..., p00, ..."""
    off = [F.col(f"x{i}") - F.col(f"m{i}") for i in range(SIZE)]
    terms = [off[i] * off[j] * F.col(f"p{i}{j}") * (1 if i == j else 2) for i, j in _PAIRS]
    return sum(terms[1:], terms[0])


def _new_estimates(moments: DataFrame, keys: list[str], above: DataFrame | None) -> DataFrame:
    """Estimates of the concentrated rows, shrunk towards those of the level above.

    ``moments`` has per group n (all rows), k (the concentrated ones), the old
    centre m0, ..., and sums s0, ..., s00, ... of differences from it.
    """
    shrunk = above is not None
    joined = moments
    if shrunk:
        on = [c for c in keys if c in above.columns]
        joined = moments.join(above.select(*on, *(F.col(c).alias(f"t_{c}") for c in _FIT_NAMES)), on)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                shift = np.array([row[f"s{i}"] for i in range(SIZE)]) / row["k"]
                mean = np.array([row[f"m{i}"] for i in range(SIZE)]) + shift
                covariance = np.diag(np.square(FLOORS)) - np.outer(shift, shift) + _symmetric(row, "s") / row["k"]
                if shrunk:
                    own = row["n"] / (row["n"] + BACK_OFF)
                    mean = own * mean + (1 - own) * np.array([row[f"t_m{i}"] for i in range(SIZE)])
                    covariance = own * covariance + (1 - own) * np.linalg.inv(_symmetric(row, "t_p"))
                inverse = np.linalg.inv(covariance)
                log_det = np.linalg.slogdet(covariance)[1]
                fit = [*mean, *(inverse[i, j] for i, j in _PAIRS), log_det, abs(log_det - row["log_det"])]
                out.append([*(row[k] for k in keys), *fit])
            yield pd.DataFrame(out, columns=[*keys, *_FIT_NAMES])

    schema = [*(f"{k} string" for k in keys), *(f"{c} double" for c in _FIT_NAMES)]
    return joined.mapInPandas(run, ",".join(schema))


def _symmetric(row: dict, name: str) -> np.ndarray:
    out = np.zeros((SIZE, SIZE))
    for i, j in _PAIRS:
        out[i, j] = out[j, i] = row[f"{name}{i}{j}"]
    return out


def _level(
    rows: DataFrame, keys: list[str], above: DataFrame | None, start: DataFrame, beside: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Estimates per group of ``keys`` by concentration steps from ``start``, until determinants settle.

    ``beside`` marks a table of a row per group for the join with the rows.
    """
    fit = start
    off = [F.col(f"x{i}") - F.col(f"m{i}") for i in range(SIZE)]
    sums = [F.sum(off[i]).alias(f"s{i}") for i in range(SIZE)]
    sums += [F.sum(off[i] * off[j]).alias(f"s{i}{j}") for i, j in _PAIRS]
    old = [F.first(c).alias(c) for c in _FIT_NAMES if c[0] == "m" and c != "moved"] + [F.first("log_det").alias("log_det")]
    for _ in range(MOST_STEPS):
        placed = rows.join(beside(fit), keys).withColumn("far", _distance())
        limit = placed.groupBy(*keys).agg(
            F.percentile_approx("far", COVERAGE, ACCURACY).alias("limit"), F.count("*").alias("n")
        )
        near = placed.join(beside(limit), keys).filter("far <= limit")
        moments = near.groupBy(*keys).agg(F.first("n").alias("n"), F.count("*").alias("k"), *old, *sums)
        fit = stored(_new_estimates(moments, keys, above), "estimates")
        if fit.filter(F.col("moved") > SETTLED).isEmpty():
            break
    return fit


def _first_estimate(rows: DataFrame) -> DataFrame:
    """Over all rows: medians, and a diagonal of the median distances from them."""
    half = lambda c: F.percentile_approx(c, 0.5, ACCURACY)
    centre = stored(rows.groupBy("whole").agg(*(half(f"x{i}").alias(f"m{i}") for i in range(SIZE))), "medians")
    away = [half(F.abs(F.col(f"x{i}") - F.col(f"m{i}"))).alias(f"w{i}") for i in range(SIZE)]
    width = rows.join(hinted(centre), "whole").groupBy("whole").agg(*away)
    variance = [F.pow(1.4826 * F.col(f"w{i}"), 2) + FLOORS[i] ** 2 for i in range(SIZE)]
    inverse = [(1 / variance[i] if i == j else F.lit(0.0)).alias(f"p{i}{j}") for i, j in _PAIRS]
    log_det = sum((F.log(v) for v in variance[1:]), F.log(variance[0])).alias("log_det")
    return stored(centre.join(hinted(width), "whole").select(*centre.columns, *inverse, log_det, F.lit(0.0).alias("moved")), "first-estimate")


def robust_estimates(rows: DataFrame) -> DataFrame:
    """Per (lang, source): the estimate, and the scale that its distances are divided by."""
    ship(rows.sparkSession)
    keys = ["whole", "lang", "source"]
    groups = stored(rows.select(*keys).distinct(), "groups")
    few = groups.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS
    beside = F.broadcast if few else lambda df: df
    fit = _level(rows, keys[:1], None, _first_estimate(rows), beside)
    for depth in (2, 3):
        start = groups.select(*keys[:depth]).distinct().join(fit, keys[: depth - 1])
        fit = _level(rows, keys[:depth], fit, start, beside)
    spread = (
        rows.join(beside(fit), keys)
        .groupBy(*keys)
        .agg(F.percentile_approx(_distance(), 0.5, ACCURACY).alias("middle"), F.count("*").alias("n"))
    )
    ratio = F.col("middle") / chi_squared(0.0)
    scale = F.greatest(F.lit(1.0), (ratio * F.col("n") + BACK_OFF) / (F.col("n") + BACK_OFF))
    return fit.join(spread.select(*keys, scale.alias("scale")), keys)


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """Per row: doc_id, lang, source, the counts, ``distance`` (squared, scaled), base_failed, kept."""
    stats = stored(text_statistics(docs, id_col, text_col, lang_col, source_col), "statistics")
    rows = stored(_vectors(stats), "vectors")
    fits = stored(robust_estimates(rows), "robust-estimates")
    failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    distance = _distance() / F.col("scale")
    return rows.join(hinted(fits), ["whole", "lang", "source"]).select(
        *stats.columns,
        distance.alias("distance"),
        failed.alias("base_failed"),
        (~failed & (distance <= chi_squared(CUTOFF))).alias("kept"),
    )
