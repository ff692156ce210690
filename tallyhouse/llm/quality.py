"""Quality classifier: perplexity under a Kneser-Ney model of trusted text.

The model is an interpolated modified Kneser-Ney model of byte n-grams up to
``ORDER`` bytes, one per language, counted over the trusted text: every document
that is labelled good and not toxic. Trusted documents are dealt into ``FOLDS``
folds by a hash, and counts are kept per fold, so that each one is judged by the
model of the other folds, as text a model has seen looks too familiar. All other
documents are judged by the model without fold 0. Counts are in shards by
(language, byte before the last); a shard has every n-gram and context that a
query of its key needs, but for the unigrams (256 per language). Documents are
dealt into blocks of one judging model each; a block's distinct n-grams are joined
with the count shards, and the probabilities come back to the block, where each
document's sum is formed.

A document's log-probability per byte is shrunk to its language's trusted mean
with ``PRIOR`` bytes, so that a few words decide little. It is rejected when it
lies beyond the bounds of its language: too strange, or too repetitive to be
prose. Per side the language's spread is the distance from the median of its
trusted documents to their ``LOW`` or ``HIGH`` quantile, shrunk towards that of
all languages with the weight of ``BACK_OFF`` documents and widened by
``sqrt(1 + 1/n)`` for the error of a centre taken from n of them and by the gain a
main model of more text may bring (``SLOPE``), so bounds change smoothly with n. How many spreads a bound lies from the median is fitted on all
labelled documents, each judged by a model that has not seen it, between
``LEAST`` and ``MOST``; see ``reach``.

Texts that are null or empty have no n-gram and are rejected. A language without
trusted text, or with all of it in the fold left out, is not judged; its documents are accepted. A null
language is a language of its own. Repeated rows give repeated results, and an
empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.base import hinted, let_go, ship, stored

ORDER = 5
PRIOR = 200
LOW, HIGH = 0.02, 0.98
BACK_OFF = 50
SLOPE = 0.5  # at most so much a byte's logarithm gains by e times the trusted text
# The fit of the bounds, in spreads from the median, and what losing a share of the
# good documents weighs against accepting the same share of the bad ones.
LEAST, MOST, STEP = 1.0, 4.0, 0.05
CLEAN_WEIGHT = 2.0
BLOCK_BYTES = 12 << 20
FAN_IN = 64
FOLDS = 5
# What a document is to the model; the fold it is judged without is a column of its own.
OTHER, TRUSTED = 0, 1
MAIN = 0  # the fold that the model of all other documents leaves out
HELD_GRAMS = 1 << 20


def grams_of(text: str | None) -> np.ndarray:
    """The ORDER-byte window that ends at each byte, as an integer; the text is led in by zeros."""
    raw = np.frombuffer((text or "").encode(), np.uint8).astype(np.uint64)
    out = np.zeros(len(raw), np.uint64)
    for back in range(min(ORDER, len(raw))):
        out[back:] |= raw[: len(raw) - back] << np.uint64(8 * back)
    return out


def _by_shard(grams: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Slices of equal next-to-last byte; ``grams`` are ordered by it."""
    keys = (grams >> np.uint64(8)) & np.uint64(255)
    cuts = np.flatnonzero(np.diff(keys)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(grams)]):
        if hi > lo:
            yield int(keys[lo]), slice(lo, hi)


def _pack(grams: np.ndarray) -> bytes:
    """N-grams of one shard in four bytes each; the byte that names the shard is left out.

    Rising n-grams differ by little, so the differences are stored, all first bytes before
    all second ones: the high bytes are mostly zero and shrink in the shuffle's compression.
    """
    short = ((grams >> np.uint64(16) << np.uint64(8)) | (grams & np.uint64(255))).astype(np.uint32)
    steps = np.diff(short, prepend=np.uint32(0))
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(packed: bytes, shard: int) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(4, -1)
    steps = np.ascontiguousarray(planes.T).view(np.uint32).ravel()
    short = np.cumsum(steps, dtype=np.uint32).astype(np.uint64)
    return (short >> np.uint64(8) << np.uint64(16)) | np.uint64(shard << 8) | (short & np.uint64(255))


def _merge(grams: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams with summed counts, ordered by shard."""
    every, count = np.concatenate(grams), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, count = every[order], count[order]
    first = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, np.int64)
    unique = every[first]
    total = np.add.reduceat(count, first) if len(every) else count
    order = _shard_order(unique)
    return unique[order], total[order]


def _shard_order(grams: np.ndarray) -> np.ndarray:
    """Order of rising grams by their shard, the next-to-last byte."""
    return np.argsort((grams >> np.uint64(8)).astype(np.uint8), kind="stable")


def _texts(column: pa.ChunkedArray) -> Iterator[str | None]:
    """One value at a time, so that a block's texts aren't copied as a whole."""
    for chunk in column.chunks:
        for value in chunk:
            yield value.as_py()


def _distinct(langs: list[str], texts: Iterator[str | None], wanted: Callable[[str], bool]) -> dict[str, np.ndarray]:
    """Per language the distinct grams of its texts, rising."""
    held: dict[str, list[np.ndarray]] = defaultdict(list)
    sizes: dict[str, int] = defaultdict(int)
    for lang, text in zip(langs, texts):
        if text and wanted(lang):
            held[lang].append(np.unique(grams_of(text)))
            sizes[lang] += len(held[lang][-1])
            if sizes[lang] >= HELD_GRAMS // 2:
                held[lang], sizes[lang] = [np.unique(np.concatenate(held[lang]))], 0
    return {lang: np.unique(np.concatenate(found)) for lang, found in held.items()}


PACKED = "part int,fold int,lang string,shard int,grams binary,counts binary"


def _pack_counts(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0)))).tobytes()


def _unpack_counts(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(packed, np.dtype(f"u{len(packed) // max(n, 1) or 1}")).astype(np.int64)


def _counted(rows: DataFrame) -> DataFrame:
    """(part, fold, lang, shard, grams, counts): the n-grams of each task's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        held: dict[tuple, list] = defaultdict(lambda: [[], []])
        size = 0

        def fold_in(key: tuple) -> None:
            unique, total = _merge(*held[key])
            held[key] = [[unique], [total]]

        for batch in batches:
            for *key, text in zip(*(batch.column(c).to_pylist() for c in ("fold", "lang", "text"))):
                grams = grams_of(text)
                held[tuple(key)][0].append(grams)
                held[tuple(key)][1].append(np.ones(len(grams), np.int64))
                size += len(grams)
                if size >= HELD_GRAMS:
                    for key in held:
                        fold_in(key)
                    size = 0
        out: list[tuple] = []
        for key in held:
            fold_in(key)
            grams, counts = held[key][0][0], held[key][1][0]
            out += [(*key, s, _pack(grams[at]), _pack_counts(counts[at])) for s, at in _by_shard(grams)]
        part = TaskContext.get().partitionId()
        yield _packed_rows([(part, *r) for r in out])

    return rows.mapInArrow(run, PACKED)


def _packed_rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["part", "fold", "lang", "shard", "grams", "counts"]
    types = [pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def _grams(group: pa.Table) -> list[np.ndarray]:
    return [_unpack(g, s) for g, s in zip(group["grams"].to_pylist(), group["shard"].to_pylist())]


def _counts(group: pa.Table) -> list[np.ndarray]:
    return [_unpack_counts(c, len(g) // 4) for g, c in zip(group["grams"].to_pylist(), group["counts"].to_pylist())]


def _combined(counted: DataFrame) -> DataFrame:
    """One row per (lang, shard, fold), merged ``FAN_IN`` task results at a time."""

    def merge(group: pa.Table) -> pa.Table:
        grams, counts = _merge(_grams(group), _counts(group))
        key = [group[c][0].as_py() for c in ("fold", "lang", "shard")]
        part = group["part"][0].as_py() // FAN_IN
        return pa.Table.from_batches([_packed_rows([(part, *key, _pack(grams), _pack_counts(counts))])])

    parts = (counted.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        counted = stored(
            counted.groupBy("fold", "lang", "shard", F.floor(F.col("part") / FAN_IN).alias("fan")).applyInArrow(
                merge, PACKED
            ),
            "gram-counts",
        )
        parts = math.ceil(parts / FAN_IN)
        if parts <= 1:
            return counted


def _types(grams: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of the next lower order and how many bytes precede each."""
    return np.unique(grams & np.uint64((1 << (8 * order)) - 1), return_counts=True)


def _orders(grams: np.ndarray, counts: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Grams and (continuation) counts of the orders from ORDER down to 2 of a shard."""
    order = np.argsort(grams)
    out = {ORDER: (grams[order], counts[order])}
    for k in range(ORDER - 1, 1, -1):
        out[k] = _types(out[k + 1][0], k)
    return out


def _without(model_rows: pa.Table, fold: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams and counts of a shard's folds but one."""
    rows = model_rows.filter(pc.not_equal(model_rows["fold"], fold))
    return _merge(_grams(rows), _counts(rows)) if rows.num_rows else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _statistics(model: DataFrame) -> tuple[dict, dict]:
    """By the fold left out: discounts by (fold, lang, order) and unigram probabilities by (fold, lang).

    The driver gets per (fold, lang, shard), so 256 times a fold and language, 4 counts of
    counts per order and a flag per byte.
    """

    def count(group: pa.Table) -> pa.Table:
        rows = []
        for fold in range(FOLDS):
            grams, counts = _without(group, fold)
            if not len(grams):
                continue
            orders = _orders(grams, counts)
            ones = [int(np.sum(c == n)) for k in range(2, ORDER + 1) for c in (orders[k][1],) for n in (1, 2, 3, 4)]
            seen = np.zeros(256, np.uint8)
            seen[(orders[2][0] & np.uint64(255)).astype(np.int64)] = 1
            rows.append((fold, group["lang"][0].as_py(), ones, seen.tobytes()))
        names, types = ["fold", "lang", "ones", "seen"], [pa.int32(), pa.string(), pa.list_(pa.int64()), pa.binary()]
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    rows = model.groupBy("lang", "shard").applyInArrow(count, "fold int,lang string,ones array<long>,seen binary").collect()
    ones: dict[tuple, np.ndarray] = defaultdict(lambda: np.zeros((ORDER - 1, 4)))
    last: dict[tuple, np.ndarray] = defaultdict(lambda: np.zeros(256))
    for row in rows:
        ones[row["fold"], row["lang"]] += np.reshape(row["ones"], (ORDER - 1, 4))
        last[row["fold"], row["lang"]] += np.frombuffer(row["seen"], np.uint8)
    discounts = {(*key, k): discount(ones[key][k - 2]) for key in ones for k in range(2, ORDER + 1)}
    # Unigrams: continuation counts, interpolated with a uniform byte.
    unigrams = {key: (last[key] + 1.0) / (last[key].sum() + 256.0) for key in last}
    return discounts, unigrams


def _done(table: pa.Table) -> pa.Table:
    """A group's result; what the group held goes back to the system before the next one."""
    let_go()
    pa.default_memory_pool().release_unused()
    return table


def discount(ones: np.ndarray) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and from 3 on, from the numbers of counts 1 to 4."""
    n1, n2, n3, n4 = (max(float(n), 1.0) for n in ones)
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0.0, *(min(max(d, 0.1), i + 0.9) for i, d in enumerate(raw))])


def _tables(grams: np.ndarray, counts: np.ndarray, discounts: dict[int, np.ndarray]) -> dict[int, tuple]:
    """Per order what a shard's queries look up: grams, counts, contexts, their totals and discounts taken."""
    orders, out = _orders(grams, counts), {}
    for k in range(2, ORDER + 1):
        known, count = orders[k]
        contexts, start = np.unique(known >> np.uint64(8), return_index=True)
        total = np.add.reduceat(count, start).astype(float)
        out[k] = known, count, contexts, total, np.add.reduceat(discounts[k][np.minimum(count, 3)], start)
    return out


def _looked_up(queries: np.ndarray, tables: dict[int, tuple], discounts: dict[int, np.ndarray], unigrams: np.ndarray) -> np.ndarray:
    p = unigrams[(queries & np.uint64(255)).astype(np.int64)]
    for k, (known, count, contexts, total, taken) in tables.items():
        d = discounts[k]
        wanted = queries & np.uint64((1 << (8 * k)) - 1)
        at = np.minimum(np.searchsorted(contexts, wanted >> np.uint64(8)), len(contexts) - 1)
        has = contexts[at] == wanted >> np.uint64(8)
        own = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
        n = np.where(known[own] == wanted, count[own], 0)
        with_context = (n - d[np.minimum(n, 3)] + taken[at] * p) / total[at]
        p = np.where(has, with_context, p)
    return p


def probabilities(
    queries: np.ndarray, grams: np.ndarray, counts: np.ndarray, discounts: dict[int, np.ndarray], unigrams: np.ndarray
) -> np.ndarray:
    """Probability of the last byte of each query given the bytes before it."""
    return _looked_up(queries, _tables(grams, counts, discounts), discounts, unigrams)


def _scored(dealt: DataFrame, blocks: int, model: DataFrame, discounts: dict, unigrams: dict) -> DataFrame:
    """row_key, doc_id, lang, role, n_grams, log_sum, cross_sum of every row of ``dealt``.

    ``log_sum`` is under the model without fold ``MAIN``, ``cross_sum`` under the one without the
    block's fold; they are null without trusted text there.
    """

    def judged(fold: int) -> Callable[[str], bool]:
        return lambda lang: (fold, lang) in unigrams or (MAIN, lang) in unigrams

    def gather(group: pa.Table) -> pa.Table:
        block, fold = group["block"][0].as_py(), group["fold"][0].as_py()
        rows = []
        for lang, grams in _distinct(group["lang"].to_pylist(), _texts(group["text"]), judged(fold)).items():
            grams = grams[_shard_order(grams)]
            rows += [(block, fold, lang, s, _pack(grams[at]), b"") for s, at in _by_shard(grams)]
        return _done(pa.Table.from_batches([_packed_rows(rows)]))

    def look_up(model_rows: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if asked.num_rows:
            lang, shard = asked["lang"][0].as_py(), asked["shard"][0].as_py()
            held: dict[int, dict] = {}

            def logs(queries: np.ndarray, fold: int) -> bytes:
                """Logarithms under the model without a fold; none if it has no text of the language."""
                if (fold, lang) not in unigrams:
                    return b""
                if fold not in held:
                    for other in [f for f in held if f != MAIN]:
                        del held[other]
                    grams, counts = _without(model_rows, fold)
                    steps = {k: discounts[fold, lang, k] for k in range(2, ORDER + 1)}
                    held[fold] = _tables(grams, counts, steps) if len(grams) else {}
                steps = {k: discounts[fold, lang, k] for k in held[fold]}
                return np.log(_looked_up(queries, held[fold], steps, unigrams[fold, lang])).astype(np.float32).tobytes()

            for block, fold, packed in sorted(
                zip(asked["part"].to_pylist(), asked["fold"].to_pylist(), asked["grams"].to_pylist()), key=lambda r: r[:2]
            ):
                queries = _unpack(packed, shard)
                main = logs(queries, MAIN)
                # Rows of fold MAIN carry one logarithm an n-gram, others those of both models.
                # The block knows its n-grams and their order, so only these return.
                out.append((block, lang, shard, main, b"" if fold == MAIN else logs(queries, fold)))
        names = ["part", "lang", "shard", "main", "cross"]
        types = [pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary()]
        return _done(pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names))

    def total(texts: pa.Table, known: pa.Table) -> pa.Table:
        tables, fold = {}, texts["fold"][0].as_py() if texts.num_rows else MAIN
        langs = texts["lang"].to_pylist()
        answered = set(known["lang"].to_pylist())
        for lang, grams in _distinct(langs, _texts(texts["text"]), answered.__contains__).items():
            of = known.filter(pc.equal(known["lang"], lang)).sort_by("shard")
            back = _shard_order(grams)
            logs = []
            for c in ("main", "cross"):
                found = np.frombuffer(b"".join(of[c].to_pylist()), np.float32)
                logs.append(None)
                if len(found):
                    logs[-1] = np.empty(len(grams), np.float32)
                    logs[-1][back] = found
            tables[lang] = grams, *logs
        sizes, sums, crosses = [], [], []
        for lang, text in zip(langs, _texts(texts["text"])):
            grams = grams_of(text)
            sizes.append(len(grams))
            main = cross = None
            if lang in tables and len(grams):
                keys, *logs = tables[lang]
                at = np.searchsorted(keys, grams)
                main, cross = (float(x[at].sum(dtype=np.float64)) if x is not None else None for x in logs)
            sums.append(main)
            crosses.append(main if fold == MAIN else cross)
        return _done(pa.table(
            {
                "row_key": texts["row_key"],
                "doc_id": texts["doc_id"],
                "lang": texts["lang"],
                "role": texts["role"],
                "bad": texts["bad"],
                "fold": texts["fold"],
                "n_grams": pa.array(sizes, pa.int64()),
                "log_sum": pa.array(sums, pa.float64()),
                "cross_sum": pa.array(crosses, pa.float64()),
            }
        ))

    chunk = F.floor(F.col("part") / FAN_IN)
    asked = dealt.groupBy("block").applyInArrow(gather, PACKED).withColumn("chunk", chunk)
    # A shard meets FAN_IN blocks at a time, so no task holds the queries of all.
    chunks = F.sequence(F.lit(0).cast("long"), F.lit((blocks - 1) // FAN_IN).cast("long"))
    copies = model.withColumn("chunk", F.explode(chunks))
    answered = (
        copies.groupBy("lang", "shard", "chunk")
        .cogroup(asked.groupBy("lang", "shard", "chunk"))
        .applyInArrow(look_up, "part int,lang string,shard int,main binary,cross binary")
    )
    answered = answered.withColumn("block", F.col("part"))
    return dealt.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(
        total,
        "row_key long,doc_id long,lang string,role int,bad boolean,fold int,n_grams long,log_sum double,cross_sum double",
    )


def reach(good: np.ndarray, bad: np.ndarray) -> float:
    """How many spreads from the median a bound lies, on the grid from ``LEAST`` to ``MOST``.

    ``good`` and ``bad`` count labelled documents by the first grid point that is not below
    their distance; a last cell holds those beyond ``MOST``. The point with the least
    ``CLEAN_WEIGHT`` times the share of good ones beyond it plus the share of bad ones within
    is taken; of equals the middle one, so a gap between good and bad is parted halfway.
    """
    lost = 1 - np.cumsum(good)[:-1] / max(good.sum(), 1)
    passed = np.cumsum(bad)[:-1] / max(bad.sum(), 1)
    cost = CLEAN_WEIGHT * lost + passed
    best = np.flatnonzero(cost <= cost.min() + 1e-12)
    return LEAST + STEP * float(best[len(best) // 2])


def _reaches(judged: DataFrame) -> tuple[float, float]:
    """The fitted reach to either side over labelled documents with ``below`` and ``above``,
    their distances from the median in spreads; the driver gets a count per grid point."""
    cells = int(round((MOST - LEAST) / STEP)) + 1
    cell = lambda c: F.greatest(F.lit(0), F.least(F.lit(cells), F.ceil((F.col(c) - LEAST) / STEP)))
    rows = (
        judged.filter("(bad OR role = 1) AND below IS NOT NULL")
        .select("bad", F.explode(F.array(*(F.struct(F.lit(s).alias("side"), cell(c).alias("cell")) for s, c in enumerate(("below", "above"))))).alias("at"))
        .groupBy("bad", "at.side", "at.cell")
        .count()
        .collect()
    )
    found = np.zeros((2, 2, cells + 1))
    for row in rows:
        found[row["side"], int(row["bad"]), int(row["cell"])] += row["count"]
    return reach(*found[0]), reach(*found[1])


def row_key(docs: DataFrame, id_col: str, text_col: str, lang_col: str):
    """Names a row by its content, so that rows with equal ids are told apart."""
    return F.xxhash64(docs[id_col], docs[text_col], docs[lang_col])


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row: doc_id, row_key, lang, n_grams, perplexity, the one judged, its bounds, accepted.

    ``labels`` has doc_id, quality and perhaps toxic; a document is trusted if a label says
    quality 1 and none says toxic, and bad if a label says quality 0. ``perplexity`` is under
    the model without fold ``MAIN`` for all; ``judged`` is under one the document is no part of.
    """
    ship(docs.sparkSession)
    toxic = F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))) if "toxic" in labels.columns else F.lit(False)
    says = lambda q: F.max(F.coalesce(F.col("quality") == q, F.lit(False)))
    marks = (
        labels.groupBy(F.col("doc_id").alias("id"))
        .agg(says(1).alias("good"), says(0).alias("poor"), toxic.alias("toxic"))
        .select("id", (F.col("good") & ~F.col("toxic")).alias("trusted"), (F.col("poor") & ~F.col("good")).alias("poor"))
        .filter("trusted OR poor")
    )
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(lang_col), F.lit("")).alias("lang"),
        F.col(text_col).alias("text"),
        row_key(docs, id_col, text_col, lang_col).alias("row_key"),
    )
    trusted = F.coalesce("trusted", F.lit(False))
    marked = rows.join(hinted(marks), F.col("doc_id") == F.col("id"), "left").select(
        *rows.columns,
        F.when(trusted, TRUSTED).otherwise(OTHER).alias("role"),
        F.coalesce("poor", F.lit(False)).alias("bad"),
        F.when(trusted, F.pmod("row_key", F.lit(FOLDS))).otherwise(MAIN).cast("int").alias("fold"),
    )
    found = marked.groupBy("fold").agg(F.sum(F.octet_length("text")).alias("n")).collect()
    size = {r["fold"]: r["n"] or 0 for r in found}
    # The blocks of a fold have numbers of their own.
    parts = [max(1, math.ceil(size.get(f, 0) / block_bytes)) for f in range(FOLDS)]
    starts = [sum(parts[:f]) for f in range(FOLDS)]
    of_fold = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("fold") + 1)
    model = _combined(_counted(marked.filter((F.col("role") == TRUSTED) & (F.col("text") != "")).select("fold", "lang", "text")))
    discounts, unigrams = _statistics(model)
    block = of_fold(starts) + F.pmod(F.xxhash64("row_key"), of_fold(parts))
    dealt = marked.withColumn("block", block.cast("int"))
    scored = stored(_scored(dealt, sum(parts), model, discounts, unigrams), "quality-scores")
    own = (F.col("role") == TRUSTED) & (F.col("n_grams") > 0) & F.col("cross_sum").isNotNull()
    per_byte = lambda total: F.sum(F.when(total.isNotNull(), total)) / F.sum(F.when(total.isNotNull(), F.col("n_grams")))
    means = scored.filter(own).groupBy("lang").agg(
        per_byte(F.col("cross_sum")).alias("cross_mean"),
        per_byte(F.when(F.col("fold") == MAIN, F.col("log_sum"))).alias("main_mean"),
    )
    shrunk = lambda total, mean: -(F.col(total) + PRIOR * mean) / (F.col("n_grams") + PRIOR)
    judged = scored.join(hinted(means), "lang", "left").select(
        *scored.columns,
        shrunk("log_sum", F.coalesce("main_mean", "cross_mean")).alias("shown"),
        shrunk("cross_sum", F.col("cross_mean")).alias("x"),
    )
    quantiles = F.percentile_approx("x", [LOW, 0.5, HIGH], 10_000)
    spread = judged.filter(own).groupBy("lang").agg(quantiles.alias("q"), F.count("*").alias("n"))
    spread = stored(
        spread.select("lang", "n", F.col("q")[1].alias("centre"), (F.col("q")[1] - F.col("q")[0]).alias("down"), (F.col("q")[2] - F.col("q")[1]).alias("up")),
        "spreads",
    )
    # Of all languages: the quantiles of the distance from the own language's median.
    pooled = (
        judged.filter(own)
        .join(hinted(spread), "lang")
        .agg(F.percentile_approx(F.col("x") - F.col("centre"), [LOW, HIGH], 10_000).alias("q"))
        .first()["q"]
    )
    all_down, all_up = (-pooled[0], pooled[1]) if pooled else (0.0, 0.0)
    backed = lambda c, of_all: (
        (F.col("n") * F.col(c) + BACK_OFF * of_all) / (F.col("n") + BACK_OFF) * F.sqrt(1 + 1 / F.col("n")) + 1e-9
    )
    # With few trusted documents the main model has more or less text than those they are judged by.
    in_folds = scored.filter((F.col("role") == TRUSTED) & (F.col("n_grams") > 0)).groupBy("lang", "fold").agg(
        F.count("*").alias("n"), F.sum("n_grams").cast("double").alias("b")
    )
    all_text, rest = F.col("all_text"), lambda f: F.log(F.col("all_text") - f["b"])
    shift = (
        in_folds.groupBy("lang")
        .agg(
            F.sum("b").alias("all_text"),
            F.sum("n").alias("all_n"),
            F.coalesce(F.sum(F.when(F.col("fold") == MAIN, F.col("b"))), F.lit(0.0)).alias("left_out"),
            F.collect_list(F.struct("n", "b")).alias("folds"),  # at most FOLDS
        )
        .select("lang", (F.log(all_text - F.col("left_out")) - F.aggregate("folds", F.lit(0.0), lambda t, f: t + f["n"] * rest(f)) / F.col("all_n")).alias("shift"))
    )
    spread = spread.join(hinted(shift), "lang").select(
        "lang",
        "centre",
        (backed("down", all_down) + SLOPE * F.greatest(F.coalesce("shift", F.lit(0.0)), F.lit(0.0))).alias("down"),
        (backed("up", all_up) + SLOPE * F.greatest(-F.coalesce("shift", F.lit(0.0)), F.lit(0.0))).alias("up"),
    )
    placed = (
        judged.join(hinted(spread), "lang", "left")
        .withColumn("below", (F.col("centre") - F.col("x")) / F.col("down"))
        .withColumn("above", (F.col("x") - F.col("centre")) / F.col("up"))
    )
    to_low, to_high = _reaches(placed.filter("n_grams > 0"))
    inside = (F.col("below") <= to_low) & (F.col("above") <= to_high)
    return placed.select(
        "doc_id",
        "row_key",
        "lang",
        "n_grams",
        F.exp("shown").alias("perplexity"),
        F.exp("x").alias("judged"),
        F.exp(F.col("centre") - to_low * F.col("down")).alias("lowest"),
        F.exp(F.col("centre") + to_high * F.col("up")).alias("highest"),
        ((F.col("n_grams") > 0) & F.coalesce(inside, F.lit(True))).alias("accepted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns."""
    names = {"id_col": "doc_id", "text_col": "text", "lang_col": "lang"} | columns
    scores = quality_scores(docs, labels, **names)
    rejected = stored(scores.filter("NOT accepted").select("row_key").distinct(), "rejected")
    return docs.join(hinted(rejected), row_key(docs, **names) == rejected["row_key"], "left_anti")
