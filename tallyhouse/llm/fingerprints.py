"""Document fingerprints by consistent weighted sampling.

For each of ``SAMPLES`` coordinates every term draws r, c ~ Gamma(2, 1) and
b ~ U(0, 1) from hashes of the term, so equal terms draw alike in all texts.
With weight w: t = floor(ln w / r + b), y = exp(r (t - b)), a = c / (y e^r); the
coordinate is the pair (term, t) with the smallest a. Two texts agree in a
coordinate with the probability of their generalised Jaccard similarity. Terms
are lower-cased words, weights their counts; 16 bits of each pair are kept.

Null texts count as empty; texts without words share one fingerprint of their
own. Rows with equal ids are ordered by text, rows without id come last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tallyhouse.llm.base import mix64, ship, stored, word_hashes

SAMPLES = 64
SEED = 91
BLOCK_CHARS = 1 << 21
DRAWN, FOLDED = 512, 4096
EMPTY = "f" * (4 * SAMPLES)


def _draws(terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, ln c and b of each term (row) and coordinate (column)."""
    salt = mix64(np.arange(1, 2 * SAMPLES + 1, dtype=np.uint64) + np.uint64(SEED << 32))
    uniform = []
    for part, shifts in ((0, (43, 22, 1)), (1, (43, 22))):
        h = mix64(terms[:, None] ^ salt[None, part * SAMPLES : (part + 1) * SAMPLES])
        # Uniform values in (0, 1) of 21 bits each.
        for shift in shifts:
            bits = ((h >> np.uint64(shift)) & np.uint64((1 << 21) - 1)).astype(np.float32)
            uniform.append((bits + np.float32(0.5)) * np.float32(2.0**-21))
    r = -np.log(uniform[0] * uniform[1])
    c = -np.log(uniform[2] * uniform[3])
    return r, np.log(c), uniform[4]


def _packed(terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """ln a as an ordered 32-bit key above 32 bits of hash of (term, t).

    Weight 1 has t = 0 in all coordinates, so it needs no logarithm and one hash.
    """
    r, lnc, b = _draws(terms)
    many = np.flatnonzero(weights > 1)
    t = np.zeros((len(many), SAMPLES), np.float32)
    lna = lnc + r * b - r
    pair = np.repeat(mix64(terms)[:, None], SAMPLES, 1)
    if len(many):
        t = np.floor(np.log(weights[many].astype(np.float32))[:, None] / r[many] + b[many])
        lna[many] = lnc[many] - r[many] * (t - b[many]) - r[many]
        steps = t.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        pair[many] = mix64(terms[many, None] + steps)
    bits = lna.astype(np.float32).view(np.uint32)
    order = np.where(bits >> np.uint32(31), ~bits, bits | np.uint32(1 << 31)).astype(np.uint64)
    return (order << np.uint64(32)) | (pair >> np.uint64(32))


def _sample(terms: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The smallest packed value of each segment and coordinate.

    Each distinct (term, weight) is drawn once, ``DRAWN`` at a time, and segments are
    folded some ``FOLDED`` terms at a time, so that the arrays stay in the cache.
    """
    order = np.lexsort((weights, terms))
    t, w = terms[order], weights[order]
    first = np.append(True, (t[1:] != t[:-1]) | (w[1:] != w[:-1]))
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(first) - 1
    t, w = t[first], w[first]
    packed = np.empty((len(t), SAMPLES), np.uint64)
    for at in range(0, len(t), DRAWN):
        packed[at : at + DRAWN] = _packed(t[at : at + DRAWN], w[at : at + DRAWN])
    out = np.empty((len(starts), SAMPLES), np.uint64)
    ends = np.append(starts[1:], len(terms))
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + FOLDED, "right")))
        values = packed[place[starts[at] : ends[to - 1]]]
        out[at:to] = np.minimum.reduceat(values, starts[at:to] - starts[at], axis=0)
        at = to
    return out


def fingerprints(texts: list[str]) -> list[str]:
    """Hexadecimal fingerprints, four digits per coordinate."""
    out = [EMPTY] * len(texts)
    terms, weights, filled = [], [], []
    for i, text in enumerate(texts):
        found, counts = np.unique(word_hashes(text.encode().lower()), return_counts=True)
        if len(found):
            terms.append(found)
            weights.append(counts)
            filled.append(i)
    if filled:
        starts = np.concatenate([[0], np.cumsum([len(t) for t in terms])[:-1]])
        low = _sample(np.concatenate(terms), np.concatenate(weights), starts).astype(">u2")
        for i, row in zip(filled, low):
            out[i] = row.tobytes().hex()
    return out


def likeness(left: str, right: str) -> float:
    """Share of coordinates that agree."""
    a, b = (np.frombuffer(bytes.fromhex(x), ">u2") for x in (left, right))
    return float(np.mean(a == b))


def edited(text: str, following: str) -> str:
    """The last third of the characters replaced by the first of ``following``."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


FIELDS = (
    "doc_id long,n_chars long,edited_sha256 string,fingerprint string,edited_fingerprint string,"
    "near_edited double,near_next double"
)
_NAMES = [f.split()[0] for f in FIELDS.split(",")]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _columns(
    ids: list, texts: list[str], changed: list[str], own: list[str], other: list[str], after: list[str]
) -> list[pa.Array]:
    columns = [
        ids,
        [len(t) for t in texts],
        [hashlib.sha256(t.encode()).hexdigest() for t in changed],
        own,
        other,
        [likeness(a, b) for a, b in zip(own, other)],
        [likeness(a, b) for a, b in zip(own, after)],
    ]
    return [pa.array(c, t) for c, t in zip(columns, _TYPES)]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts in blocks of bounded size."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            ids.append(i)
            texts.append(t or "")
            size += len(texts[-1])
            if size >= BLOCK_CHARS:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    Rows are range-partitioned and sorted by descending id, and streamed with a
    look at the next row. Only the last row of a partition waits: it is stored
    with its text beside the first row of every partition, and these rows, two
    per partition, are joined afterwards.
    """
    ship(docs.sparkSession)
    order = [F.col("id").desc_nulls_last(), F.xxhash64("text")]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    streamed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    edge = ",part int,first_text string,first_print string,last_text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        names = [*_NAMES, "part", "first_text", "first_print", "last_text"]
        held: tuple | None = None

        def out(columns: list[pa.Array], *edges) -> pa.RecordBatch:
            n = len(columns[0])
            extra = [pa.array([e] * n, t) for e, t in zip((part, *edges), (pa.int32(), *[pa.string()] * 3))]
            return pa.RecordBatch.from_arrays([*columns, *extra], names)

        for ids, texts in _blocks(batches):
            before = [held[1]] if held else []
            chain = before + texts
            changed = [edited(t, n) for t, n in zip(chain, chain[1:])]
            # Texts and edited texts share most terms, so they are sampled together.
            prints = fingerprints(texts + changed)
            own, other = prints[: len(texts)], prints[len(texts) :]
            if held is None:
                yield out([pa.nulls(1, t) for t in _TYPES], texts[0], own[0], None)
            else:
                ids, texts, own = [held[0], *ids], chain, [held[2], *own]
            if changed:
                yield out(_columns(ids[:-1], texts[:-1], changed, own[:-1], other, own[1:]), None, None, None)
            held = (ids[-1], texts[-1], own[-1])
        if held:
            waiting = [pa.nulls(1, t) for t in _TYPES]
            waiting[0], waiting[3] = pa.array([held[0]], pa.int64()), pa.array([held[2]], pa.string())
            yield out(waiting, None, None, held[1])

    done = stored(streamed.mapInArrow(run, FIELDS + edge), "fingerprints")
    # Two short rows per partition: who follows whom, cyclically.
    firsts = done.filter("first_text IS NOT NULL").select("part", "first_text", "first_print")
    parts = firsts.select("part")
    ring = parts.select(
        "part",
        F.coalesce(
            F.lead("part").over(Window.orderBy("part")),
            F.min("part").over(Window.partitionBy()),
        ).alias("following"),
    )
    heads = firsts.select(F.col("part").alias("following"), "first_text", "first_print")
    waiting = (
        done.filter("last_text IS NOT NULL")
        .select("part", F.col("doc_id").alias("id"), F.col("last_text").alias("text"), "fingerprint")
        .join(ring, "part")
        .join(heads, "following")
        .select("id", "text", "fingerprint", "first_text", "first_print")
    )

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, own, following, after = (x.to_pylist() for x in batch.columns)
            changed = [edited(t, n) for t, n in zip(texts, following)]
            columns = _columns(ids, texts, changed, own, fingerprints(changed), after)
            yield pa.RecordBatch.from_arrays(columns, _NAMES)

    inner = done.filter("first_text IS NULL AND last_text IS NULL").select(_NAMES)
    return inner.unionByName(waiting.mapInArrow(close, FIELDS))
