"""Hard-negative mining with sort-tile-recursive packed R-trees.

Components become integers floor(``SCALE`` * x), and a score is an exact integer
inner product. Rows are range-partitioned by label and first coordinate and packed
into trees of at most ``TREE_ROWS``: inside a tree, every label's rows are tiled
recursively, coordinate by coordinate, into leaves of ``LEAF`` rows, and ``FANOUT``
neighbouring nodes at a time get a parent. A node holds the smallest and largest
value of every coordinate and the range of its labels. For an anchor each
coordinate's interval gives an interval of products, and their sums bound all
scores of a node.

Anchors are the query set, taken in blocks of some ``ANCHOR_BLOCK`` by a hash and
sent to all tasks; each task searches its trees best-first: a queue by upper bound,
from which a node is dropped if it has no row of a wanted label, lies outside every
score window, or strictly below the k-th best score that the task found so far (equal scores
can still win by a smaller id). The first search finds an anchor's positives, the rows
of its label with the highest scores; the second, per positive, the best rows of
other labels whose score is between ``low`` and ``high`` percent of the positive's.
The best of all trees are taken by a window function. What passes the driver per
block is its anchors and their positives, a bounded number of rows.

Ranks are by falling score, ties by smaller id. Rows take no part if the id, label
or vector is null, the vector is empty, a component is null, infinite, NaN or
beyond ``LARGEST``, or the vector's length is not the commonest one (of equally
common ones the longer). Rows equal in id, label and vector are one row; rows that
share an id only are rows of their own, and a row is never its own positive. An
anchor without positives, or a positive without negatives, gives no rows; so does
an empty table. Percentages of a negative positive score bound an empty window.
Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.llm.base import appended, ship, stored

SCALE = 256
LARGEST = 2.0**20
TREE_ROWS = 4096
LEAF = 128
FANOUT = 8
ANCHOR_BLOCK = 8192
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90


# --- trees ---------------------------------------------------------------------


def tile(vectors: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Sort-tile-recursive order of the rows, and where its leaves start."""
    order, starts = [], []
    pending = [(np.arange(len(vectors)), 0)]
    at = 0
    while pending:
        rows, axis = pending.pop()
        left = vectors.shape[1] - axis
        pages = math.ceil(len(rows) / leaf)
        if pages <= 1:
            order.append(rows)
            starts.append(at)
            at += len(rows)
            continue
        rows = rows[np.argsort(vectors[rows, axis], kind="stable")]
        slabs = pages if left == 1 else math.ceil(pages ** (1 / left) - 1e-9)
        slabs = max(slabs, 2)
        size = math.ceil(pages / slabs) * leaf
        parts = [(rows[i : i + size], min(axis + 1, vectors.shape[1] - 1)) for i in range(0, len(rows), size)]
        pending += parts[::-1]
    return np.concatenate(order), np.array(starts)


class Tree:
    """A packed tree over rows that are sorted by label code; nodes of a level lie next to each other."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray, vectors: np.ndarray, leaf: int = LEAF) -> None:
        order, starts = [], []
        # Labels with a leaf's worth of rows get leaves of their own, rarer ones share.
        cuts = np.flatnonzero(np.diff(codes)) + 1
        shared = None
        for lo, hi in zip([0, *cuts], [*cuts, len(codes)]):
            if hi - lo < leaf:
                if shared is None or hi - shared > leaf:
                    shared = lo
                    starts.append(lo)
                order.append(np.arange(lo, hi))
                continue
            shared = None
            inner, at = tile(vectors[lo:hi], leaf)
            order.append(lo + inner)
            starts += (lo + at).tolist()
        place = np.concatenate(order)
        self.ids, self.codes, self.vectors = ids[place], codes[place], vectors[place]
        self.starts = np.array(starts)
        self.ends = np.append(self.starts[1:], len(place))
        low, high = (f.reduceat(self.vectors, self.starts) for f in (np.minimum, np.maximum))
        first, last = self.codes[self.starts], self.codes[self.ends - 1]
        self.children: list[range] = [range(0)] * len(starts)
        lows, highs, firsts, lasts = [low], [high], [first], [last]
        base = 0
        while len(low) > 1:
            at = np.arange(0, len(low), FANOUT)
            self.children += [range(base + i, base + min(i + FANOUT, len(low))) for i in at]
            base += len(low)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            first, last = np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)
            for all_of, level in zip((lows, highs, firsts, lasts), (low, high, first, last)):
                all_of.append(level)
        self.low, self.high, self.first, self.last = (np.concatenate(x) for x in (lows, highs, firsts, lasts))
        self.root = len(self.low) - 1

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score that each node's box allows, per anchor."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T


class Best:
    """The k rows of highest score, ties by smaller id, among those within a score window."""

    def __init__(self, k: int, low: float = -math.inf, high: float = math.inf) -> None:
        self.k, self.low, self.high = k, low, high
        self.scores, self.ids = np.zeros(0), np.zeros(0, np.int64)

    @property
    def least(self) -> float:
        """Scores strictly below it can't get in any more."""
        return max(self.low, self.scores[-1]) if len(self.scores) == self.k else self.low

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fit = np.flatnonzero((scores >= self.least) & (scores <= self.high))
        if len(fit):
            scores, ids = np.append(self.scores, scores[fit]), np.append(self.ids, ids[fit])
            order = np.lexsort((ids, -scores))[: self.k]
            self.scores, self.ids = scores[order], ids[order]


def search(
    tree: Tree,
    anchor: np.ndarray,
    lower: list,
    upper: list,
    wanted: list[bool],
    rows: Callable[[slice], np.ndarray],
    best: list[Best],
) -> int:
    """Best-first search of one tree for one anchor; returns the number of leaves it scored.

    ``wanted`` tells which nodes hold wanted labels, ``rows`` which rows of a leaf
    count. A node is expanded if some window can still take a score between its bounds.
    """
    visited = 0
    needed = lambda n: any(lower[n] <= b.high and upper[n] >= b.least for b in best)
    queue = [(-upper[tree.root], tree.root)] if wanted[tree.root] else []
    while queue:
        bound, node = heapq.heappop(queue)
        if -bound < min(b.least for b in best):
            break
        if not needed(node):
            continue
        if tree.children[node]:
            for child in tree.children[node]:
                if wanted[child] and needed(child):
                    heapq.heappush(queue, (-upper[child], child))
            continue
        at = slice(tree.starts[node], tree.ends[node])
        scores = tree.vectors[at] @ anchor
        visited += 1
        if scores.max() < min(b.least for b in best):
            continue
        fit = rows(at)
        for b in best:
            b.offer(scores[fit], tree.ids[at][fit])
    return visited


# --- over the table ------------------------------------------------------------

_ROW = "vec_id long,label string,vec binary,first int"


def _usable(embeddings: DataFrame, id_col: str, vector_col: str, label_col: str, anchor: Column) -> DataFrame:
    """(vec_id, label, vec as packed 32-bit integers, first coordinate, is_anchor) of the rows that take part."""
    rows = embeddings.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{label_col}`").cast("string").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vec"),
        F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
    ).filter("vec_id IS NOT NULL AND label IS NOT NULL AND size(vec) > 0")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vec")
            lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            with np.errstate(invalid="ignore"):
                fine = np.abs(flat) <= LARGEST
            bad = np.concatenate([[0], np.cumsum(~fine)])
            ends = np.cumsum(lengths)
            keep = np.flatnonzero(bad[ends] == bad[ends - lengths])
            whole = np.floor(SCALE * np.where(fine, flat, 0)).astype(np.int32)
            vectors = [whole[ends[i] - lengths[i] : ends[i]].tobytes() for i in keep]
            firsts = [int(whole[ends[i] - lengths[i]]) for i in keep]
            place = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(place),
                    batch.column("label").take(place),
                    pa.array(vectors, pa.binary()),
                    pa.array(firsts, pa.int32()),
                    batch.column("is_anchor").take(place),
                ],
                ["vec_id", "label", "vec", "first", "is_anchor"],
            )

    ship(embeddings.sparkSession)
    return rows.mapInArrow(run, _ROW + ",is_anchor boolean")


_TREE = "ids binary,labels array<string>,codes binary,vectors binary"


def _packed(rows: DataFrame, n: int, tree_rows: int) -> DataFrame:
    """One row per tree; equal rows, which lie next to each other, become one."""
    dealt = rows.repartitionByRange(max(1, math.ceil(n / tree_rows)), "label", "first", "vec_id")
    dealt = dealt.select("vec_id", "label", "vec").sortWithinPartitions("label", F.substring("vec", 1, 4), "vec_id", "vec")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, str, bytes]] = []

        def tree() -> pa.RecordBatch:
            ids, labels, vectors = zip(*held)
            names, codes = np.unique(np.array(labels, object), return_inverse=True)
            arrays = [
                pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                pa.array([names.tolist()], pa.list_(pa.string())),
                pa.array([codes.astype(np.int32).tobytes()], pa.binary()),
                pa.array([b"".join(vectors)], pa.binary()),
            ]
            held.clear()
            return pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in _TREE.split(",")])

        last = None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "label", "vec"))):
                if row != last:
                    held.append(row)
                    last = row
                if len(held) == tree_rows:
                    yield tree()
        if held:
            yield tree()

    return dealt.mapInArrow(run, _TREE)


class AnchorBlock:
    """Some anchors: ids, labels, vectors, and per anchor its positives as (score, id), best first."""

    def __init__(self, rows: list, size: int) -> None:
        self.ids = np.array([r["vec_id"] for r in rows], np.int64)
        self.labels = [r["label"] for r in rows]
        self.vectors = np.frombuffer(b"".join(r["vec"] for r in rows), np.int32).reshape(len(rows), size)
        self.positives: list[list[tuple[int, int]]] = [[] for _ in rows]

    def windows(self, k: int, low: int, high: int) -> list[dict[int, Best]]:
        """Per anchor and distinct score of a positive: the window low * p <= 100 * score <= high * p."""
        return [
            {p: Best(k, -((-low * p) // 100), (high * p) // 100) for p in dict.fromkeys(s for s, _ in found)}
            for found in self.positives
        ]


_FOUND = "anchor int,positive_score long,id long,score long"


def _searched(trees: DataFrame, block: AnchorBlock, size: int, want: tuple) -> DataFrame:
    """(anchor, positive_score, id, score, rank): the best rows of all trees.

    ``want`` is ("positives", k) or ("negatives", k, low, high).
    """
    sent = trees.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        # What earlier trees of the task gave is the bar for the later ones.
        if want[0] == "negatives":
            best = block.windows(*want[1:])
        else:
            best = [{0: Best(want[1])} for _ in block.labels]
        for batch in batches:
            for ids, names, codes, vectors in zip(*(batch.column(c) for c in range(4))):
                whole = np.frombuffer(vectors.as_py(), np.int32).reshape(-1, size)
                kind = _exact_kind(whole, block.vectors)
                codes = np.frombuffer(codes.as_py(), np.int32)
                tree = Tree(np.frombuffer(ids.as_py(), np.int64), codes, whole.astype(kind))
                known = {name: code for code, name in enumerate(names.as_py())}
                look_in = _negatives_in if want[0] == "negatives" else _positives_in
                for lo in range(0, len(block.ids), 256):
                    anchors = block.vectors[lo : lo + 256].astype(kind)
                    lower, upper = (x.tolist() for x in tree.bounds(anchors))
                    for k, vector in enumerate(anchors):
                        i = lo + k
                        if best[i]:
                            wanted, rows = look_in(tree, known.get(block.labels[i], -1), block.ids[i], vector)
                            search(tree, vector, lower[k], upper[k], wanted, rows, list(best[i].values()))
        out = [
            (i, key, int(r), int(s))
            for i, each in enumerate(best)
            for key, b in each.items()
            for s, r in zip(b.scores, b.ids)
        ]
        columns = list(zip(*out)) if out else [[]] * 4
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], [x.split()[0] for x in _FOUND.split(",")]
        )

    found = trees.mapInArrow(run, _FOUND)
    order = Window.partitionBy("anchor", "positive_score").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= want[1])


def _positives_in(tree: Tree, code: int, itself: int, vector: np.ndarray) -> tuple[list[bool], Callable]:
    """Nodes and rows of the anchor's label; the anchor itself is left out."""

    def rows(at: slice) -> np.ndarray:
        fit = tree.codes[at] == code
        same = fit & (tree.ids[at] == itself)
        return fit & ~(same & (tree.vectors[at] == vector).all(1)) if same.any() else fit

    return ((tree.first <= code) & (tree.last >= code)).tolist(), rows


def _negatives_in(tree: Tree, code: int, itself: int, vector: np.ndarray) -> tuple[list[bool], Callable]:
    """Nodes and rows of other labels."""
    only_own = (tree.first == code) & (tree.last == code)
    return (~only_own).tolist(), lambda at: tree.codes[at] != code


def _exact_kind(rows: np.ndarray, anchors: np.ndarray) -> type:
    """Floats where they hold every sum of products exactly, else 64-bit integers."""
    top = lambda x: float(np.abs(x.astype(np.int64)).max(initial=0))
    most = top(rows) * top(anchors) * rows.shape[1]
    if most >= 2.0**62:
        raise OverflowError("scores do not fit 64 bits")
    return np.float64 if most < 2.0**52 else np.int64


RESULT = "anchor_id long,positive_id long,rank int,negative_id long,positive_score long,negative_score long"


def hard_negatives(
    embeddings: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    tree_rows: int = TREE_ROWS,
    anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """Per anchor (rows where ``anchor`` holds), positive and rank: the negatives and both scores."""
    spark = embeddings.sparkSession
    rows = stored(_usable(embeddings, id_col, vector_col, label_col, anchor), "integer-vectors")
    sizes = rows.groupBy(F.length("vec").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if sizes is None:
        return spark.createDataFrame([], RESULT)
    size = sizes["size"] // 4
    rows = rows.filter(F.length("vec") == sizes["size"])
    trees = stored(_packed(rows, sizes["count"], tree_rows), "trees")
    anchors = stored(rows.filter("is_anchor").select("vec_id", "label", "vec").distinct(), "anchors")
    blocks = math.ceil(anchors.count() / anchor_block)

    def results() -> Iterator[DataFrame]:
        for number in range(blocks):
            chosen = anchors.filter(F.pmod(F.xxhash64("vec_id", "label", "vec"), F.lit(blocks)) == number)
            block = AnchorBlock(chosen.collect(), size)
            for r in _searched(trees, block, size, ("positives", positives)).collect():
                block.positives[r["anchor"]].append((r["score"], r["id"]))
            pairs = [(i, int(block.ids[i]), r, s) for i, each in enumerate(block.positives) for s, r in each]
            named = spark.createDataFrame(pairs, "anchor int,anchor_id long,positive_id long,positive_score long")
            found = _searched(trees, block, size, ("negatives", negatives, low, high))
            # At most anchor_block * positives rows.
            yield found.join(F.broadcast(named), ["anchor", "positive_score"]).select(
                "anchor_id",
                "positive_id",
                F.col("rank").cast("int").alias("rank"),
                F.col("id").alias("negative_id"),
                "positive_score",
                F.col("score").alias("negative_score"),
            )

    return appended(spark, results(), RESULT, "hard-negatives")
