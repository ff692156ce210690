from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import hard_negatives as h

SCHEMA = "vec_id long, embedding array<float>, label int"
ANCHOR = "vec_id % 10 = 0"


def brute(rows, size):
    """rows: (id, vector, label), without those that take no part; equal rows once."""
    rows = list(dict.fromkeys((i, tuple(math.floor(256 * float(np.float32(x))) for x in v), c) for i, v, c in rows))
    out = []
    for a in rows:
        if a[0] % 10:
            continue
        scored = [(sum(x * y for x, y in zip(a[1], b[1])), b[0], b[2]) for b in rows if b is not a]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for p, positive, _ in [s for s in scored if s[2] == a[2]][: h.POSITIVES]:
            fit = [s for s in scored if s[2] != a[2] and 30 * p <= 100 * s[0] <= 90 * p][: h.NEGATIVES]
            out += [(a[0], positive, k, n, p, s) for k, (s, n, _) in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows, **sizes):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    clash = frame.withColumn("vec", F.lit("x")).withColumn("first", F.lit(0)).withColumn("a.b", F.lit(1))
    return sorted(tuple(r) for r in h.hard_negatives(clash, F.expr(ANCHOR), **sizes).collect())


def clustered(n, size, labels, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, size))
    label = np.where(rng.random(n) < 0.35, 0, rng.integers(0, labels, n))
    vectors = centres[label] * 0.4 + rng.normal(size=(n, size)) * 0.3
    return [(i, v.astype(np.float32).tolist(), int(c)) for i, (v, c) in enumerate(zip(vectors, label))]


@pytest.mark.parametrize("tree_rows,anchor_block", [(4096, 8192), (50, 9)])
def test_equals_brute_force(spark, tree_rows, anchor_block):
    rows = clustered(400, 6, 5)
    assert mined(spark, rows, tree_rows=tree_rows, anchor_block=anchor_block) == brute(rows, 6)


def test_ties_repeats_and_rows_that_take_no_part(spark):
    good = [(i, [float(i % 3), 1.0], i % 2) for i in range(60)]
    good += [(20, [2.0, 1.0], 1), (21, [1.0, 1.0], 7), (10, [0.5, 0.25], 0)]
    odd = [
        (100, None, 1),
        (110, [1.0, None], 1),
        (120, [math.nan, 1.0], 0),
        (130, [math.inf, 1.0], 0),
        (140, [1.0, 1.0], None),
        (None, [1.0, 1.0], 1),
        (150, [], 1),
        (160, [1.0], 1),
        (170, [3e38, 1.0], 1),
    ]
    assert mined(spark, good + odd + good[:30], tree_rows=16) == brute(good, 2)


def test_few_rows_and_none(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(10, [1.0, 0.0], 1)]) == []
    # A positive, but a negative score makes an empty window.
    assert mined(spark, [(10, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-0.5, 0.0], 2)]) == []
    rows = [(10, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.0], 2), (3, [0.95, 0.0], 2), (4, [0.1, 0.0], 3)]
    assert mined(spark, rows) == [(10, 1, 1, 2, 65536, 32768)]


def test_large_components_are_exact(spark):
    rows = [(i, [1000.5 * (i + 1), -3.25 * i, 700_000.0], i % 2) for i in range(40)]
    assert mined(spark, rows) == brute(rows, 3)


def test_boxes_bound_scores_and_prune():
    rng = np.random.default_rng(4)
    centres = rng.integers(-900, 900, (8, 5))
    codes = np.sort(rng.integers(0, 8, 3000)).astype(np.int32)
    vectors = (centres[codes] + rng.integers(-20, 20, (3000, 5))).astype(float)
    tree = h.Tree(np.arange(3000), codes, vectors, leaf=32)
    assert sorted(tree.ids.tolist()) == list(range(3000))
    anchors = vectors[::300]
    lower, upper = tree.bounds(anchors)
    leaves = [n for n in range(len(tree.children)) if not tree.children[n]]
    for anchor, lo, hi in zip(anchors, lower, upper):
        for n in leaves:
            scores = tree.vectors[tree.starts[n] : tree.ends[n]] @ anchor
            assert lo[n] <= scores.min() and scores.max() <= hi[n]
        for n in range(len(tree.children)):
            assert all(lo[n] <= lo[c] and hi[c] <= hi[n] for c in tree.children[n])
        best = h.Best(5)
        visited = h.search(tree, anchor, lo.tolist(), hi.tolist(), [True] * len(lo), lambda at: np.ones(at.stop - at.start, bool), [best])
        every = tree.vectors @ anchor
        order = np.lexsort((tree.ids, -every))[:5]
        assert best.ids.tolist() == tree.ids[order].tolist() and best.scores.tolist() == every[order].tolist()
        assert visited < len(leaves) / 3


def test_tiling_in_few_dimensions():
    rng = np.random.default_rng(9)
    points = rng.random((1000, 2))
    order, starts = h.tile(points, 10)
    assert sorted(order.tolist()) == list(range(1000)) and len(starts) == 100
    sides = [np.ptp(points[order[a : a + 10]], axis=0) for a in starts]
    assert np.mean(sides) < 0.15
