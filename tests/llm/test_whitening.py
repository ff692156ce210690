from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import whitening as w

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, vectors, extra=()):
    rows = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(vectors)] + list(extra)
    return spark.createDataFrame(rows, SCHEMA)


def spread(n, size, seed=3):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, size)) @ rng.normal(size=(size, size))).astype(np.float32)


def brute(vectors, k):
    x = np.floor(64 * np.asarray(vectors, float)).astype(np.int64) + 1_000_000
    off = len(x) * x - x.sum(0)
    centred = off / len(x)
    values, turn = np.linalg.eigh(centred.T @ centred / len(x))
    values, turn = values[::-1], turn[:, ::-1]
    return (off.astype(object) ** 2).sum(1), centred @ turn[:, :k] / np.sqrt(values[:k]), values / values.sum()


def compare(rows, ids, vectors, k):
    deviation, white, explained = brute(vectors, k)
    at = {i: n for n, i in enumerate(ids)}
    got = np.full(white.shape, np.nan)
    for r in rows:
        got[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["n"] == len(ids) and r["deviation"] == deviation[at[r["vec_id"]]]
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-10)
        assert r["identity_error"] < 1e-9
    signs = np.sign((got * white).sum(0))
    assert np.allclose(got * signs, white, atol=1e-9)


@pytest.mark.parametrize("parts", [1, 40])
def test_equals_brute_force(spark, parts):
    vectors = spread(300, 12)
    rows = w.whitening(table(spark, vectors).repartition(parts)).collect()
    assert len(rows) == 300 * 12
    compare(rows, range(300), vectors, 12)


def test_no_more_than_32_components(spark):
    vectors = spread(200, 40)
    rows = w.whitening(table(spark, vectors)).collect()
    assert len(rows) == 200 * 32
    compare(rows, range(200), vectors, 32)


def test_odd_rows_take_no_part(spark):
    vectors = spread(60, 5)
    odd = [
        (100, None, 1),
        (101, [], 1),
        (102, [1.0, None, 1.0, 1.0, 1.0], 1),
        (103, [math.nan] * 5, 1),
        (104, [math.inf] * 5, None),
        (105, [1.0] * 4, 1),
        (106, [3e38] * 5, 1),
    ]
    frame = table(spark, vectors, odd).withColumn("vec", F.lit(1)).withColumn("a.b", F.lit(2))
    compare(w.whitening(frame).collect(), range(60), vectors, 5)


def test_null_and_repeated_ids_count(spark):
    vectors = [[1, 0], [0, 1], [0, 1], [3, 2]]
    rows = spark.createDataFrame([(None, [1.0, 0.0], 1), (7, [0.0, 1.0], 1), (7, [0.0, 1.0], 1), (8, [3.0, 2.0], 1)], SCHEMA)
    got = w.whitening(rows).collect()
    assert len(got) == 8 and {r["n"] for r in got} == {4}
    _, white, _ = brute(vectors, 2)
    assert sorted(abs(r["whitened"]) for r in got) == pytest.approx(sorted(np.abs(white).ravel().tolist()))


def test_no_variation_gives_no_rows(spark):
    assert w.whitening(table(spark, [])).collect() == []
    assert w.whitening(table(spark, [[1.0, 2.0]])).collect() == []
    assert w.whitening(table(spark, [[1.0, 2.0]] * 30)).collect() == []
    # One dimension of three varies.
    rows = w.whitening(table(spark, [[k, 1.0, 5.0] for k in range(50)])).collect()
    assert len(rows) == 50 and {r["component"] for r in rows} == {1}
    assert rows[0]["explained"] == pytest.approx(1.0) and rows[0]["identity_error"] < 1e-9


CASES = {
    "spread": spread(200, 9).astype(float),
    "equal rows": np.ones((50, 5)),
    "repeated rows": np.repeat(np.random.default_rng(0).integers(0, 3, (40, 6)).astype(float), 3, 0),
    "constant columns": np.c_[np.random.default_rng(1).integers(0, 9, (300, 4)), np.zeros((300, 3))].astype(float),
    "equal eigenvalues": np.vstack([np.eye(6)] * 20),
    "far from zero": spread(100, 4).astype(float) + 1e6,
    "one row": np.ones((1, 3)),
}


@pytest.mark.parametrize("name", CASES)
def test_incremental_spectra_alone(name):
    """Rank-one updates and merges alone, before any refinement."""
    x = CASES[name]
    chains = w.Chains(x.shape[1])
    for part in np.array_split(x, 3):
        chains.add(part)
    s = chains.combined()
    scatter = (x - x.mean(0)).T @ (x - x.mean(0))
    scale = max(1.0, np.abs(scatter).max())
    assert s.n == len(x) and np.allclose(s.mean, x.mean(0), rtol=1e-12)
    assert np.abs(s.vectors.T * s.values @ s.vectors - scatter).max() < 1e-10 * scale
    assert np.abs(s.vectors @ s.vectors.T - np.eye(x.shape[1])).max() < 1e-12


def test_secular_roots_equal_eigenvalues():
    rng = np.random.default_rng(5)
    for scale in (1e-9, 1.0, 1e9):
        values = np.sort(rng.random((7, 20)), 1)
        z = rng.normal(size=(7, 20)) * np.sqrt(scale)
        roots, apart = w.secular_roots(values, z * z)
        for d, y, root, off in zip(values, z, roots, apart):
            want = np.linalg.eigvalsh(np.diag(d) + np.outer(y, y))
            assert np.allclose(root, want, rtol=1e-12, atol=1e-13 * max(1.0, scale))
            assert np.all(np.sign(off) == np.where(np.arange(20) <= np.arange(20)[:, None], -1, 1))


def test_exact_deviations_beyond_floats():
    off = np.array([[3_000_000_001, 1], [5, 7]], np.int64)
    assert w.squared_lengths(off * 1).tolist() == [3_000_000_001**2 + 1, 74]
    with pytest.raises(OverflowError):
        w.squared_lengths(np.array([[1 << 32, 1 << 32]], np.int64))
