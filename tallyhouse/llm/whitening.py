"""Embedding whitening by an incremental eigendecomposition.

An entry c becomes the integer x = floor(``SCALE`` * c) + ``OFFSET``. Every task
keeps spectra of the centred scatter of its rows (count, mean, eigenvalues,
eigenvectors) and applies each row as one centred rank-one update: the new
eigenvalues are the roots of the secular equation between the old ones, entries
that are tiny or belong to equal eigenvalues are deflated first, and the vectors
follow from the roots (Gu and Eisenstat's form, which keeps them orthogonal).
``CHAINS`` spectra advance side by side so that numpy solves their equations
together. Spectra are combined by successive rank-one updates, one per eigenpair
and one for the difference of the means, at most ``FAN_IN`` at a time, in as many
rounds as it takes. The last basis is refined by Rayleigh and Ritz: one pass sums
the covariance of all rows in that basis, centred by the exact mean before
multiplying, and the eigenvectors of this small matrix turn the basis into the
components to double precision.

What leaves a task is a spectrum or a small matrix, never its rows: d * d doubles
for d dimensions, which suits up to about a thousand of them. The table is read
once each for the fit, the refinement, the check of the result and the result.

Rows take no part if the vector is null or empty or has a null, infinite or NaN
entry, or one too large for exact arithmetic (64 * c beyond 2**45), or if its
length is not the commonest one (of equally common ones the longer). Rows without
an id, with equal ids or with equal vectors all count. A component without
variation (an eigenvalue below ``NOTHING`` of the trace) can't be whitened and is
left out, so one row alone, or equal rows only, give no rows; nor does an empty
table. Equal eigenvalues have no vectors of their own; any basis of theirs is used,
the same for all rows. Other columns are not read. Sums that no longer fit 64 bits
are an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.base import ship, stored

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
CHAINS = 8
FAN_IN = 16
NOTHING = 1e-12
TINY = 8 * np.finfo(float).eps
_LARGEST = 2.0**45
_ROUNDS = 60


# --- the secular equation -----------------------------------------------------


def secular_roots(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum_j w_j / (d_j - x) for many equations at once.

    ``values`` (equations, m) are strictly rising, ``weights`` positive. Returns the
    roots and, for root i and pole j, the difference d_j - root_i to full precision:
    a root is sought as its distance from the nearer pole. Each step fits a pole at
    either side of the root to the two parts of the sum and solves the quadratic;
    steps that leave the bracket bisect it, and roots that are found rest.
    """
    n, m = values.shape
    ends = np.concatenate([values[:, 1:], values[:, -1:] + weights.sum(1, keepdims=True)], 1)
    half = (ends - values) / 2
    middle = 1 + (weights[:, None, :] / (values[:, None, :] - values[:, :, None] - half[:, :, None])).sum(2)
    right = middle < 0
    right[:, -1] = False
    origin = np.where(right, ends, values)
    # From here on one row per root.
    delta = (values[:, None, :] - origin[:, :, None]).reshape(n * m, m)
    w = np.repeat(weights, m, 0)
    low = np.tile(np.tri(m), (n, 1))
    last = np.tile(np.arange(m) == m - 1, n)
    right, half, middle = right.ravel(), half.ravel(), middle.ravel()
    before, behind = np.where(right, -2 * half, 0.0), np.where(right, 0.0, 2 * half)
    beyond = last & (middle < 0)
    lo = np.where(right, -half, np.where(beyond, half, 0.0))
    hi = np.where(right, 0.0, np.where(last & ~beyond | ~last, half, 2 * half))
    # The start takes the other poles' part as it is in the middle.
    own = weights.ravel()
    following = np.concatenate([weights[:, 1:], np.zeros((n, 1))], 1).ravel()
    with np.errstate(all="ignore"):
        rest = middle + (own - following) / half
        tau = _quadratic(
            rest, np.where(right, -rest, rest) * 2 * half + own + following, np.where(right, -following, own) * 2 * half
        )
    tau = np.where((tau > lo) & (tau < hi), tau, (lo + hi) / 2)
    active: np.ndarray | slice = slice(None)
    for _ in range(_ROUNDS):
        t = delta[active] - tau[active, None]
        part = w[active] / t
        value = 1 + part.sum(1)
        part /= t
        all_slope, low_slope = part.sum(1), np.einsum("ij,ij->i", part, low[active])
        at, negative = tau[active], value < 0
        lo[active] = np.where(negative, at, lo[active])
        hi[active] = np.where(negative, hi[active], at)
        a, b = before[active] - at, behind[active] - at
        with np.errstate(all="ignore"):
            two = _quadratic(
                value - a * low_slope - b * (all_slope - low_slope), (a + b) * value - a * b * all_slope, a * b * value
            )
            one = a + a * a * low_slope / (value - a * low_slope)
            step = np.where(last[active], one, two)
        found = np.abs(step) <= 1e-10 * np.abs(at)
        new = at + step
        kept = ((new > lo[active]) & (new < hi[active])) | found
        new = np.where(kept, new, (lo[active] + hi[active]) / 2)
        # A root never falls on a pole, however close it is.
        tau[active] = np.where((new == before[active]) | (new == behind[active]), at, new)
        if found.all():
            break
        active = np.arange(n * m)[active][~found]
    return origin + tau.reshape(n, m), (delta - tau[:, None]).reshape(n, m, m)


def _quadratic(c: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The root of c x**2 - a x + b that continues b / a, without cancellation."""
    root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
    return np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))


def _turned(values: np.ndarray, z: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Eigenvectors as rows, in the old basis, for the roots that lie ``apart`` from the poles."""
    m = values.shape[1]
    gaps = values[:, :, None] - values[:, None, :]
    gaps[:, np.arange(m), np.arange(m)] = 1
    size = np.sqrt(np.abs(np.prod(apart / gaps, 1)))
    out = np.copysign(size, z)[:, None, :] / apart
    return out / np.sqrt(np.einsum("bij,bij->bi", out, out))[:, :, None]


def rank_one(values: np.ndarray, vectors: np.ndarray, weight: float, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of V + weight * x x', from that of V: rising values, vectors as rows; with deflation."""
    z = vectors @ x
    length = float(np.linalg.norm(z))
    small = TINY * max(float(np.abs(values).max(initial=0)), weight * length * length)
    if weight * length * length <= small:
        return values, vectors
    values, vectors, z = values.copy(), vectors.copy(), z.copy()
    live: list[int] = []
    for j in range(len(values)):
        if weight * abs(z[j]) * length <= small:
            continue
        if live:
            i = live[-1]
            both = np.hypot(z[i], z[j])
            c, s = z[j] / both, z[i] / both
            if abs((values[j] - values[i]) * c * s) <= small:
                # A rotation moves the older entry's part to the newer one.
                z[i], z[j] = 0.0, both
                a, b = values[i], values[j]
                values[i], values[j] = a * c * c + b * s * s, a * s * s + b * c * c
                vectors[i], vectors[j] = c * vectors[i] - s * vectors[j], s * vectors[i] + c * vectors[j]
                live.pop()
        live.append(j)
    d, y = values[live], z[live]
    if len(live) == 1:
        values[live] = d + weight * y * y
    else:
        roots, apart = secular_roots(d[None], weight * (y * y)[None])
        vectors[live] = _turned(d[None], y[None], apart)[0] @ vectors[live]
        values[live] = roots[0]
    order = np.argsort(values, kind="stable")
    return values[order], vectors[order]


class Spectrum:
    """Count, mean and centred scatter (as eigenpairs) of the rows seen so far."""

    def __init__(self, size: int) -> None:
        self.n, self.mean = 0, np.zeros(size)
        self.values, self.vectors = np.zeros(size), np.eye(size)

    def add(self, x: np.ndarray) -> None:
        off = x - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, self.n / (self.n + 1), off)
        self.n += 1
        self.mean = self.mean + off / self.n

    def combine(self, other: Spectrum) -> None:
        """Take in another spectrum: its eigenpairs one by one, then the way between the means."""
        total = self.n + other.n
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, float(value), vector)
        off = other.mean - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, self.n * other.n / total, off)
        self.mean = self.mean + off * (other.n / total)
        self.n = total


class Chains:
    """Spectra that take every ``CHAINS``-th row each, advanced together."""

    def __init__(self, size: int) -> None:
        self.all = [Spectrum(size) for _ in range(CHAINS)]

    def add(self, rows: np.ndarray) -> None:
        for at in range(0, len(rows), CHAINS):
            self._step(rows[at : at + CHAINS])

    def _step(self, rows: np.ndarray) -> None:
        # The shortest chains come first, so a short batch evens them out.
        chosen = sorted(self.all, key=lambda s: s.n)[: len(rows)]
        off = rows - np.array([s.mean for s in chosen])
        n = np.array([s.n for s in chosen], float)
        values, vectors = np.array([s.values for s in chosen]), np.array([s.vectors for s in chosen])
        z = np.einsum("bij,bj->bi", vectors, off)
        weights = (n / (n + 1))[:, None] * z * z
        small = (TINY * np.maximum(np.abs(values).max(1), weights.sum(1)))[:, None]
        tiny = (np.sqrt(weights * weights.sum(1, keepdims=True)) <= small).any(1)
        with np.errstate(all="ignore"):
            mixed = np.abs(z[:, 1:] * z[:, :-1]) / (z[:, 1:] ** 2 + z[:, :-1] ** 2)
        plain = ~tiny & (np.diff(values, axis=1) * mixed > small).all(1)
        for k in np.flatnonzero(~plain):
            chosen[k].add(rows[k])
        at = np.flatnonzero(plain)
        if not len(at):
            return
        roots, apart = secular_roots(values[at], weights[at])
        turned = _turned(values[at], z[at], apart) @ vectors[at]
        for i, k in enumerate(at):
            s = chosen[k]
            s.values, s.vectors, s.n = roots[i], turned[i], s.n + 1
            s.mean = s.mean + off[k] / s.n

    def combined(self) -> Spectrum:
        first, *others = self.all
        for s in others:
            first.combine(s)
        return first


# --- over the table ------------------------------------------------------------


def usable_rows(column: pa.Array) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Per length of vector: the places of the usable rows, and their entries as integers."""
    column = column.cast(pa.list_(pa.float64()))
    lengths = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False), nan=0).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)  # nulls become NaN
    fine = np.isfinite(flat) & (np.abs(np.where(np.isfinite(flat), flat, 0)) <= _LARGEST / SCALE)
    ends = np.cumsum(lengths)
    ok = lengths > 0
    bad = np.concatenate([[0], np.cumsum(~fine)])
    ok &= bad[ends] == bad[ends - lengths]
    out = {}
    for size in np.unique(lengths[ok]):
        at = np.flatnonzero(ok & (lengths == size))
        entries = flat[(ends[at] - size)[:, None] + np.arange(size)]
        out[int(size)] = at, np.floor(SCALE * entries).astype(np.int64) + OFFSET
    return lengths, out


_STATE = "part long,size int,n long,sums array<long>,mean array<double>,pairs array<double>"


def _state_batch(part: int, states: dict[int, tuple[Spectrum, list[int]]]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.float64())]
    rows = [
        (part, size, s.n, sums, s.mean.tolist(), np.concatenate([s.values, s.vectors.ravel()]).tolist())
        for size, (s, sums) in states.items()
    ]
    columns = list(zip(*rows)) if rows else [[]] * len(kinds)
    names = [x.split()[0] for x in _STATE.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _spectra(rows: DataFrame) -> DataFrame:
    """One spectrum per task and length of vector, with exact sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chains: dict[int, Chains] = {}
        sums: dict[int, list[int]] = {}
        for batch in batches:
            for size, (_, x) in usable_rows(batch.column("vec"))[1].items():
                chains.setdefault(size, Chains(size)).add(x.astype(float))
                total = [int(v) for v in x.sum(0)]
                sums[size] = [a + b for a, b in zip(sums.get(size, [0] * size), total)]
        part = TaskContext.get().partitionId()
        yield _state_batch(part, {size: (c.combined(), sums[size]) for size, c in chains.items()})

    return rows.select("vec").mapInArrow(run, _STATE)


def _spectrum(size: int, n: int, mean: list[float], pairs: list[float]) -> Spectrum:
    s = Spectrum(size)
    s.n, s.mean = n, np.array(mean)
    pairs = np.array(pairs)
    s.values, s.vectors = pairs[:size], pairs[size:].reshape(size, size)
    return s


def _combined(states: DataFrame) -> DataFrame:
    """Rounds of merges, ``FAN_IN`` spectra each, until one is left."""

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        total, sums = None, None
        for row in frame.sort_values("part").itertuples():
            s = _spectrum(row.size, row.n, row.mean, row.pairs)
            sums = [int(v) for v in row.sums] if sums is None else [a + int(b) for a, b in zip(sums, row.sums)]
            if total is None:
                total = s
            else:
                total.combine(s)
        node = int(frame["part"].iloc[0]) // FAN_IN
        return pd.DataFrame(_state_batch(node, {len(sums): (total, sums)}).to_pydict())

    while states.limit(2).count() > 1:
        node = F.floor(F.col("part") / FAN_IN)
        states = stored(states.groupBy(node).applyInPandas(merge, _STATE), "spectra")
    return states


def _folded(rows: DataFrame, size: int, project: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over the rows of y y', where y is what ``project`` makes of them (a constant column included)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            found = usable_rows(batch.column("vec"))[1]
            if size in found:
                y = project(found[size][1])
                total = y.T @ y + (0 if total is None else total)
        if total is not None:
            entries = pa.array([total[np.tril_indices(len(total))].tolist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([entries], ["entries"])

    parts = rows.select("vec").mapInArrow(run, "entries array<double>")
    summed = parts.select(F.posexplode("entries").alias("pos", "v")).groupBy("pos").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(len(summed))
    for pos, v in summed:
        flat[pos] = v
    width = int((np.sqrt(8 * len(flat) + 1) - 1) / 2)
    out = np.zeros((width, width))
    out[np.tril_indices(width)] = flat
    return out + np.tril(out, -1).T


class Whitening:
    """A fitted whitening: n, exact sums, components as columns, eigenvalues, trace, identity_error."""

    def __init__(self, n: int, sums: list[int]) -> None:
        self.n, self.sums = n, np.array(sums, np.int64)
        self.components = np.zeros((len(sums), 0))
        self.values, self.trace, self.identity_error = np.zeros(0), 0.0, 0.0

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums: exact, and n times the centred rows."""
        if self.n * float(np.abs(x).max(initial=0)) >= 2.0**62:
            raise OverflowError("n times an entry does not fit 64 bits")
        return self.n * x - self.sums

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n) @ self.components / np.sqrt(self.values)


def squared_lengths(off: np.ndarray) -> np.ndarray:
    """Sums of squares per row, exact."""
    largest = float(np.abs(off).max(initial=0))
    if largest * largest * off.shape[1] < 2.0**62:
        return np.einsum("ij,ij->i", off, off)
    exact = [sum(v * v for v in row) for row in off.tolist()]
    if max(exact) >= 1 << 63:
        raise OverflowError("a deviation does not fit 64 bits")
    return np.array(exact, np.int64)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit to the column ``vec`` of all rows; None if no row is usable."""
    ship(rows.sparkSession)
    states = stored(_spectra(rows), "spectra")
    sizes = states.groupBy("size").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if sizes is None:
        return None
    last = _combined(states.filter(F.col("size") == sizes["size"])).first()
    model = Whitening(last["n"], list(last["sums"]))
    size = last["size"]
    basis = np.linalg.qr(_spectrum(size, last["n"], last["mean"], last["pairs"]).vectors.T)[0]
    inner = _folded(rows, size, lambda x: (model.deviations(x) / model.n) @ basis) / model.n
    values, turn = np.linalg.eigh(inner)
    order = np.argsort(-values, kind="stable")[:components]
    model.trace = float(np.trace(inner))
    order = order[values[order] > NOTHING * model.trace]
    model.values, model.components = values[order], basis @ turn[:, order]
    if len(order):
        own = _folded(rows, size, lambda x: np.column_stack([np.ones(len(x)), model.whitened(x)])) / model.n
        covariance = own[1:, 1:] - np.outer(own[0, 1:], own[0, 1:])
        model.identity_error = float(np.abs(covariance - np.eye(len(order))).max())
    return model


def whitening(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """A row per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = embeddings.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vec"))
    kind = dict(rows.dtypes)["vec_id"]
    schema = f"vec_id {kind},component int,n long,deviation long,whitened double,explained double,identity_error double"
    model = fit(rows, components)
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)
    size, k = model.components.shape
    explained = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                found = usable_rows(batch.column("vec"))[1]
                if size not in found:
                    continue
                places, x = found[size]
                ids = batch.column("vec_id").take(pa.array(np.repeat(places, k)))
                many = len(places) * k
                columns = [
                    ids,
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(places))),
                    pa.array(np.full(many, model.n, np.int64)),
                    pa.array(np.repeat(squared_lengths(model.deviations(x)), k)),
                    pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(explained, len(places))),
                    pa.array(np.full(many, model.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(",")])

    return rows.mapInArrow(run, schema)
