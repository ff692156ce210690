"""Helpers the operators share: scratch tables, Arrow mapping, word hashing."""

from __future__ import annotations

import contextlib
import ctypes
import pathlib
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.session import remove_scratch, scratch_path

# Ids and other keys are broadcast only after a count found at most so many.
SMALL_KEYS = 500_000
SLICE_BYTES = 4 << 20

_written: list[str] = []


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: a cut that outlives any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def appended(spark: SparkSession, dfs: Iterable[DataFrame], schema: str, label: str) -> DataFrame:
    """Write frames one after the other into one table in the shared folder; with none, an empty one."""
    path = scratch_path(spark, label)
    spark.createDataFrame([], schema).write.parquet(path)
    _written.append(path)
    for df in dfs:
        df.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def drop_stored(spark: SparkSession) -> None:
    """Remove the tables of ``stored``; call it once their results were written."""
    while _written:
        remove_scratch(spark, _written.pop())


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors with the job, as ``--py-files`` does."""
    context = spark.sparkContext
    if getattr(context, "tallyhouse_shipped", False):
        return
    package = pathlib.Path(__file__).resolve().parents[1]
    archive = pathlib.Path(tempfile.mkdtemp(prefix="tallyhouse-code-")) / "tallyhouse_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context.tallyhouse_shipped = True


def hinted(df: DataFrame, limit: int = SMALL_KEYS) -> DataFrame:
    """Broadcast behind a count; larger relations are left to a shuffle join."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(
    df: DataFrame,
    schema: str,
    make: Callable[[], Callable[[pa.RecordBatch], dict[str, object]]],
) -> DataFrame:
    """``mapInArrow`` with a function made once per task; it returns columns by name."""
    ship(df.sparkSession)
    names = [x.split()[0] for x in schema.split(",")]

    def batch_of(columns: dict[str, object], types: dict[str, pa.DataType]) -> pa.RecordBatch:
        arrays = [c if isinstance(c := columns[n], pa.Array) else pa.array(c, types[n]) for n in names]
        return pa.RecordBatch.from_arrays([a.cast(types[n]) for n, a in zip(names, arrays)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = made(make)
        types = _arrow_types(schema)
        for whole in batches:
            for part in slices(whole):
                yield batch_of(work(part), types)
        whole = part = None
        give_back()

    return df.mapInArrow(run, schema)


# What a worker keeps from task to task, by name.
_kept: dict[str, object] = {}
_asked: set[str] = set()


def kept(name: str, new: Callable[[], object]):
    """What is costly to make, such as a coder with its caches: for the next tasks too, if they ask for it."""
    _asked.add(name)
    if name not in _kept:
        _kept[name] = new()
    return _kept[name]


def made(make: Callable[[], object]):
    """Call ``make``; what earlier tasks of other work kept and it didn't ask for goes."""
    _asked.clear()
    work = make()
    if idle := _kept.keys() - _asked:
        for name in idle:
            del _kept[name]
        give_back()
    return work


def let_go() -> None:
    """For tasks apart from ``map_batches``: what earlier tasks kept goes."""
    made(lambda: None)


def give_back() -> None:
    """Hand freed memory to the system, so that a worker that waits for its next task holds little."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # without glibc
        ctypes.CDLL(None).malloc_trim(0)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most 1,000 rows and, but for single rows, some ``SLICE_BYTES``."""
    rows = 1000
    if batch.num_rows:
        rows = max(1, min(rows, SLICE_BYTES * batch.num_rows // max(batch.nbytes, 1)))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _arrow_types(schema: str) -> dict[str, pa.DataType]:
    """Arrow types of a flat DDL schema."""
    kinds = {
        "long": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "string": pa.string(),
        "binary": pa.binary(),
        "boolean": pa.bool_(),
        "array<long>": pa.list_(pa.int64()),
        "array<int>": pa.list_(pa.int32()),
        "array<string>": pa.list_(pa.string()),
    }
    return {n: kinds[k] for n, k in (x.split() for x in schema.split(","))}


# --- words and their hashes -------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown when needed."""

    def __init__(self) -> None:
        self.base = 0xD1342543DE82EF95
        self.up = self.down = np.ones(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            step = np.full(size, self.base, np.uint64)
            back = np.full(size, pow(self.base, -1, 1 << 64), np.uint64)
            step[0] = back[0] = 1
            self.up, self.down = np.cumprod(step), np.cumprod(back)
        return self.up, self.down


_POWERS = Powers()


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of every run of bytes other than white space, in order."""
    parts = []
    at = 0
    while at < len(data):
        end = min(len(data), at + _BLOCK)
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        parts.append(_hash_block(np.frombuffer(data, np.uint8, end - at, at)))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _hash_block(raw: np.ndarray) -> np.ndarray:
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~_SPACE[raw]
    turn = np.diff(inside)
    starts, ends = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _POWERS.upto(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _ODD)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``width`` words; fewer words make one run."""
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    out = np.full(n, np.uint64(width), np.uint64)
    for k in range(width):
        out = mix64(out * _ODD + words[k : k + n])
    return np.unique(out)
