"""Near-duplicate groups by an inverted join of MinHash signature coordinates.

1. Every text gets the set of its hashed five-word shingles and a signature of
   ``COORDINATES`` minima. Texts with the same words are one node from here on.
2. Two sets at the threshold agree in at least ``agree`` coordinates (the chance
   to miss a pair is about one in a million, whatever the threshold). So they share
   one of any ``COORDINATES - agree + 1`` coordinates: nodes that share none of the
   first so many values with another node are left out.
3. Nodes are posted under their coordinate-value pairs, rarest first, and only
   under the prefix that any pair with ``agree`` collisions must meet in. Long
   posting lists, such as those of a passage that many texts share, are skipped
   that way, not cut.
4. In each list all members are held against one centre, the member with the
   most company, pairs at the match threshold are confirmed on the full shingle
   sets, and linked nodes become components. After that only members of different
   components within a list are held against each other, so groups of thousands
   of copies never become pairs of all with all, and no link between different
   components is lost. Collisions are counted inside the join, on ``BITS`` further
   coordinates of one bit each: a pair with too many differences never becomes a
   row, others do in the first list they share. Near copies below the threshold
   share most lists, so the bits are many: at 80 percent pairs below 75.4 stay out.
   Pairs with a centre are fewer and are held to a sketch of ``SKETCH`` coordinates.

Null and empty texts have no shingle and stay alone; rows without id are kept and
linked with nothing; rows with equal ids are one document. An empty table gives
no rows. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.base import hinted, map_batches, mix64, shingle_hashes, stored, word_hashes

WIDTH = 5
PERCENT = 85
COORDINATES = 128
SKETCH = 512
BITS = 4096
FIRST_BITS = 1024
DEVIATIONS = 4.9


def agree(percent: int, coordinates: int = COORDINATES) -> int:
    """Coordinates in which a pair at the threshold agrees, less ``DEVIATIONS`` standard deviations.

    At 85 percent, 128 coordinates agree 108.8 times on average with a standard
    deviation of 4.04, so 89; 512 agree 435.2 times with 8.08, so 395.
    """
    p = percent / 100
    return max(1, math.floor(coordinates * p - DEVIATIONS * math.sqrt(coordinates * p * (1 - p))))


def differ(percent: int) -> int:
    """Coordinates in which the sketches of a pair at the threshold may differ."""
    return SKETCH - agree(percent, SKETCH)


def differ_bits(percent: int, bits: int = BITS) -> int:
    """Bits in which a pair at the threshold may differ; bits of different minima agree by chance in half the cases.

    At 80 percent, 4,096 bits agree 3,686.4 times with a standard deviation of 19.2, so
    504 may differ; of a pair of 75.4 percent as many do on average.
    """
    p = (1 + percent / 100) / 2
    return bits - max(1, math.floor(bits * p - DEVIATIONS * math.sqrt(bits * p * (1 - p))))


def _functions(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and shifts of n hash functions."""
    steps = mix64(np.arange(seed, seed + 2 * n, dtype=np.uint64))
    return steps[:n] | np.uint64(1), steps[n:]


_SIGNATURE = _functions(COORDINATES, 1)
_SKETCH = _functions(SKETCH, 1 << 20)
_BITS = tuple((f >> np.uint64(32)).astype(np.uint32) for f in _functions(BITS, 1 << 21))


def words_hashed(text: str | None) -> np.ndarray:
    return word_hashes((text or "").encode().lower())


def signature(shingles: np.ndarray, functions: tuple[np.ndarray, np.ndarray] = _SIGNATURE) -> np.ndarray:
    """The minimum of each of the coordinates' hash functions over a set."""
    factors, shifts = functions
    best = np.full(len(factors), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), 1024):
        values = shingles[None, at : at + 1024] * factors[:, None] + shifts[:, None]
        np.minimum(best, values.min(axis=1), out=best)
    return best


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Four bits of each of ``SKETCH`` minima, sixteen to an integer."""
    bits = (signature(shingles, _SKETCH) >> np.uint64(20)) & np.uint64(15)
    places = np.arange(0, 64, 4, dtype=np.uint64)
    return np.bitwise_or.reduce(bits.reshape(-1, 16) << places, axis=1).view(np.int64)


def bits(shingles: np.ndarray) -> np.ndarray:
    """One bit of each of ``BITS`` minima, 64 to an integer; hashes of 32 bits are enough to tell minima apart."""
    factors, shifts = _BITS[0] | np.uint32(1), _BITS[1]
    best = np.full(BITS, np.uint32(0xFFFFFFFF))
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 64):
        values = short[at : at + 64, None] * factors
        values += shifts
        np.minimum(best, values.min(axis=0), out=best)
    top = mix64(best.astype(np.uint64)) >> np.uint64(63)
    return np.packbits(top.astype(np.uint8), bitorder="little").view(np.int64)


def _signed(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, a 128-bit key of the words, signature."""

    def make():
        def work(batch: pa.RecordBatch) -> dict[str, object]:
            keys, sizes, signatures = [], [], []
            for text in batch.column("text").to_pylist():
                hashed = words_hashed(text)
                shingles = shingle_hashes(hashed, WIDTH)
                digest = hashlib.blake2b(hashed.tobytes(), digest_size=16).digest()
                keys.append(np.frombuffer(digest, np.int64))
                sizes.append(len(shingles))
                signatures.append(signature(shingles) if len(shingles) else np.zeros(0, np.uint64))
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in signatures])]).astype(np.int32)
            flat = np.concatenate(signatures) if signatures else np.zeros(0, np.uint64)
            return {
                "doc_id": batch.column("doc_id"),
                "key_a": [int(k[0]) for k in keys],
                "key_b": [int(k[1]) for k in keys],
                "n_shingles": sizes,
                "signature": pa.ListArray.from_arrays(offsets, flat.view(np.int64)),
            }

        return work

    return map_batches(docs, "doc_id long,key_a long,key_b long,n_shingles long,signature array<long>", make)


def _shared(tokens: DataFrame) -> DataFrame:
    """Coordinate-value pairs that two or more nodes have, with their frequency."""
    counted = tokens.groupBy("coordinate", "value").agg(F.count("*").alias("frequency"))
    return counted.filter("frequency > 1")


def _tokens(nodes: DataFrame, coordinates: int) -> DataFrame:
    return nodes.select(
        "node", F.posexplode(F.slice("signature", 1, coordinates)).alias("coordinate", "value")
    )


def prefixes(nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, company, prefix): the coordinate-value pairs to post a node under, rarest first."""
    least = agree(percent)
    first = _tokens(nodes, COORDINATES - least + 1)
    alive = stored(first.join(_shared(first), ["coordinate", "value"], "left_semi").select("node").distinct(), "alive")
    tokens = stored(_tokens(nodes.join(hinted(alive), "node", "left_semi"), COORDINATES), "tokens")
    return (
        tokens.join(_shared(tokens), ["coordinate", "value"])
        .groupBy("node")
        .agg(
            F.array_sort(F.collect_list(F.struct("frequency", "coordinate", "value"))).alias("ranked"),
            F.sum("frequency").alias("company"),
        )
        # Values that nobody shares count as the rarest; they fill the prefix first.
        .filter(F.size("ranked") >= least)
        .select("node", "company", F.slice("ranked", 1, F.size("ranked") - least + 1).alias("prefix"))
    )


def _token(coordinate: Column, value: Column) -> Column:
    return F.xxhash64(coordinate, value)


def _differences(left: Column, right: Column) -> Column:
    """Coordinates in which two sketches differ."""
    changed = F.zip_with(left, right, lambda a, b: a.bitwiseXOR(b))
    ones = F.lit(0x1111111111111111)

    def count(total: Column, v: Column) -> Column:
        half = v.bitwiseOR(F.shiftrightunsigned(v, 2))
        return total + F.bit_count(half.bitwiseOR(F.shiftrightunsigned(half, 1)).bitwiseAND(ones))

    return F.aggregate(changed, F.lit(0), count)


def _changed_bits(left: Column, right: Column) -> Column:
    """Bits in which two arrays of integers differ."""
    changed = F.zip_with(left, right, lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return F.aggregate(changed, F.lit(0), lambda total, n: total + n)


def _matching(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sketches differ in few enough coordinates."""
    side = lambda name: sets.select(F.col("node").alias(name), F.col("sketch").alias(f"{name}_sketch"))
    return (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .filter(_differences(F.col("a_sketch"), F.col("b_sketch")) <= differ(percent))
        .select("a", "b")
    )


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold."""
    side = lambda name: sets.select(F.col("node").alias(name), F.col("shingles").alias(f"{name}_set"))

    def make():
        def work(batch: pa.RecordBatch) -> dict[str, object]:
            linked = []
            for x, y in zip(batch.column("a_set").to_pylist(), batch.column("b_set").to_pylist()):
                left, right = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(left, right, assume_unique=True))
                linked.append(100 * both >= percent * (len(left) + len(right) - both))
            return {"a": batch.column("a"), "b": batch.column("b"), "linked": linked}

        return work

    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_set", "b_set")
    return map_batches(joined, "a long,b long,linked boolean", make).filter("linked").select("a", "b")


def _sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Sketches, bits and full shingle sets of the nodes that have candidates."""

    def make():
        def work(batch: pa.RecordBatch) -> dict[str, object]:
            found = [shingle_hashes(words_hashed(t), WIDTH) for t in batch.column("text").to_pylist()]
            return {
                "node": batch.column("doc_id"),
                "n_shingles": [len(s) for s in found],
                "sketch": [sketch(s) for s in found],
                "bits": [bits(s) for s in found],
                "shingles": [s.tobytes() for s in found],
            }

        return work

    own = docs.join(hinted(nodes.select(F.col("node").alias("doc_id"))), "doc_id", "left_semi")
    schema = "node long,n_shingles long,sketch array<long>,bits array<long>,shingles binary"
    return map_batches(own.select("doc_id", "text"), schema, make)


def components(edges: DataFrame) -> DataFrame:
    """(node, label) with the smallest node of each component, for nodes with an edge.

    Each round takes the smallest label among the neighbours, then the label of
    that label, until nothing changes; every round is a stored table.
    """
    both = stored(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        seen = labels.select(F.col("node").alias("b"), F.col("label").alias("seen"))
        near = both.join(seen, "b").groupBy("a").agg(F.min("seen").alias("near"))
        hooked = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("root"))
        moved = stored(
            hooked.join(jump, "label", "left").select("node", "old", F.least("label", "root").alias("label")), "labels"
        )
        labels = moved.select("node", "label")
        if moved.filter("old <> label").limit(1).count() == 0:
            return labels


def link(docs: DataFrame, nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, label) of all nodes that are linked with another one."""
    prefixed = stored(prefixes(nodes, percent), "prefixes")
    lists = prefixed.select("node", "company", F.explode("prefix").alias("p")).select(
        "node", "company", "p.coordinate", "p.value"
    )
    sets = stored(_sets(docs, prefixed), "shingle-sets")
    centre = lists.groupBy("coordinate", "value").agg(
        F.max(F.struct("company", (-F.col("node")).alias("order"))).alias("c"), F.count("*").alias("members")
    )
    star = (
        lists.join(centre.filter("members > 1"), ["coordinate", "value"])
        .select(F.col("node").alias("x"), (-F.col("c.order")).alias("y"))
        .filter("x <> y")
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
    )
    first = stored(_confirmed(_matching(star, sets, percent), sets, percent), "links")
    labels = components(first)
    second = stored(_confirmed(_crossing(lists, prefixed, labels, sets, percent), sets, percent), "links")
    if second.limit(1).count() == 0:
        return labels
    return components(first.unionByName(second))


def _crossing(lists: DataFrame, prefixed: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of one list, of different components, that may reach the threshold."""
    placed = lists.join(labels, "node", "left").select(
        "node", F.coalesce("label", "node").alias("label"), "coordinate", "value"
    )
    several = (
        placed.groupBy("coordinate", "value")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .filter("low < high")
        .select("coordinate", "value")
    )
    own = sets.select("node", "n_shingles", "bits").join(
        prefixed.select("node", F.transform("prefix", lambda p: _token(p["coordinate"], p["value"])).alias("prefix")),
        "node",
    )
    rest = placed.join(several, ["coordinate", "value"], "left_semi").join(own, "node")
    rest = stored(rest.withColumn("token", _token(F.col("coordinate"), F.col("value"))).drop("coordinate", "value"), "open-lists")
    x = rest.select("token", *[F.col(c).alias(f"x_{c}") for c in ("node", "label", "n_shingles", "bits", "prefix")])
    y = rest.select("token", *[F.col(c).alias(f"y_{c}") for c in ("node", "label", "n_shingles", "bits", "prefix")])
    c = F.col
    met = (
        (x["token"] == y["token"])
        & (c("x_node") < c("y_node"))
        & (c("x_label") != c("y_label"))
        # The smaller set can't reach the threshold if the larger one is too large.
        & (100 * F.least("x_n_shingles", "y_n_shingles") >= percent * F.greatest("x_n_shingles", "y_n_shingles"))
        & (_changed_bits(*(F.slice(c(b), 1, FIRST_BITS // 64) for b in ("x_bits", "y_bits"))) <= differ_bits(percent, FIRST_BITS))
        # Both prefixes have one order, so this is the first list they share.
        & (F.element_at(F.array_intersect(c("x_prefix"), c("y_prefix")), 1) == x["token"])
        & (_changed_bits(c("x_bits"), c("y_bits")) <= differ_bits(percent))
    )
    return x.join(y, met).select(c("x_node").alias("a"), c("y_node").alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    signed = stored(_signed(rows), "signatures")
    classes = stored(
        signed.filter("doc_id IS NOT NULL AND n_shingles > 0")
        .groupBy("key_a", "key_b")
        .agg(
            F.min("doc_id").alias("node"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
        ),
        "classes",
    )
    labels = link(rows, classes, percent)
    named = classes.select("key_a", "key_b", "node").join(labels, "node", "left").select(
        "key_a", "key_b", F.coalesce("label", "node").alias("component")
    )
    own = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), own)
    return (
        signed.drop("signature")
        .join(named, ["key_a", "key_b"], "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        )
    )


def deduplicated(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: the one with the smallest id of each group, whole.

    Of repeated rows with that id the one with the smallest text hash stays. Rows
    without id stay all.
    """
    judged = near_duplicates(docs, percent, id_col, text_col)
    gone = stored(judged.filter("NOT kept").select(F.col("doc_id").alias("gone")).distinct(), "duplicates")
    rest = docs.join(hinted(gone), docs[id_col] == gone["gone"], "left_anti")
    repeated = stored(
        judged.filter("kept AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("again")).count().filter("count > 1"),
        "repeated",
    )
    if repeated.limit(1).count() == 0:
        return rest
    # Repeated ids are rare; only their rows are compared.
    same = rest[id_col] == repeated["again"]
    single = rest.join(hinted(repeated.select("again")), same, "left_anti")
    several = rest.join(hinted(repeated.select("again")), same, "left_semi")
    whole = several.groupBy(F.col(id_col).alias("id_key")).agg(
        F.min_by(F.struct(*docs.columns), F.xxhash64(F.col(text_col))).alias("whole")
    )
    return single.unionByName(whole.select("whole.*"))
