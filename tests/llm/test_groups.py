from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.conftest import ODD
from tallyhouse.llm import near_duplicates, quality

RNG = random.Random(11)


def sentence(n: int) -> list[str]:
    return ["".join(RNG.choice("abcdefgh") for _ in range(RNG.randint(2, 6))) for _ in range(n)]


def shingles(text: str | None) -> frozenset:
    w = (text or "").encode().lower().split()
    n = min(5, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if n else frozenset()


def brute_components(rows: list[tuple[int | None, str | None]]) -> dict[int, int]:
    named = [(i, shingles(t)) for i, t in rows if i is not None]
    label = {i: i for i, _ in named}
    links = [
        (i, j)
        for a, (i, x) in enumerate(named)
        for j, y in named[a + 1 :]
        if x and y and 100 * len(x & y) >= 85 * len(x | y)
    ]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            low = min(label[i], label[j])
            if label[i] != low or label[j] != low:
                label[i] = label[j] = low
                changed = True
    return label


def corpus() -> list[tuple[int | None, str | None]]:
    rows: list[tuple[int | None, str | None]] = list(ODD)
    shared = sentence(60)
    for g in range(12):
        own = sentence(90)
        for k in range(g + 1):
            w = list(own)
            for _ in range(RNG.randint(0, 4)):
                w[RNG.randrange(len(w))] = "edit" + str(RNG.randrange(99))
            rows.append((1000 + 50 * g + k, " ".join(w)))
    # A chain: neighbours are alike, the ends are not.
    chain = sentence(120)
    for k in range(12):
        rows.append((5000 - k, " ".join(chain[k * 2 : k * 2 + 96])))
    rows += [(7000 + k, " ".join(shared + sentence(40))) for k in range(30)]
    rows += [(8000 + k, "  ".join(shared).upper()) for k in range(5)]
    return rows


def test_components_equal_brute_force(docs):
    rows = corpus()
    want = brute_components(rows)
    got = near_duplicates.near_duplicates(docs(rows).withColumn("signature", F.lit("clash"))).collect()
    assert len(got) == len(rows)
    sizes = Counter((i, len(shingles(t))) for i, t in rows)
    assert sizes == Counter((r["doc_id"], r["n_shingles"]) for r in got)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == want[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert len({want[i] for i in range(4989, 5001)}) == 1  # the chain is one component


def test_deduplicated_keeps_one_row_of_each_group(docs):
    rows = corpus()
    table = docs(rows).withColumn("gone", F.lit("own")).withColumn("node", F.col("doc_id"))
    out = near_duplicates.deduplicated(table)
    assert out.columns == table.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert sorted(str(i) for i in ids) == sorted(str(i) for i in {*brute_components(rows).values(), None})
    assert near_duplicates.deduplicated(docs([])).count() == 0
    assert near_duplicates.near_duplicates(docs([])).count() == 0


def test_limits_follow_the_threshold(docs):
    assert (near_duplicates.agree(85), near_duplicates.differ(85)) == (89, near_duplicates.SKETCH - 395)
    for percent in (70, 75, 80, 85, 90):
        p = percent / 100
        for n, least in ((128, near_duplicates.agree(percent)), (512, 512 - near_duplicates.differ(percent))):
            assert sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(least)) < 1e-5
    rows = []
    for i in range(60):
        base = [f"{i}x{j}" for j in range(104)]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(base[:93] + [f"{i}y{j}" for j in range(11)]))]
    left, right = (shingles(t) for _, t in rows[:2])
    assert 0.80 <= len(left & right) / len(left | right) < 0.85
    assert near_duplicates.deduplicated(docs(rows), percent=80).count() == 60
    assert near_duplicates.deduplicated(docs(rows)).count() == 120


def test_signature_agreement_estimates_similarity():
    left = near_duplicates.shingle_hashes(near_duplicates.words_hashed(" ".join(map(str, range(2000)))), 5)
    right = near_duplicates.shingle_hashes(near_duplicates.words_hashed(" ".join(map(str, range(150, 2000)))), 5)
    agree = np.mean(near_duplicates.signature(left) == near_duplicates.signature(right))
    assert abs(agree - len(np.intersect1d(left, right)) / len(np.union1d(left, right))) < 0.1


# --- quality ---------------------------------------------------------------------


def brute_logs(trusted: list[bytes], texts: list[bytes]) -> list[float]:
    """Modified Kneser-Ney by dictionaries of tuples."""
    n = quality.ORDER
    pad = lambda t: b"\0" * (n - 1) + t
    counts = {n: Counter(pad(t)[i : i + n] for t in trusted for i in range(len(t)))}
    for k in range(n - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    unigram = {b: (counts[1][bytes([b])] + 1) / (sum(counts[1].values()) + 256) for b in range(256)}
    steps, context = {}, {}
    for k in range(2, n + 1):
        ones = Counter(counts[k].values())
        steps[k] = quality.discount(np.array([ones[i] for i in (1, 2, 3, 4)]))
        context[k] = {}
        for g, c in counts[k].items():
            total, taken = context[k].get(g[:-1], (0, 0.0))
            context[k][g[:-1]] = (total + c, taken + steps[k][min(c, 3)])

    def p(g: bytes) -> float:
        if len(g) == 1:
            return unigram[g[0]]
        k, low = len(g), p(g[1:])
        if g[:-1] not in context[k]:
            return low
        total, taken = context[k][g[:-1]]
        c = counts[k][g]
        return (c - steps[k][min(c, 3)] + taken * low) / total

    return [sum(math.log(p(pad(t)[i : i + n])) for i in range(len(t))) for t in texts]


def test_packed_grams_round_trip():
    """Any order, both ends of the range, one n-gram and none."""
    pick = np.random.default_rng(4)
    for n in (0, 1, 2, 1000):
        high = pick.integers(0, 1 << 24, n, dtype=np.uint64) << np.uint64(16)
        grams = high | np.uint64(0x41 << 8) | pick.integers(0, 256, n, dtype=np.uint64)
        if n > 1:
            grams[:2] = [0xFFFFFF41FF, 0x0000004100]
        for some in (grams, np.unique(grams)):
            packed = quality._pack(some)
            assert len(packed) == 4 * len(some)
            assert quality._unpack(packed, 0x41).tolist() == some.tolist()


def quality_rows() -> tuple[list, list]:
    rows, labels = [], []
    for i in range(120):
        rows.append((i, " ".join(sentence(40)), "xx"))
        labels.append((i, 1 if i < 80 else 0 if i >= 118 else None))
    rows[118] = (118, "!!%% " * 60, "xx")
    rows[119] = (119, "A7 | " * 60, "xx")
    rows += [(200, "other language", "yy"), (201, "no language", None), (202, None, "xx"), (203, "", "xx")]
    rows += [(0, "a repeated id", "xx"), (204, "ab", "xx"), (204, "ab", "xx")]
    return rows, labels


@pytest.fixture(scope="module")
def scored(spark):
    rows, labels = quality_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int").withColumn("toxic", F.lit(0))
    return rows, docs, marks, quality.quality_scores(docs.withColumn("block", F.lit("clash")), marks, block_bytes=4000).collect()


def test_probabilities_equal_brute_force(spark):
    trusted = [" ".join(sentence(30)).encode() + "é".encode() for _ in range(10)]
    texts = [*trusted[:2], "zz éé 日本".encode(), b"abc abc", b"x"]
    grams, counts = quality._merge([quality.grams_of(t.decode()) for t in trusted], [np.ones(len(t), np.int64) for t in trusted])
    shards = {}
    for s, at in quality._by_shard(grams):
        shards[s] = grams[at], counts[at]
    orders = {s: quality._orders(*x) for s, x in shards.items()}
    steps = {}
    for k in range(2, quality.ORDER + 1):
        ones = Counter(int(c) for o in orders.values() for c in o[k][1])
        steps[k] = quality.discount(np.array([ones[i] for i in (1, 2, 3, 4)]))
    seen = Counter(int(g) & 255 for o in orders.values() for g in np.unique(o[2][0]))
    unigrams = np.array([(seen[b] + 1) / (sum(seen.values()) + 256) for b in range(256)])
    for text, want in zip(texts, brute_logs(trusted, texts)):
        total = 0.0
        for q in quality.grams_of(text.decode()):
            s = (int(q) >> 8) & 255
            if s in shards:
                total += math.log(quality.probabilities(np.array([q]), *shards[s], steps, unigrams)[0])
            else:
                total += math.log(unigrams[int(q) & 255])
        assert total == pytest.approx(want, rel=1e-9)


def test_quality_separates_and_defines_odd_rows(scored):
    rows, docs, marks, got = scored
    assert len(got) == len(rows)
    verdict = {(r["doc_id"], r["n_grams"]): r["accepted"] for r in got}
    assert not verdict[118, 300] and not verdict[119, 300]
    clean = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 118 and r["n_grams"] > 60]
    assert all(r["accepted"] for r in clean)
    assert {r["accepted"] for r in got if r["doc_id"] in (202, 203)} == {False}
    assert {r["accepted"] for r in got if r["doc_id"] in (200, 201)} == {True}


def test_scores_equal_brute_force(scored):
    rows, docs, marks, got = scored
    key = {r["row_key"]: r for r in got}
    with_keys = docs.withColumn("k", quality.row_key(docs, "doc_id", "text", "lang")).collect()
    good = {r["doc_id"] for r in marks.filter("quality = 1").collect()}
    own = [r for r in with_keys if r["lang"] == "xx" and r["text"]]
    fit = [r["text"].encode() for r in own if r["doc_id"] in good and r["k"] % quality.FOLDS != 0]
    held = [r["text"].encode() for r in own if r["doc_id"] in good and r["k"] % quality.FOLDS == 0]
    logs = brute_logs(fit, [r["text"].encode() for r in own])
    mean = sum(brute_logs(fit, held)) / sum(map(len, held))
    for row, log in zip(own, logs):
        n = len(row["text"].encode())
        want = math.exp(-(log + quality.PRIOR * mean) / (n + quality.PRIOR))
        assert key[row["k"]]["perplexity"] == pytest.approx(want, rel=1e-4)


def test_accepted_keeps_whole_rows(scored):
    rows, docs, marks, got = scored
    table = docs.withColumn("accepted", F.lit("own"))
    out = quality.accepted(table, marks)
    assert out.columns == table.columns
    assert out.count() == sum(r["accepted"] for r in got)
    assert quality.accepted(table, marks.limit(0)).count() == sum(1 for r in rows if r[1])
    assert quality.accepted(table.limit(0), marks).count() == 0


def rare_rows() -> tuple[list, list]:
    """A common language with good, bad and half-bad documents and a rare one with few trusted ones."""
    rng = random.Random(5)
    words = {lang: ["".join(rng.choice(letters) for _ in range(rng.randint(3, 7))) for _ in range(60)] for lang, letters in (("aa", "abcdefghij"), ("bb", "klmnopqrst"))}
    text = lambda lang: " ".join(rng.choice(words[lang]) for _ in range(60))
    mixed = lambda share: " ".join(w if rng.random() > share else "".join(rng.choice("abcdefghij") for _ in w) for w in text("aa").split())
    rows = [(i, text("aa"), "aa") for i in range(150)] + [(200 + i, mixed(0.35), "aa") for i in range(30)]
    rows += [(300 + i, text("bb"), "bb") for i in range(30)] + [(400 + i, "Z9#%& " * 50, "bb") for i in range(3)]
    labels = [(i, 1, 0) for i in range(120)] + [(200 + i, 0, 0) for i in range(20)] + [(300 + i, 1, 0) for i in range(6)]
    return rows, labels


@pytest.fixture(scope="module")
def rare(spark):
    rows, labels = rare_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return {r["doc_id"]: r for r in quality.quality_scores(docs, marks).collect()}


def test_rare_language_keeps_clean_text(rare):
    kept = [rare[i]["accepted"] for i in range(300, 330)]
    assert sum(kept) >= 29
    assert not any(rare[i]["accepted"] for i in range(400, 403))


def test_reach_parts_good_from_bad():
    cells = int(round((quality.MOST - quality.LEAST) / quality.STEP)) + 2
    good, bad = np.zeros(cells), np.zeros(cells)
    good[0], bad[-1] = 100, 5
    middle = (quality.LEAST + quality.MOST) / 2
    assert quality.reach(good, bad) == pytest.approx(middle, abs=quality.STEP)
    good[10], bad[11] = 3, 50
    assert quality.reach(good, bad) == pytest.approx(quality.LEAST + 10 * quality.STEP)


def test_toxic_text_is_not_trusted(spark):
    rows, labels = rare_rows()
    docs = spark.createDataFrame(rows[:20], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(i, 1, 1) for i in range(20)], "doc_id long, quality int, toxic int")
    got = quality.quality_scores(docs, marks).collect()
    assert all(r["accepted"] and r["highest"] is None for r in got)


def test_near_copies_below_the_threshold_stay_out_of_the_pairs(docs, monkeypatch):
    """Copies that each lost some words make no pairs of all with all; the links among them stay."""
    rng = random.Random(5)
    base = sentence(200)
    rows = []
    for i in range(60):
        own = list(base)
        for k in rng.sample(range(200), 5):
            own[k] = f"own{i}x{k}"
        rows.append((i, " ".join(own)))
    rows.append((60, rows[7][1] + " and one"))
    alike = [
        100 * len(x & y) / len(x | y)
        for (i, x), (j, y) in ((a, b) for a in enumerate(shingles(t) for _, t in rows) for b in enumerate(shingles(t) for _, t in rows))
        if i < j
    ]
    assert sum(65 <= a < 73 for a in alike) > 200
    held = []
    confirmed = near_duplicates._confirmed

    def counted(pairs, sets, percent):
        held.append(pairs.count())
        return confirmed(pairs, sets, percent)

    monkeypatch.setattr(near_duplicates, "_confirmed", counted)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates.near_duplicates(docs(rows), 80).collect()}
    links = sum(a >= 80 for a in alike)
    assert links == 1 and got == {i: 7 if i == 60 else i for i in range(61)}
    assert held[1] <= sum(a >= 72 for a in alike), (held, len(alike))


def test_bits_estimate_similarity():
    left = near_duplicates.shingle_hashes(near_duplicates.words_hashed(" ".join(map(str, range(2000)))), 5)
    right = near_duplicates.shingle_hashes(near_duplicates.words_hashed(" ".join(map(str, range(200, 2200)))), 5)
    same = len(np.intersect1d(left, right)) / len(np.union1d(left, right))
    changed = (near_duplicates.bits(left) ^ near_duplicates.bits(right)).view(np.uint64)
    differing = sum(int(v).bit_count() for v in changed)
    assert abs(1 - 2 * differing / near_duplicates.BITS - same) < 0.06
    for percent in (70, 75, 80, 85, 90):
        p = (1 - percent / 100) / 2
        for n in (near_duplicates.FIRST_BITS, near_duplicates.BITS):
            most = near_duplicates.differ_bits(percent, n)
            spread = (most - n * p) / math.sqrt(n * p * (1 - p))
            assert 4.9 <= spread < 5.1
