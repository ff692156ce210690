from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.conftest import ODD
from tallyhouse.llm import quality_rules as rules

RNG = random.Random(23)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def brute_counts(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    again = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def prose(n: int, symbols: float = 0.0) -> str:
    words = ["".join(RNG.choice("etaoinshr") for _ in range(RNG.randint(2, 8))) for _ in range(n)]
    words = [w.capitalize() if RNG.random() < 0.08 else w for w in words]
    words = [w + RNG.choice(",.") if RNG.random() < 0.15 else w for w in words]
    return " ".join(w + RNG.choice(["###", "|"]) if RNG.random() < symbols else w for w in words)


@pytest.fixture(scope="module")
def rows():
    named = [(i, t, "en", "web") for i, t in ODD]
    repeated = "a b c d e\nlorem ipsum\nlorem ipsum\n \n \nx a b c d e f\vg lorem ipsum"
    named += [(100, repeated, None, "web"), (101, "a a a a a a", "en", None), (102, "ä # ö\n\nä # ö", None, None)]
    for lang, source, n in [("en", "web", 160), ("en", "news", 120), ("de", "web", 60), ("xx", "rare", 2)]:
        for k in range(n):
            named.append((len(named) + 1000, prose(RNG.randint(12, 300)), lang, source))
        named += [(9000 + len(named) + k, prose(150, 0.9), lang, source) for k in range(n // 20)]
    return named


@pytest.fixture(scope="module")
def judged(spark, rows):
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    clash = table.withColumn("x0", F.lit("a")).withColumn("whole", F.lit(1)).withColumn("a.b", F.lit(2))
    return rules.quality_rules(clash).collect()


def test_counts_equal_brute_force(rows, judged):
    want = Counter((i, *brute_counts(t)) for i, t, _, _ in rows)
    assert Counter((r["doc_id"], *(r[c] for c in COUNTS)) for r in judged) == want
    for r in judged:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def brute_distances(rows):
    """The estimates over arrays: exact quantiles, one group at a time."""
    texts = [(lang or "", source or "", (t or "").encode()) for _, t, lang, source in rows]
    counts = [rules._counts(t) for _, _, t in texts]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_punctuation", "n_capitals"]
    column = {n: np.array(c, float) for n, c in zip(names, zip(*counts))}
    n_words = column["n_words"]
    langs = np.array([x for x, _, _ in texts])

    def lowest(v, share):
        return np.sort(v)[max(int(np.ceil(share * len(v))) - 1, 0)]

    x = np.zeros((len(rows), rules.SIZE))
    for k, name in enumerate(rules.SHARES):
        for lang in set(langs):
            at = langs == lang
            usual = lowest(np.where(n_words[at] > 0, column[name][at] / np.maximum(n_words[at], 1), 0), 0.5)
            x[at, k] = np.sqrt((column[name][at] + rules.PRIOR * usual) / (n_words[at] + rules.PRIOR))
    floor = np.diag(np.square(rules.FLOORS))
    centre = np.array([lowest(v, 0.5) for v in x.T])
    wide = np.array([1.4826 * lowest(np.abs(v - c), 0.5) for v, c in zip(x.T, centre)])
    fits = {(): (centre, np.diag(wide**2) + floor)}

    def far(v, fit):
        return np.einsum("ij,jk,ik->i", v - fit[0], np.linalg.inv(fit[1]), v - fit[0])

    for depth in (0, 1, 2):
        keys = [t[:depth] for t in texts]
        groups = {g: np.array([k == g for k in keys]) for g in set(keys)}
        above = {g: fits[g[:-1]] for g in groups}
        now = {g: fits[()] if depth == 0 else above[g] for g in groups}
        for _ in range(rules.MOST_STEPS):
            moved = 0.0
            for g, at in groups.items():
                d = far(x[at], now[g])
                near = x[at][d <= lowest(d, rules.COVERAGE)]
                mean, cov = near.mean(0), np.cov(near.T, bias=True).reshape(rules.SIZE, -1) + floor
                if depth:
                    own = at.sum() / (at.sum() + rules.BACK_OFF)
                    mean = own * mean + (1 - own) * above[g][0]
                    cov = own * cov + (1 - own) * above[g][1]
                moved = max(moved, abs(np.linalg.slogdet(cov)[1] - np.linalg.slogdet(now[g][1])[1]))
                now[g] = mean, cov
            if moved <= rules.SETTLED:
                break
        fits |= now
    out = np.zeros(len(rows))
    for g, at in groups.items():
        d = far(x[at], fits[g])
        ratio = lowest(d, 0.5) / rules.chi_squared(0.0)
        out[at] = d / max(1.0, (ratio * at.sum() + rules.BACK_OFF) / (at.sum() + rules.BACK_OFF))
    return out


def test_distances_equal_brute_force(rows, judged):
    want = sorted(zip(((r[0] is None, r[0] or 0) for r in rows), brute_distances(rows)))
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["distance"]) for r in judged)
    assert np.allclose([d for _, d in got], [d for _, d in want], rtol=1e-6)
    for r in judged:
        assert r["kept"] == (not r["base_failed"] and r["distance"] <= rules.chi_squared(rules.CUTOFF))


def test_symbols_go_and_prose_stays(rows, judged):
    kept = {r["doc_id"]: r["kept"] for r in judged if (r["doc_id"] or 0) >= 1000}
    planted = {i for i, _, _, _ in rows if (i or 0) >= 9000}
    assert len(planted) > 10 and not any(kept[i] for i in planted)
    assert all(k for i, k in kept.items() if i not in planted)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert rules.quality_rules(empty).collect() == []


def test_quantiles_of_chi_squared():
    # Table values for five degrees of freedom at 0.5 and at three standard scores.
    assert rules.chi_squared(0.0) == pytest.approx(4.351, abs=0.02)
    assert rules.chi_squared(3.0) == pytest.approx(20.1, abs=0.4)
