"""Fuzzy search for short license notices.

A notice with at most ``k`` edits, cut into ``k + 1`` pieces, leaves at least one
piece whole. So the pieces are searched as exact seeds; around each seed the
``regex`` library's bounded-error matching verifies the notice and counts the
edits. Words that tell licenses apart (a name, a version) allow no edit.

Texts are compared as lower-cased words joined by single spaces. Null and empty
texts have no words and no label; a text is searched whole, however long.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.base import map_batches

# ASCII other than digits and lower-case letters parts words; other bytes stay.
_TO_WORDS = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else 32 for b in range(256))


@dataclass(frozen=True)
class Notice:
    """``parts``: pieces of text; those in upper case must stand exactly."""

    label: str
    parts: tuple[str, ...]
    edits: int

    @property
    def text(self) -> str:
        return "".join(self.parts).lower()


# The first three are also the base phrases, counted where they stand word for word.
NOTICES = (
    Notice("mit", ("under the ", "MIT", " license"), 2),
    Notice("apache-2", ("apache license version ", "2"), 2),
    Notice("cc-by-nc", ("CC BY NC",), 0),
    Notice("cc-by-nc", ("creative commons attribution noncommercial",), 3),
    Notice("cc-by-nc", ("creative commons attribution non commercial",), 3),
    Notice("mit", ("permission is hereby granted free of charge to any person",), 4),
    Notice("bsd", ("redistribution and use in source and binary forms",), 4),
    Notice("gpl", ("gnu general public license",), 2),
    Notice("mpl-2", ("mozilla public license version ", "2"), 2),
)
BASE = NOTICES[:3]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(_TO_WORDS).split()


def seeds(notice: Notice) -> list[str]:
    """``edits + 1`` pieces of near equal length that together make the notice."""
    text, n = notice.text, notice.edits + 1
    cuts = [len(text) * i // n for i in range(n + 1)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=64)
def _pattern(notice: Notice) -> regex.Pattern:
    body = "".join(
        f"(?:{regex.escape(p.lower())})"
        + (f"{{e<={notice.edits}}}" if notice.edits and p != p.upper() else "")
        for p in notice.parts
    )
    return regex.compile(rf"(?b)(?<![^ ])(?:{body})(?![^ ])")


def find_notice(joined: str, notice: Notice) -> list[tuple[int, int, int]]:
    """(start, end, edits) of the notice in words joined by spaces, non-overlapping."""
    length, k = len(notice.text), notice.edits
    areas: list[list[int]] = []
    for piece in seeds(notice):
        at = joined.find(piece)
        while at >= 0:
            areas.append([max(0, at - length - k), min(len(joined), at + length + k)])
            at = joined.find(piece, at + 1)
    found: list[tuple[int, int, int]] = []
    merged: list[list[int]] = []
    for lo, hi in sorted(areas):
        if merged and lo <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi])
    while merged:
        lo, hi = merged.pop()
        while hi < len(joined) and joined[hi] != " ":  # a word cut in two would seem to end there
            hi += 1
        m = _pattern(notice).search(joined, lo, hi)
        if m is None or (edits := sum(m.fuzzy_counts)) > k:
            continue
        found.append((m.start(), m.end(), edits))
        # The best match of an area parts it; worse ones stand on either side.
        merged += [[a, b] for a, b in ((lo, m.start() - 1), (m.end(), hi)) if b - a >= length - k]
    return sorted(found)


def exact_places(joined: str, phrase: str) -> list[int]:
    """Starts of a phrase as whole consecutive words; places may overlap."""
    framed, want, out = f" {joined} ", f" {phrase} ", []
    at = framed.find(want)
    while at >= 0:
        out.append(at)
        at = framed.find(want, at + 1)
    return out


def scan(text: str | None, notices: tuple[Notice, ...] = NOTICES, base: tuple[Notice, ...] = BASE) -> dict:
    """Words, base places and all matches (label, first word, end word, edits, score) of a text."""
    words = words_of(text)
    joined = b" ".join(words).decode()
    places = [(n.label, p, n.text) for n in base for p in exact_places(joined, n.text)]
    fuzzy = [(n, m) for n in notices for m in find_notice(joined, n)]
    starts: list[int] = []
    if places or fuzzy:
        at = 0
        for w in words:
            starts.append(at)
            at += len(w.decode()) + 1
    word_at = lambda char: bisect_right(starts, char) - 1
    matches = {(label, word_at(p), word_at(p) + len(t.split()), 0, 1.0) for label, p, t in places}
    for notice, (start, end, edits) in fuzzy:
        row = (notice.label, word_at(start), word_at(end - 1) + 1, edits, 1 - edits / len(notice.text))
        if edits or row[:3] not in {m[:3] for m in matches}:
            matches.add(row)
    return {
        "n_words": len(words),
        "base": sorted((word_at(p), label) for label, p, _ in places),
        "matches": sorted(matches, key=lambda m: (m[1], m[2], m[0])),
    }


MATCHES = "array<struct<label:string,first_word:long,end_word:long,edits:int,score:double>>"


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base counts, labels, best score and the spans of all matches.

    ``matches`` has the notices' word spans (end exclusive), edits and score, which
    is 1 less the share of edited characters. Repeated rows give repeated results.
    """
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = (
        "doc_id long,n_words long,n_base long,first_word long,last_word long,base_labels string,"
        "labels string,score double,labels_of array<string>,firsts array<long>,ends array<long>,"
        "edits array<int>,scores array<string>"
    )

    def make():
        def work(batch: pa.RecordBatch) -> dict[str, object]:
            out = [scan(t) for t in batch.column("text").to_pylist()]
            base, found = [s["base"] for s in out], [s["matches"] for s in out]
            return {
                "doc_id": batch.column("doc_id"),
                "n_words": [s["n_words"] for s in out],
                "n_base": [len(b) for b in base],
                "first_word": [b[0][0] if b else None for b in base],
                "last_word": [b[-1][0] if b else None for b in base],
                "base_labels": [",".join(sorted({x for _, x in b})) for b in base],
                "labels": [
                    ",".join(sorted({m[0] for m in f} | {x for _, x in b})) for b, f in zip(base, found)
                ],
                "score": [max((m[4] for m in f), default=0.0) for f in found],
                "labels_of": [[m[0] for m in f] for f in found],
                "firsts": [[m[1] for m in f] for f in found],
                "ends": [[m[2] for m in f] for f in found],
                "edits": [[m[3] for m in f] for f in found],
                "scores": [[str(m[4]) for m in f] for f in found],
            }

        return work

    flat = map_batches(picked, schema, make)
    spans = F.arrays_zip("labels_of", "firsts", "ends", "edits", F.transform("scores", lambda s: s.cast("double")))
    return flat.select(
        *flat.columns[: flat.columns.index("labels_of")], spans.cast(MATCHES).alias("matches")
    )
