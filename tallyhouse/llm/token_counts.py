"""Token counts at every prefix, by dynamic programming over byte-pair merges.

The encoding of a prefix ends with exactly one token ``t``, and what stands
before ``t`` is the encoding of the shorter prefix. ``t`` follows the last token
``s`` of that shorter prefix exactly if the merges leave the pair ``s t`` as it
is. So one pass over a piece finds the last token and the count at each byte
prefix, and no prefix is ever encoded again.

Pieces are what the pre-tokenizer's pattern cuts; merges never cross them.
Texts: null and empty ones have no token, repeated rows give repeated results,
columns other than the id and the text are ignored.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.base import kept, map_batches

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
CACHED = 500_000

# The pre-tokenizer's pattern (white space as Unicode defines it).
PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
CONTRACTIONS = {"'s", "'t", "'re", "'ve", "'m", "'ll", "'d"}
BLANK = regex.compile(r"\p{White_Space}+")


def _byte_letters() -> dict[str, int]:
    """The printable letter that the vocabulary file writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Counts tokens of prefixes for one byte-level vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        # Tokens are numbered by their age: the bytes first, then one token per merge.
        self.ages = {bytes([b]): b for b in range(256)}
        self.halves = [(b, b) for b in range(256)]
        self.merges: dict[tuple[int, int], int] = {}
        for pair in spec["model"]["merges"]:
            left, right = (bytes(letters[c] for c in t) for t in (pair.split(" ") if isinstance(pair, str) else pair))
            halves = (self.ages[left], self.ages[right])
            self.ages[left + right] = self.merges[halves] = len(self.halves)
            self.halves.append(halves)
        # Every beginning of a token; its token if it is one, else -1.
        self.begins = {t[:i]: -1 for t in self.ages for i in range(1, len(t))} | self.ages
        self.specials = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.cut = regex.compile("|".join(map(regex.escape, self.specials)) or r"(?!)")
        self.pairs: dict[int, bool] = {}
        self.totals: dict[str, int] = {}
        self.chunks: dict[str, int] = {}

    def _stays(self, left: int, right: int) -> bool:
        """Whether the merges of both tokens' bytes end in just this pair.

        Looks back in time: take apart the younger of the two at the border, and
        see whether a merge across the border would have come first. Of equally
        old merges the left one comes first.
        """
        a, b, before = left, right, len(self.halves)
        while True:
            if self.merges.get((a, b), before) < before:
                return False
            if a < 256 and b < 256:
                return True
            if a > b:
                before, a = a, self.halves[a][1]
            else:
                before, b = b + 1, self.halves[b][0]

    def byte_prefixes(self, piece: bytes) -> list[int]:
        """Tokens of each byte prefix of one piece, from the empty one on."""
        n = len(piece)
        token_of, pairs = self.begins.get, self.pairs
        last, counts = [-1] * (n + 1), [0] * (n + 1)
        for start in range(n):
            before = last[start]
            for end in range(start + 1, n + 1):
                token = token_of(piece[start:end])
                if token is None:
                    break
                if token < 0 or last[end] >= 0:
                    continue
                if start:
                    pair = before << 20 | token
                    stays = pairs.get(pair)
                    if stays is None:
                        stays = pairs[pair] = self._stays(before, token)
                    if not stays:
                        continue
                last[end], counts[end] = token, counts[start] + 1
        return counts

    def total(self, piece: str) -> int:
        n = self.totals.get(piece)
        if n is None:
            if len(self.totals) >= CACHED:
                self.totals.clear()
            n = self.totals[piece] = self.byte_prefixes(piece.encode())[-1]
        return n

    def _within(self, before: str, piece: str) -> list[int]:
        """Tokens that each character prefix of ``piece`` adds to those of what precedes it."""
        if piece in CONTRACTIONS:  # cut short it is an apostrophe and a letter
            counts = [*range(1, len(piece)), self.total(piece)]
        else:
            data = self.byte_prefixes(piece.encode())
            ends = np.cumsum([len(c.encode()) for c in piece])
            counts = [data[e] for e in ends]
        if before and BLANK.fullmatch(before) and BLANK.match(piece):
            # At the very end of a text a blank joins the blanks before it.
            counts[0] = self.total(before + piece[0]) - self.total(before)
        return counts

    def prefix_counts(self, text: str) -> np.ndarray:
        """Exact token count of ``text[:i]`` for every i from 0 to its length."""
        out, offset, at = [0], 0, 0
        for special in [*self.cut.finditer(text), None]:
            part = text[at : special.start() if special else len(text)]
            pieces = PIECES.findall(part)
            for before, piece in zip(["", *pieces], pieces):
                out += [offset + n for n in self._within(before, piece)]
                offset += self.total(piece)
            if special:
                mark, tail = special.group(), "".join(pieces[-2:])
                kept = offset - sum(map(self.total, pieces[-2:]))
                out += [
                    kept + sum(map(self.total, PIECES.findall(tail + mark[:i]))) for i in range(1, len(mark))
                ]
                offset += 1
                out.append(offset)
                at = special.end()
        return np.asarray(out, np.int32)

    def measure(self, text: str, limit: int) -> tuple[int, int]:
        """Tokens of a text; characters of its longest prefix within ``limit`` tokens.

        No piece reaches over a single space behind a visible character, so texts
        are summed by chunks between spaces, and a count is wanted inside one only.
        """
        chunks = text.split(" ")
        counts = None if self.cut.search(text) else self._chunk_counts(chunks)
        if counts is None:
            return self._measure_pieces(text, limit)
        total = sum(counts)
        if total <= limit:
            return total, len(text)
        sums = [0, *accumulate(counts)]
        k = max(0, bisect_left(sums, limit) - 1)
        part = (" " if k else "") + " ".join(chunks[k : k + 2])
        inner = self.prefix_counts(part)
        before = sum(map(len, chunks[:k])) + max(0, k - 1)
        return total, before + int(np.flatnonzero(inner + sums[k] <= limit)[-1])

    def _chunk_counts(self, chunks: list[str]) -> list[int] | None:
        """Tokens of each chunk with the space before it; None if a blank touches a space."""
        known = self.chunks
        if len(known) >= CACHED:
            known.clear()
        first = self._count(chunks[0])
        rest = chunks[1:]
        if chunks[0][-1:].isspace() and rest:
            return None
        for chunk in set(rest).difference(known):
            if not chunk or chunk[0].isspace() or chunk[-1].isspace():
                return None
            known[chunk] = self._count(" " + chunk)
        return [first, *map(known.__getitem__, rest)]

    def _measure_pieces(self, text: str, limit: int) -> tuple[int, int]:
        """As ``measure``, for texts with special tokens or runs of blanks."""
        total = sum(map(self._count, self.cut.split(text))) + len(self.cut.findall(text))
        if total <= limit:
            return total, len(text)
        offset, at, best = 0, 0, 0
        for special in [*self.cut.finditer(text), None]:
            part = text[at : special.start() if special else len(text)]
            pieces = PIECES.findall(part)
            sums = offset + np.concatenate([[0], np.cumsum([self.total(p) for p in pieces], dtype=np.int64)])
            starts = at + np.concatenate([[0], np.cumsum([len(p) for p in pieces], dtype=np.int64)])
            # Only the last piece that starts below the limit and the blank after it can hold the end.
            k = int(np.searchsorted(sums, limit, "right")) - 1
            best = max(best, int(starts[k])) if k >= 0 else best
            for i in (k, k + 1):
                if 0 <= i < len(pieces):
                    inner = self._within(pieces[i - 1] if i else "", pieces[i])
                    fits = [j for j, n in enumerate(inner, 1) if sums[i] + n <= limit]
                    best = max(best, int(starts[i]) + max(fits)) if fits else best
            offset = int(sums[-1])
            if special:
                mark, tail = special.group(), "".join(pieces[-2:])
                kept = offset - sum(map(self.total, pieces[-2:]))
                for i in range(1, len(mark)):
                    if kept + sum(map(self.total, PIECES.findall(tail + mark[:i]))) <= limit:
                        best = max(best, special.start() + i)
                offset += 1
                at = special.end()
                best = max(best, at) if offset <= limit else best
            if offset > limit + 16:
                break
        return total, best

    def _count(self, part: str) -> int:
        return sum(map(self.total, PIECES.findall(part)))


def counter(path: str) -> PrefixCounter:
    return kept(f"tokens {path}", lambda: PrefixCounter(path))


def token_counts(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    limit: int = LIMIT,
    prefixes: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: id, UTF-8 bytes, tokens, the longest prefix (in characters) within
    ``limit`` tokens and, with ``prefixes``, the count at every character prefix.

    ``vocabulary`` is a file name of ``public_tokenizers`` that every executor has.
    """
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long,n_bytes long,n_tokens long,prefix_chars long" + (
        ",prefix_counts array<int>" if prefixes else ""
    )

    def make():
        dp = counter(public_tokenizers.path(vocabulary))

        def work(batch: pa.RecordBatch) -> dict[str, object]:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            measured = [dp.measure(t, limit) for t in texts]
            return {
                "doc_id": batch.column("doc_id"),
                "n_bytes": [len(t.encode()) for t in texts],
                "n_tokens": [m[0] for m in measured],
                "prefix_chars": [m[1] for m in measured],
            } | ({"prefix_counts": [dp.prefix_counts(t) for t in texts]} if prefixes else {})

        return work

    return map_batches(picked, schema, make)


def tokens_at(prefix_counts: Column | str, chars: Column | int) -> Column:
    """Tokens of the first ``chars`` characters, from the stored counts."""
    column = F.col(prefix_counts) if isinstance(prefix_counts, str) else prefix_counts
    return F.element_at(column, F.lit(chars).cast("int") + 1 if isinstance(chars, int) else chars.cast("int") + 1)


def chars_within(prefix_counts: Column | str, tokens: int) -> Column:
    """Length of the longest prefix of at most ``tokens`` tokens, from the stored counts."""
    column = F.col(prefix_counts) if isinstance(prefix_counts, str) else prefix_counts
    places = F.transform(column, lambda n, i: F.when(n <= tokens, i))
    return F.array_max(places).cast("long")
