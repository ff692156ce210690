"""SentencePiece encoding by suffix-array matching, and decoding.

The new words of a batch are concatenated and indexed by a suffix array; every
piece of the vocabulary is binary-searched for its range of suffixes, which gives
all its occurrences. Occurrences are edges from their start to their end. Edges
are relaxed in the order of their end: the encoding of a prefix ends with one
piece only, so an edge holds if its piece stays as it is behind the last piece of
the prefix it starts from, when both are merged as the model merges. Characters
without a piece become byte pieces.

No piece of the model has a space mark behind another character, so words (with
the marks before them) are encoded apart, each distinct word once per worker's
cache, which goes when the worker gets other work. Null and empty texts have no
pieces; repeated rows give repeated results; columns other than the id and the text
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.base import kept, map_batches

MODEL = "piece_bpe_32k.model"
CACHED = 100_000
PAIRS = 600_000
PART = 20_000
TEXTS = 250
MARK = "▁"
KEY_BITS = 63
POINTS = 0x110000


def _kind(n: int) -> type:
    """Integers for up to n places, as small as fits."""
    return np.int32 if n < 1 << 31 else np.int64


class PieceCoder:
    """Encodes and decodes with one byte-fallback BPE model file."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.plain = [
            i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        self.piece = {i: model.id_to_piece(i) for i in self.plain}
        self.ids = {p: i for i, p in self.piece.items()}
        self.scores = {self.piece[i]: model.get_score(i) for i in self.plain}
        # When a piece comes about: the better the score, the earlier; characters are there first.
        self.times = {p: -s if len(p) > 1 else -math.inf for p, s in self.scores.items()}
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.longest = max(map(len, self.ids))
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces with a space mark inside need whole texts")
        # What an id decodes to; space marks become spaces at the end.
        self.data = [b""] * n
        for i, p in self.piece.items():
            self.data[i] = p.replace(MARK, " ").encode()
        for b, i in enumerate(self.byte_ids):
            self.data[i] = bytes([b])
        self.lengths = np.array([len(self.piece[i]) for i in self.plain])
        self.points = np.zeros((len(self.plain), self.longest), np.int64)
        self.points[np.arange(self.longest) < self.lengths[:, None]] = [ord(c) for i in self.plain for c in self.piece[i]]
        self.halves: dict[str, tuple[str, str] | None] = {}
        self.pairs: dict[int, bool] = {}
        # Words of late and, before them, of earlier batches: what is in use stays.
        # Ids take four bytes each.
        self.words: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}

    # --- merging, for single pieces and pairs ------------------------------

    def _merged(self, text: str) -> tuple[list[str], tuple[str, str]]:
        """Best score first, leftmost first; and the two parts of the last merge."""
        parts, last = list(text), ("", "")
        while True:
            best = min(
                ((-self.scores[p], i) for i in range(len(parts) - 1) if (p := parts[i] + parts[i + 1]) in self.scores),
                default=None,
            )
            if best is None:
                return parts, last
            i = best[1]
            last = parts[i], parts[i + 1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _halves(self, piece: str) -> tuple[str, str] | None:
        """What a piece is merged from; ("", "") if never, None if its parts are not older than it."""
        found = self.halves.get(piece, False)
        if found is not False:
            return found
        if len(piece) == 1:
            out = piece, ""
        else:
            parts, last = self._merged(piece)
            out = ("", "")
            if parts == [piece]:
                whole = self._halves(last[0]), self._halves(last[1])
                older = max(map(self.times.__getitem__, last)) < self.times[piece]
                out = last if older and None not in whole else None
        self.halves[piece] = out
        return out

    def _stays(self, left: int, right: int) -> bool:
        """Whether right stands as a piece behind left (-1: at the start of a word)."""
        key = (left + 1) << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if left < 0:
                known = self._halves(self.piece[right]) != ("", "")
            else:
                known = self._apart(self.piece[left], self.piece[right])
            self.pairs[key] = known
        return known

    def _apart(self, a: str, b: str) -> bool:
        """Whether the merges of both texts end in just this pair.

        Looks back in time: take apart the younger of the two at the border, and see
        whether a merge across the border would have come first. Of merges of equal
        score the left one comes first.
        """
        halves, scores = self.halves, self.scores
        whole = halves.get(a) or self._halves(a), halves.get(b) or self._halves(b)
        if ("", "") in whole:
            return False
        if None in whole:
            return self._merged(a + b)[0] == [a, b]
        before, also = math.inf, False
        from_a, from_b = self.times[a], self.times[b]
        while True:
            score = scores.get(a + b)
            if score is not None and (-score < before or also and -score == before):
                return False
            if from_a > from_b:
                before, also, a = from_a, False, halves[a][1]
                from_a = self.times[a]
            elif from_b > -math.inf:
                before, also, b = from_b, True, halves[b][0]
                from_b = self.times[b]
            else:
                return True

    # --- suffix array and piece ranges ------------------------------------

    @staticmethod
    def _keys(codes: np.ndarray, bits: int) -> list[np.ndarray]:
        """The columns of a matrix of codes, as many to an integer as their bits allow."""
        per = KEY_BITS // bits
        keys = []
        for at in range(0, codes.shape[1], per):
            key = np.zeros(len(codes), np.int64)
            for c in range(at, at + per):
                key <<= bits
                if c < codes.shape[1]:
                    key |= codes[:, c]
            keys.append(key)
        return keys

    def _suffixes(self, codes: np.ndarray, bits: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Suffix array of the text, as deep as the longest piece, with its sort keys."""
        padded = np.concatenate([codes, np.zeros(self.longest, codes.dtype)])
        windows = np.lib.stride_tricks.sliding_window_view(padded, self.longest)[: len(codes)]
        keys = self._keys(windows, bits)
        order = np.lexsort(keys[::-1])
        return order, [k[order] for k in keys]

    @staticmethod
    def _bound(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, want: np.ndarray, right: bool) -> np.ndarray:
        """Binary search of each wanted key within its own range, all at once."""
        lo, hi = lo.copy(), hi.copy()
        while (active := lo < hi).any():
            mid = (lo + hi) >> 1
            value = keys[np.minimum(mid, len(keys) - 1)]
            below = (value <= want) if right else (value < want)
            lo = np.where(active & below, mid + 1, lo)
            hi = np.where(active & ~below, mid, hi)
        return lo

    def _edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and piece of every occurrence of every piece."""
        # The text's own characters are numbered, so that a key holds many of them.
        found = np.unique(codes)
        found = found[found > 0]
        bits = max(1, len(found).bit_length())
        number = np.zeros(POINTS, np.int32)
        number[found] = np.arange(1, len(found) + 1)
        order, keys = self._suffixes(number[codes], bits)
        points, lengths = number[self.points], self.lengths
        beyond = np.arange(self.longest) >= lengths[:, None]
        low, high = self._keys(points, bits), self._keys(np.where(beyond, (1 << bits) - 1, points), bits)
        lo = np.zeros(len(self.plain), np.int64)
        hi = np.where(((points == 0) & ~beyond).any(axis=1), 0, len(codes))
        per = KEY_BITS // bits
        for k, key in enumerate(keys):
            live = np.flatnonzero((lengths > k * per) & (lo < hi))
            first = self._bound(key, lo[live], hi[live], low[k][live], right=False)
            hi[live] = self._bound(key, lo[live], hi[live], high[k][live], right=True)
            lo[live] = first
        count = np.maximum(hi - lo, 0)
        total = int(count.sum())
        kind = _kind(max(total, len(codes) + self.longest))
        # The k-th occurrence of all is a piece's suffix at lo and as many on as it has before it.
        at = np.arange(total, dtype=kind) + np.repeat((lo - np.cumsum(count) + count).astype(kind), count)
        starts = order.astype(kind)[at]
        ends = starts + np.repeat(lengths.astype(kind), count)
        return starts, ends, np.repeat(np.asarray(self.plain, np.int32), count)

    # --- relaxation --------------------------------------------------------

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words that share no cache entry yet."""
        text = "\0".join(words)
        codes = np.frombuffer(text.encode("utf-32-le"), np.int32)
        sizes = np.array([len(w) for w in words])
        starts, ends, ids = self._edges(codes)
        begins = (np.cumsum(sizes + 1) - sizes - 1).astype(starts.dtype)
        home = np.repeat(np.arange(len(sizes), dtype=starts.dtype), sizes + 1)[starts]
        # Edges by the end's place in its word: a step relaxes one place of all words.
        # Small integers are sorted by radix.
        place = (ends - begins[home]).astype(np.min_scalar_type(int(sizes.max(initial=0))))
        order = np.argsort(place, kind="stable")
        starts, ends, ids, home, place = (x[order] for x in (starts, ends, ids, home, place))
        del order
        last = np.full(len(codes) + 1, -2, np.int32)  # -2: no piece ends here (a byte character)
        source = np.arange(-1, len(codes), dtype=starts.dtype)
        cuts = np.searchsorted(place, np.arange(1, int(sizes.max(initial=0)) + 2))
        for lo, hi in zip(cuts, cuts[1:]):
            if hi == lo:
                continue
            s, e, t = starts[lo:hi], ends[lo:hi], ids[lo:hi]
            before = np.where(s == begins[home[lo:hi]], -1, last[s])
            pairs, where = np.unique((np.maximum(before, -1).astype(np.int64) + 1) << 32 | t, return_inverse=True)
            stays = self._known(pairs.tolist())[where]
            last[e[stays]] = t[stays]
            source[e[stays]] = s[stays]
        return self._trace(text, sizes, begins, last, source)

    def _known(self, keys: list[int]) -> np.ndarray:
        found = list(map(self.pairs.get, keys))
        if None in found:
            found = [self._stays((k >> 32) - 1, k & 0xFFFFFFFF) if v is None else v for k, v in zip(keys, found)]
        return np.array(found, bool)

    def _trace(self, text: str, sizes, begins, last, source) -> list[bytes]:
        """Follow the sources back from the end of every word, all words at once."""
        words = np.flatnonzero(sizes > 0)
        at = (begins + sizes)[words]
        found = []
        while len(words):
            found.append((words, last[at], at))
            at = source[at]
            more = at > begins[words]
            words, at = words[more], at[more]
        if not found:
            return [b""] * len(sizes)
        # The last step found is a word's first piece.
        word, token, end = (np.concatenate(x) for x in zip(*found[::-1]))
        order = np.argsort(word, kind="stable")
        word, token, end = word[order], token[order], end[order]
        bounds = np.cumsum(np.bincount(word, minlength=len(sizes))).tolist()
        packed = token.astype(np.int32).tobytes()
        out = [packed[4 * lo : 4 * hi] for lo, hi in zip([0, *bounds], bounds)]
        for w in np.unique(word[token < 0]).tolist():
            own = slice(bounds[w] - len(out[w]) // 4, bounds[w])
            pairs = zip(token[own].tolist(), end[own].tolist())
            ids = chain.from_iterable((t,) if t >= 0 else (self.byte_ids[b] for b in text[e - 1].encode()) for t, e in pairs)
            out[w] = np.fromiter(ids, np.int32).tobytes()
        return out

    # --- texts ---------------------------------------------------------------

    @staticmethod
    def words_of(text: str) -> list[str]:
        """Words with the space marks before them; their concatenation is the marked text."""
        if not text:
            return []
        parts = text.replace(MARK, " ").split(" ")
        if "" not in parts:
            return [MARK + part for part in parts]
        out, marks = [], ""
        for part in parts:
            marks += MARK
            if part:
                out.append(marks + part)
                marks = ""
        return [*out, marks] if marks else out

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [ids.tolist() for ids in self.encoded(texts)]

    def encoded(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of one text after the other; texts are split twice, so that their words aren't held all at once."""
        for at in range(0, len(texts), TEXTS):
            some = texts[at : at + TEXTS]
            known = self._learned(some)
            for t in some:
                yield np.frombuffer(b"".join(map(known.__getitem__, self.words_of(t))), np.int32)

    def _learned(self, texts: list[str]) -> dict[str, bytes]:
        """The cache, with all words of these texts in it."""
        if len(self.words) >= CACHED // 2:
            self.words, self.earlier = {}, self.words
        known = self.words
        missing: set[str] = set()
        for t in texts:
            missing.update(w for w in self.words_of(t) if w not in known)
        again = missing & self.earlier.keys()
        known.update((w, self.earlier[w]) for w in again)
        new = list(missing - again)
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        for at in range(0, len(new), PART):
            part = new[at : at + PART]
            known.update(zip(part, self._encode_words(part)))
        return known

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; the mark before the first word is no space of the text."""
        text = b"".join(map(self.data.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def coder(path: str) -> PieceCoder:
    return kept(f"pieces {path}", lambda: PieceCoder(path))


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate(ids) if ids else np.zeros(0, np.int32))


def encode(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_pieces, pieces (ids)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def make():
        pieces = coder(public_tokenizers.path(model))

        def work(batch: pa.RecordBatch) -> dict[str, object]:
            ids = list(pieces.encoded([t or "" for t in batch.column("text").to_pylist()]))
            return {"doc_id": batch.column("doc_id"), "n_pieces": [len(x) for x in ids], "pieces": _lists(ids)}

        return work

    return map_batches(rows, "doc_id long,n_pieces long,pieces array<int>", make)


def decode(encoded: DataFrame, model: str = MODEL, id_col: str = "doc_id", pieces_col: str = "pieces") -> DataFrame:
    """Per row: doc_id, text. Null pieces give an empty text."""
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(pieces_col).alias("pieces"))

    def make():
        pieces = coder(public_tokenizers.path(model))

        def work(batch: pa.RecordBatch) -> dict[str, object]:
            ids = batch.column("pieces")
            return {"doc_id": batch.column("doc_id"), "text": [pieces.decode(x or []) for x in ids.to_pylist()]}

        return work

    return map_batches(rows, "doc_id long,text string", make)


def round_trip(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_pieces, pieces, and whether decoding gives the text back."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def make():
        pieces = coder(public_tokenizers.path(model))

        def work(batch: pa.RecordBatch) -> dict[str, object]:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = list(pieces.encoded(texts))
            return {
                "doc_id": batch.column("doc_id"),
                "n_pieces": [len(x) for x in ids],
                "pieces": _lists(ids),
                "exact": [pieces.decode(x.tolist()) == t for x, t in zip(ids, texts)],
            }

        return work

    return map_batches(rows, "doc_id long,n_pieces long,pieces array<int>,exact boolean", make)
