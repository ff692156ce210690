from __future__ import annotations

import random
import sys
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.conftest import ODD
from tallyhouse.llm import pieces, token_counts

PARTS = ["a", "b", "'", "ll", "re", " ", "  ", "\n", "\t", "<|endoftext|>", "<|", "12", "é", "日本", "...", "The", " the"]
PARTS += ["\x1c", "\x85", "\x00", "🎉", "ﷺ", "<s>", "<0x41>", "\r\n"]


def samples(n: int) -> list[str]:
    rng = random.Random(5)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))


def size(library, text: str) -> int:
    return len(library.encode(text, add_special_tokens=False).ids)


def test_every_prefix_count_equals_the_library(library):
    dp = token_counts.PrefixCounter(public_tokenizers.path(token_counts.VOCABULARY))
    for text in samples(150):
        want = [size(library, text[:i]) for i in range(len(text) + 1)]
        assert list(dp.prefix_counts(text)) == want, text
        for limit in (0, 1, 3, 7):
            longest = max(i for i, n in enumerate(want) if n <= limit)
            assert dp.measure(text, limit) == (want[-1], longest), (text, limit)


def test_token_counts_of_odd_rows(spark, odd, library):
    got = sorted(token_counts.token_counts(odd, limit=1024).collect(), key=str)
    want = sorted(
        ((i, len((t or "").encode()), size(library, t or "")) for i, t in ODD), key=lambda r: str(r[0])
    )
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == sorted((str(r[0]), r[1], r[2]) for r in want)
    assert token_counts.token_counts(odd.limit(0)).count() == 0


def test_stored_prefixes_answer_budgets(docs, library):
    text = "The quick brown fox, isn't it?"
    row = token_counts.token_counts(docs([(1, text)]), prefixes=True)
    got = row.select(
        token_counts.tokens_at("prefix_counts", 9).alias("n"), token_counts.chars_within("prefix_counts", 3).alias("c")
    ).first()
    assert got["n"] == size(library, text[:9])
    assert got["c"] == max(i for i in range(len(text) + 1) if size(library, text[:i]) <= 3)


def test_pieces_equal_the_library_and_round_trip():
    model = public_tokenizers.path(pieces.MODEL)
    coder, library = pieces.PieceCoder(model), sentencepiece.SentencePieceProcessor(model_file=model)
    texts = samples(400) + [f"{pieces.MARK} a{pieces.MARK}b ", "x" * 5000]
    got = coder.encode(texts)
    assert got == library.encode(texts)
    for text, ids in zip(texts, got):
        assert coder.decode(ids) == text.replace(pieces.MARK, " ")


def test_sort_keys_hold_many_characters():
    model = public_tokenizers.path(pieces.MODEL)
    coder, library = pieces.PieceCoder(model), sentencepiece.SentencePieceProcessor(model_file=model)
    seen = []
    suffixes = coder._suffixes
    coder._suffixes = lambda *args: seen.append(found := suffixes(*args)) or found
    texts = ["plain words of few letters", "".join(map(chr, range(0x4E00, 0x4E00 + 3000))), "a\0b \U0010ffff  x"]
    assert [coder.encode([t])[0] for t in texts] == [library.encode(t) for t in texts]
    plain, han, _ = (len(keys) for _, keys in seen)
    # Five bits a character, and twelve.
    assert plain <= -(-coder.longest // 12) and han <= -(-coder.longest // 5)


def test_cached_words_take_little_memory():
    model = public_tokenizers.path(pieces.MODEL)
    coder, library = pieces.PieceCoder(model), sentencepiece.SentencePieceProcessor(model_file=model)
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnop\x01日") for _ in range(12)) for _ in range(3000)]
    tracemalloc.start()
    try:
        coder._encode_words([pieces.MARK + w for w in words[:10]])
        before = tracemalloc.get_traced_memory()[0]
        held = coder._encode_words([pieces.MARK + w for w in words])
        grown = tracemalloc.get_traced_memory()[0] - before
        pairs = sys.getsizeof(coder.pairs) + 32 * len(coder.pairs)
    finally:
        tracemalloc.stop()
    want = library.encode(words)
    assert [np.frombuffer(x, np.int32).tolist() for x in held] == want
    # Four bytes an id and some fifty a word, beside what is known of pairs.
    assert grown - pairs < 4 * sum(map(len, want)) + 80 * len(words) + (1 << 18), (grown, pairs)


def test_a_large_batch_turns_the_cache_over(monkeypatch):
    model = public_tokenizers.path(pieces.MODEL)
    coder, library = pieces.PieceCoder(model), sentencepiece.SentencePieceProcessor(model_file=model)
    monkeypatch.setattr(pieces, "CACHED", 400)
    texts = [f"word{i} other{i} again{i % 7}" for i in range(1000)]
    assert coder.encode(texts) == library.encode(texts)
    assert len(coder.words) < 1000 and len(coder.earlier) < 1000


def test_pieces_of_odd_rows(odd, spark):
    rows = pieces.round_trip(odd.withColumn("pieces", F.lit("clash"))).collect()
    assert len(rows) == len(ODD) and all(r["exact"] for r in rows)
    assert {r["n_pieces"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    back = pieces.decode(pieces.encode(odd)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(i), t or "") for i, t in ODD)
    assert pieces.encode(odd.limit(0)).count() == 0
