"""Counts equal the library's over whole texts, also for chunks that are hard to splice."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece

from ticklake.llm import token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts():
    rng = random.Random(6)
    words = ["the", "Internationalisation", "ñandú", "日本語", "🙂", "a1b2", "...", "  ", "\n", "<s>", "▁", "xqzj"]
    yield from (" ".join(rng.choices(words, k=rng.randrange(50, 900))) for _ in range(40))
    yield from ("".join(rng.choices(pool, k=4000)) for pool in ("ab", "日本語学校", "\u0001é🙂z", " \n", "0123456789", "a"))
    yield "a" * 5000 + " b" * 3000
    yield " " * 3000 + "x" + "\t" * 500 + " y " * 900
    yield from (chr(rng.randrange(32, 0xD000)) * 700 + " end" * 500 for _ in range(10))


@pytest.mark.parametrize("chunk,overlap", [(300, 40), (500, 100), (1000, 16)])
def test_chunks_equal_whole(library, chunk, overlap):
    counter = token_counts.Counter(PATH, chunk, overlap, whole=200)
    for text in texts():
        assert counter.count_long(text) == len(library.encode(text)), text[:80]


def test_stable_places_are_boundaries_everywhere(library):
    counter = token_counts.Counter(PATH)
    assert counter.stable("word next", 4) and not counter.stable("word next", 2)
    assert not counter.stable("a  b", 2)


def test_rows(spark, library):
    long = "overlap resynchronisation ñ " * 40_000
    rows = [(1, None, 7), (2, "", 7), (3, "Hello <s> world", 7), (3, "Hello <s> world", 7), (None, long, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = token_counts.count_tokens(docs, PATH).collect()
    want = [(i, len((t or "").encode()), len(library.encode(t or ""))) for i, t, _ in rows]
    assert [tuple(r)[:3] for r in got] == want
    assert [r["over_limit"] for r in got] == [n > 4096 for _, _, n in want]
    assert token_counts.count_tokens(docs.limit(0), PATH).collect() == []
