"""Forced-boundary BPE equals the library on words, junk and odd characters."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ticklake.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def pair():
    return bpe.ForcedBpe(PATH), Tokenizer.from_file(PATH)


ODD = [
    "", " ", "Hello, WORLD!! it's 42nd", "naïve café ÉCOLE é", "ΑΣ ΣΑΣ ς", "İstanbul ǅ",
    "日本語 テキスト 한국어", "a b c\x1cd\x1fe\x85f", "<|endoftext|>", "x<|endoftext|>y<|startoftext|> z",
    "<|endoftext", "don't we'll I'M they'Ve 'sssss", "🙂🙃 👩‍👩‍👧 zz", "\x00\x01﻿", "___a_b", "½²٣ⅷ",
    "́́x", "ﬁ ſ K Å", "=" * 500, "ab" * 3000, "é" * 700, "\n\n\t a \r\n b",
]


def test_odd_texts(pair):
    ours, library = pair
    for text in ODD:
        want = library.encode(text, add_special_tokens=False).ids
        assert ours.encode_ids(text) == want, text
        assert ours.decode(want) == library.decode(want, skip_special_tokens=False)


def test_random_texts(pair):
    ours, library = pair
    rng = random.Random(7)
    pools = ["abcdefgh '", "thesandion ", "éàüßñóí abc", "09.,!?- ab", "日本αβγΣ x", "".join(map(chr, range(1, 0x250)))]
    texts = ["".join(rng.choices(rng.choice(pools), k=rng.randrange(1, 200))) for _ in range(1500)]
    texts += ["".join(chr(rng.choice([rng.randrange(1, 0xD800), rng.randrange(0xE000, 0x1F700)])) for _ in range(40))
              for _ in range(200)]
    want = library.encode_batch(texts, add_special_tokens=False)
    for text, (ids, decoded), w in zip(texts, ours.encode(texts), want):
        assert [int(i) for i in ids.split()] == w.ids, repr(text)
        assert decoded == library.decode(w.ids, skip_special_tokens=False)


def test_cuts_are_certain(pair):
    ours, _ = pair
    rng = random.Random(3)
    cut = 0
    for _ in range(300):
        word = "".join(rng.choices("qzxjkvwthe", k=20))
        symbols, _, begins = ours.cut([word])
        whole = ours._merge_long(symbols).tolist()
        parts = [s for f in np.split(symbols, begins[1:]) for s in ours._merge_long(f).tolist()]
        assert whole == parts
        cut += len(begins) > 1
    assert cut > 50


def test_columns(spark):
    rows = spark.createDataFrame(
        [(1, None, "x"), (2, "", "y"), (2, "The cat.", "y"), (None, "The cat.", "z")],
        "doc_id long, text string, n_tokens string",
    )
    got = bpe.encode_documents(rows, PATH).collect()
    assert [r["n_tokens"] for r in got] == [0, 0, 3, 3]
    assert got[2]["ids_sha256"] == got[3]["ids_sha256"]
    ids = rows.select(bpe.encoded(F.col("text"), PATH).alias("ids"))
    back = [r[0] for r in ids.select(bpe.decoded(F.col("ids"), PATH)).collect()]
    assert back == ["", "", "the</w> cat</w> .</w>", "the</w> cat</w> .</w>"]
    assert bpe.encode_documents(rows.limit(0), PATH).collect() == []
