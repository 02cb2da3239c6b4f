"""Phrases equal a plain parse; held-out accuracy; many letters; rows without letters."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from ticklake.llm import language_id as li


def plain_phrases(sample: bytes, text: bytes) -> int:
    count, at = 0, 0
    while at < len(text):
        size = 0
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        at += max(1, size)
        count += 1
    return count


def learned(*samples: str) -> li.Model:
    model = li.Model()
    for place, sample in enumerate(samples):
        model.learn(f"l{place}", li.symbols(sample)[0])
    return model


def test_symbols():
    assert li.symbols("  The 2 CATS!")[0].tobytes() == b" the cats "
    assert li.symbols("Ü日🙂𐐀")[0].tobytes().decode() == "ü日 𐐨"
    assert [li.symbols(t)[1] for t in ("", "12", "́", "a", "𐐀")] == [False, False, False, True, True]


def test_phrases_like_plain_parsing():
    """Also over many pieces, and where a parse never meets one that began elsewhere."""
    rng = random.Random(3)
    samples = ["".join(rng.choices("abcd ", k=3000)), "".join(rng.choices("cdeü日", k=900)), "ab" * 3000]
    model = learned(*samples)
    texts = ["".join(rng.choices("abcdez ü", k=rng.randrange(1, 300))) for _ in range(40)] + ["", "a", "é"]
    texts += ["".join(rng.choices("abcdeü日", k=5000)), samples[0] * 2, samples[1] * 7, "ab" * 2500, "x" + "ba" * 2600, "z" * 5000]
    sequences = [li.symbols(t)[0] for t in texts]
    got = li.phrases(model, sequences)
    for row, sample in zip(got, samples):
        text = li.symbols(sample)[0].tobytes()
        assert row.tolist() == [plain_phrases(text, s.tobytes()) for s in sequences]


def test_every_edge_has_its_own_slot():
    rng = random.Random(5)
    sequence = rng.choices(range(256), k=4000) + rng.choices(range(6), k=4000)
    states, start, symbol, end = li.suffix_automaton(sequence)
    base, owner, target = li.interleaved(states, start, symbol, end)
    edges = set(zip(start.tolist(), symbol.tolist(), end.tolist()))
    slots = base[:, None] + np.arange(256)
    found = owner[slots] == np.arange(states)[:, None]
    assert {(int(a), int(c), int(target[slots[a, c]])) for a, c in np.argwhere(found)} == edges
    assert len(owner) < 2 * len(edges) + 1024


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = li.fit(docs.filter(li.learnable(docs)))
    got = li.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    right = got.filter("crc32(cast(doc_id AS string)) % 3 = 1").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.98


def test_languages_of_many_letters(spark):
    """Two languages of 1,500 letters each, of which texts of one write the same first half."""
    rng = random.Random(7)
    shared = [chr(0x4E00 + i) for i in range(1000)]
    own = {"p": [chr(0x5500 + i) for i in range(500)], "q": [chr(0x6000 + i) for i in range(500)]}
    words = {lang: ["".join(rng.choices(shared + letters, k=2)) for _ in range(400)] for lang, letters in own.items()}
    words["en"] = "the of and to in that was his with for".split()
    rows = [(i, " ".join(rng.choices(words[lang], k=40)), lang) for i, lang in enumerate(list(words) * 150)]
    model = li.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    tests = [(lang, " ".join(rng.choices(words[lang], k=5))) for lang in words for _ in range(100)]
    got = li.predict(model, [text for _, text in tests])["lang_pred"]
    assert np.mean([a == lang for a, (lang, _) in zip(got, tests)]) >= 0.98


def test_odd_rows(spark):
    learn = spark.createDataFrame(
        [(i, w * 40, l) for i in range(6) for w, l in (("der hund und die katze ", "de"), ("the dog and the cat ", "en"))]
        + [(99, "no label", None), (98, None, "en"), (97, "12 34", "xx")],
        "doc_id long, text string, lang string",
    )
    model = li.fit(learn)
    assert model.languages == ["de", "en"]
    rows = [(1, None), (2, ""), (3, "12 !!"), (4, "THE DOG"), (5, "und die"), (5, "und die"), (None, "the cat " * 50_000), (7, "🙂"), (8, "日本")]
    docs = spark.createDataFrame([(*r, "clash", 2.0) for r in rows], "doc_id long, text string, lang_pred string, score double")
    got = li.identify(docs, model).collect()
    assert [r["lang_pred"] for r in got] == ["und", "und", "und", "en", "de", "de", "en", "und", got[8]["lang_pred"]]
    assert all((r["score"] == 0) == (r["lang_pred"] == "und") and 0 <= r["score"] <= 1 for r in got)
    assert li.identify(docs.limit(0), model).collect() == []
    nothing = li.fit(learn.limit(0))
    assert {r["lang_pred"] for r in li.identify(docs, nothing).collect()} == {"und"}


def test_sample_is_bounded_and_of_whole_texts(spark):
    schema = "doc_id long, text string, lang string"
    learn = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"), F.lit("en").alias("lang"))
    whole = len(" some words")
    assert li.fit(learn, sample_docs=20).sizes == [20 * whole]
    assert li.fit(learn, sample_bytes=35).sizes == [3 * whole]
    long = spark.createDataFrame([(1, "a" * 500, "en"), (2, "b" * 300, "en"), (3, "c" * 400, "en")], schema)
    assert li.fit(long, document_bytes=100).sizes == [301]
    assert li.fit(long.union(learn.limit(1)), document_bytes=100).sizes == [whole]


def test_every_labelled_row_is_learned_from(spark, monkeypatch):
    """Words of the last of many documents, of a very long one and of each task count."""
    monkeypatch.setattr(li, "COUNTED", 5)
    schema = "doc_id long, text string, lang string"
    rows = [(i, "alpha beta", "x") for i in range(2000)] + [(i, f"Alpha w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}!", "y") for i in range(2000)]
    rows += [(5000, "gamma " * 20_000 + "日" * 40, "x"), (5001, None, "x"), (5002, "7 8", "z"), (5003, "word", None)]
    learn = spark.createDataFrame(rows, schema).repartition(7)
    counts = {(r["lang"], bytes(r["word"])): r["n"] for r in li.word_counts(learn).collect()}
    assert counts["x", b"alpha"] == counts["x", b"beta"] == counts["y", b"alpha"] == 2000 and counts["x", b"gamma"] == 20_000
    assert sum(n for (lang, word), n in counts.items() if lang == "y" and word != b"alpha") == 2000
    assert {len(word) for lang, word in counts if word[:1] >= b"\x80"} <= {li.WORD, 24}
    model = li.learn(learn)
    assert model.languages == ["x", "y"]
    got = li.predict(model, ["gamma gamma", "wzz wab", "日日日", "alpha beta", "12", None])
    assert got["lang_pred"].tolist() == ["x", "y", "x", "x", "und", "und"]
    small = li.learn(learn, model_bytes=14)
    assert 1 + len("gamma ") <= small.sizes[0] <= 1 + len("gamma alpha beta ")
    assert li.learn(learn.limit(0)).languages == []


def test_held_out_accuracy_of_all_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = li.learn(docs.filter(li.learnable(docs)))
    got = li.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    right = got.filter("crc32(cast(doc_id AS string)) % 3 = 1").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.98
