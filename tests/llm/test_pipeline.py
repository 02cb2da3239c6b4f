"""The pipeline equals its stages worked out by brute force on a small table."""

from __future__ import annotations

import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
import corpus_pipeline as pipeline
from ticklake.llm.common import plain_words

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    given = spark.read.parquet(f"{SMALL}/documents.parquet")
    first = given.filter("length(text) > 400").orderBy("doc_id").first()
    odd = [
        (None, first["text"], None, "s", 1), (90_001, None, "en", "s", 0), (90_002, "", None, "s", 0), (90_003, "12 34", "en", None, 5),
        (first["doc_id"], first["text"], "en", "s", 1), (90_004, first["text"] + " and a little more", "en", "s", 1),
    ]
    return given.union(spark.createDataFrame(odd, given.schema)).withColumn("content", F.lit("clash")).withColumn("row_key", F.lit(3))


def test_stages_like_brute_force(spark, docs):
    benchmark = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    columns = docs.columns
    kept = docs
    before = [r.asDict() for r in docs.collect()]
    for place, (name, stage) in enumerate(pipeline.STAGES[:-1]):
        kept = stage(spark, kept, SMALL)
        assert kept.columns == columns
        kept = spark.createDataFrame(kept.collect(), kept.schema)
        after = [r.asDict() for r in kept.collect()]
        assert len(after) == len({(r["doc_id"], r["text"]) for r in after}) or place == 0
        key = lambda r: (r["doc_id"], r["text"])
        if name == "language_id":
            want = {key(r) for r in before if any(c.isalpha() for c in r["text"] or "")}
            assert {key(r) for r in after} <= want and len({key(r) for r in after}) >= 0.98 * len(want)
        elif name == "exact_dedup":
            best = {}
            for r in before:
                if r["text"] not in best or best[r["text"]] is None or (r["doc_id"] is not None and r["doc_id"] < best[r["text"]]):
                    best[r["text"]] = r["doc_id"]
            assert {key(r) for r in after} == {(i, t) for t, i in best.items()}
        elif name == "near_dedup":
            component = brute.components({r["doc_id"]: r["text"] for r in before}, 5, 80)
            assert {r["doc_id"] for r in after} == set(component.values())
        else:
            grams = [tuple(plain_words(b)) for b in benchmark]
            holds = lambda t: any(" ".join(map(str, g)) in " ".join(map(str, plain_words(t))) for g in grams)
            assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before if not holds(r["text"])}
        before = after
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r["doc_id"]: (r["n_tokens"], r["ids"]) for r in pipeline.STAGES[-1][1](spark, kept, SMALL).collect()}
    want = {r["doc_id"]: library.encode(r["text"], add_special_tokens=False).ids for r in before}
    assert got == {i: (len(ids), ids) for i, ids in want.items()}


def test_empty_table(spark, docs):
    kept = docs.limit(0)
    for _, stage in pipeline.STAGES:
        kept = stage(spark, kept, SMALL)
    assert kept.collect() == []


def test_run_is_the_stages(spark):
    got = pipeline.run(spark, SMALL)
    assert got.columns == ["doc_id", "n_tokens", "ids"]
    assert 0 < got.count() < spark.read.parquet(f"{SMALL}/documents.parquet").count()


def test_every_lettered_document_has_a_language(spark, docs):
    """Also where languages tie, or are few phrases apart."""
    words = "this is one of the texts that several languages share "
    learn = [(i, words * 5, lang, "s", 1) for i, lang in enumerate(["en", "es", "fr"] * 20)]
    short = [(1000 + i, t, None, "s", 1) for i, t in enumerate(["This.", "De.", "Re.", "Edrere.", "z", "日本"])]
    blank = [(2000, "12 34", None, "s", 1), (2001, None, None, "s", 1)]
    few = spark.createDataFrame(learn + short + blank, docs.drop("content", "row_key").schema)
    for given in (few, docs):
        kept = pipeline.identify_language(spark, given, SMALL).select("doc_id", "text").collect()
        want = [(r["doc_id"], r["text"]) for r in given.collect() if any(c.isalpha() for c in r["text"] or "")]
        assert sorted(map(tuple, kept), key=str) == sorted(want, key=str)


def test_all_labelled_documents_are_learned_from(spark, docs):
    """Also those that op3 holds out, be they the only ones with a label."""
    schema = docs.drop("content", "row_key").schema
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 == 1]
    rows = [(i, "words of one language only", "en", "s", 1) for i in held[:5]] + [(held[9], "more words", None, "s", 1)]
    kept = pipeline.identify_language(spark, spark.createDataFrame(rows, schema), SMALL)
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows}
