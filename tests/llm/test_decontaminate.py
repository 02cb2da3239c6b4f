"""Planted items are found, whole or in other order of some words; others are not."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticklake.llm import decontaminate as dec
from ticklake.llm.common import plain_words


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_longest_common_like_brute_force():
    rng = random.Random(2)
    for _ in range(300):
        a, b = (rng.choices(range(6), k=rng.randrange(1, 90)) for _ in range(2))
        assert dec.longest_common(a, b) == lcs(a, b)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(12)
    common = ["the", "of", "and", "to", "in"]
    rare = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(3000)]
    text = lambda n: [rng.choice(common) if rng.random() < 0.4 else rng.choice(rare) for _ in range(n)]
    items = {i: text(rng.randrange(15, 90)) for i in range(60)}
    docs, planted = {}, set()
    for d in range(400):
        words = text(rng.randrange(20, 700))
        if d % 8 == 0:
            item = rng.randrange(60)
            copy = list(items[item])
            if d % 16 == 0:  # a paraphrase: a fifth of the words changed
                for at in rng.sample(range(len(copy)), len(copy) // 5):
                    copy[at] = rng.choice(common)
            at = rng.randrange(len(words) + 1)
            words[at:at] = copy
            planted.add((d, item))
        docs[d] = " ".join(words).capitalize() + "."
    return docs, {i: " ".join(w) for i, w in items.items()}, planted


def test_planted_items(spark, corpus):
    docs, items, planted = corpus
    got = dec.contaminated(
        spark.createDataFrame([(d, t, "x", 1) for d, t in docs.items()], "doc_id long, text string, item_id string, id int"),
        spark.createDataFrame([(i, t, "x") for i, t in items.items()], "item_id long, text string, doc_id string"),
    ).collect()
    found = {(r["doc_id"], r["item_id"]) for r in got}
    assert len(found) == len(got)
    assert len(found & planted) >= 0.95 * len(planted)
    assert found <= planted
    for r in got:  # what is reported holds by brute force
        item, doc = plain_words(items[r["item_id"]]), plain_words(docs[r["doc_id"]])
        assert lcs(item, doc) >= round(r["lcs_share"] * len(item)) >= 0.6 * len(item)


def test_blocks_of_the_benchmark_give_the_same(spark, corpus, monkeypatch):
    docs, items, planted = corpus
    some = spark.createDataFrame(list(docs.items())[:100], "doc_id long, text string")
    table = spark.createDataFrame(list(items.items()), "item_id long, text string")
    monkeypatch.setattr(dec, "BLOCK_ITEMS", 25)
    found = {(r["doc_id"], r["item_id"]) for r in dec.contaminated(some, table).collect()}
    mine = {p for p in planted if p[0] < 100}
    assert found <= mine and len(found) >= 0.9 * len(mine)


def test_odd_rows(spark):
    item = "one quick zebra jumps over seven lazy wombats near quiet rivers today"
    long = "filler words " * 60_000
    rows = [(1, None), (2, ""), (3, "..."), (4, item.upper() + "!"), (5, long + item + " " + long), (None, item), (6, "other text of words"),
            (4, item), (7, "zebra")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(10, item), (11, None), (12, ""), (13, item), (14, "zebra")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in dec.contaminated(docs, items).collect()}
    assert {g for g in got if g[1] in (10, 13)} == {(d, i) for d in (4, 5, None) for i in (10, 13)}
    assert (7, 14) in got and not {g for g in got if g[0] in (1, 2, 3, 6) or g[1] in (11, 12)}
    assert dec.contaminated(docs.limit(0), items).collect() == []
    assert dec.contaminated(docs, items.limit(0)).collect() == []
    answers = items.withColumn("answer", F.lit("unseen"))
    assert dec.contaminated(docs, answers, answer_col="answer").collect() == []


def test_latent_candidates_against_brute_force(spark, corpus):
    """Recall of the cosine search: planted whole copies are all candidates and confirmed."""
    docs, items, planted = corpus
    whole = {p for p in planted if p[0] % 16}
    got = dec.contaminated(
        spark.createDataFrame([(d, docs[d]) for d, _ in whole], "doc_id long, text string"),
        spark.createDataFrame(list(items.items()), "item_id long, text string"),
    ).filter("lcs_share = 1").collect()
    assert np.mean([p in {(r["doc_id"], r["item_id"]) for r in got} for p in whole]) >= 0.98


@pytest.mark.parametrize("by_answers", [True, False])
def test_no_copy_that_the_checks_accept_is_lost(spark, by_answers):
    """More items than the rank, of lengths just above a power of two, 0 to 40 % changed."""
    rng = random.Random(31)
    words = ["".join(rng.choices("abcdefgh", k=rng.choice([2, 3, 3, 4]))) for _ in range(900)]
    text = lambda n: [words[int(len(words) * rng.random() ** 2)] for _ in range(n)]
    items = {i: text(rng.choice([17, 20, 24, 33, 36, 40, 65])) for i in range(160)}
    answers = {i: rng.sample(w, 4) for i, w in items.items()}
    docs, accepted = {}, set()
    for d in range(800):
        item, changed = d % 160, d // 160 / 10
        copy = list(items[item])
        for at in rng.sample(range(len(copy)), round(changed * len(copy))):
            copy[at] = rng.choice(words)
        around = text(rng.randrange(20, 400))
        at = rng.randrange(len(around) + 1)
        docs[d] = " ".join(around[:at] + copy + around[at:])
        held = len(set(copy) & set(answers[item])) / len(set(answers[item]))
        if lcs(items[item], copy) >= 0.6 * len(copy) and (held >= 0.6 or not by_answers):
            accepted.add((d, item))
    got = dec.contaminated(
        spark.createDataFrame(list(docs.items()), "doc_id long, text string"),
        spark.createDataFrame([(i, " ".join(w), " ".join(answers[i])) for i, w in items.items()], "item_id long, text string, answer string"),
        answer_col="answer" if by_answers else None, answers=0.6 if by_answers else 0.0,
    ).collect()
    assert len(accepted) > 600 and accepted <= {(r["doc_id"], r["item_id"]) for r in got}
    for r in got:
        item, doc = plain_words(" ".join(items[r["item_id"]])), plain_words(docs[r["doc_id"]])
        assert lcs(item, doc) >= round(r["lcs_share"] * len(item)) >= 0.6 * len(item)


def test_rarest_words_do_not_depend_on_the_block():
    """Codes follow the block's order; equally rare words are chosen by the word."""
    words = [b"delta", b"alpha", b"echo", b"bravo", b"the", b"charlie"]
    chosen = []
    for order in (words, words[::-1], sorted(words)):
        code = {word: at for at, word in enumerate(order, 1)}
        names = {at: word for word, at in code.items()}
        idf = np.zeros(len(code) + 1)
        idf[1:] = 2.0
        idf[code[b"the"]] = 0.1
        picked = dec._rarest(np.array([code[w] for w in words], dtype=np.int32), idf, names)
        chosen.append({names[c] for c in picked.tolist()})
    assert chosen == [{b"alpha", b"bravo"}] * 3
