"""Near-duplicate groups equal those of all pairs; cases that a bucket's hub cannot see."""

from __future__ import annotations

import random

import numpy as np
import pytest

import brute
from ticklake.llm import near_dedup
from ticklake.llm.components import smallest_reachable


def groups(spark, rows, words=5, similarity=80):
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string, id long, h string")
    got = near_dedup.near_duplicates(docs, words=words, similarity=similarity).collect()
    assert len(got) == len(rows)
    return got


def as_rows(texts):
    return [(i, t, "clash", 5, "clash") for i, t in texts.items()]


def words(rng, n):
    return ["".join(rng.choices("abcdefghij", k=4)) for _ in range(n)]


def test_like_all_pairs(spark):
    rng = random.Random(5)
    texts = {}
    for family in range(6):
        base = words(rng, 120)
        for copy in range(12):
            mine = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
                mine[rng.randrange(len(mine))] = "".join(rng.choices("klm", k=5))
            texts[len(texts) * 7 % 1009] = " ".join(mine)
    shared = words(rng, 90)
    for _ in range(60):  # one passage in many texts that are not alike
        texts[len(texts) + 2000] = " ".join(words(rng, 5) + shared + words(rng, 20))
    for size, similarity in ((5, 80), (3, 85)):
        want = brute.components(texts, size, similarity)
        got = groups(spark, as_rows(texts), size, similarity)
        assert {r["doc_id"]: r["component_id"] for r in got} == want
        for r in got:
            assert r["n_shingles"] == len(brute.shingle_set(texts[r["doc_id"]], size))
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_chain_through_a_member_unlike_the_hub(spark):
    rng = random.Random(9)
    base = words(rng, 300)
    texts = {0: " ".join(base)}
    for step in range(1, 9):  # each replaces ten more words: alike in steps, not end to end
        base[(step - 1) * 30 : (step - 1) * 30 + 10] = words(rng, 10)
        texts[step] = " ".join(base)
    want = brute.components(texts, 5, 80)
    assert set(want.values()) == {0}
    got = groups(spark, as_rows(texts))
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_odd_rows(spark):
    long = " ".join(words(random.Random(1), 40_000))
    rows = [
        (1, None, "x", 1, "x"), (2, "", "x", 1, "x"), (3, " \t\r\n\x0b", "x", 1, "x"),
        (4, "One two", "x", 1, "x"), (9, "one TWO ", "x", 1, "x"), (5, "one two three", "x", 1, "x"),
        (6, long, "x", 1, "x"), (7, long + " end", "x", 1, "x"), (8, "É one", "x", 1, "x"), (10, "é one", "x", 1, "x"),
        (None, long, "x", 1, "x"), (7, long + " end", "x", 1, "x"),
    ]
    got = sorted(groups(spark, rows), key=lambda r: (r["doc_id"] is None, r["doc_id"]))
    where = {r["doc_id"]: r["component_id"] for r in got}
    assert where == {1: 1, 2: 2, 3: 3, 4: 4, 9: 4, 5: 5, 6: 6, 7: 6, 8: 8, 10: 10, None: None}
    assert [r["n_shingles"] for r in got if r["doc_id"] in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert [r["kept"] for r in got if r["doc_id"] in (None, 7)] == [False, False, True]
    assert groups(spark, []) == []


def test_densification_fills_every_bin():
    sketcher = near_dedup.Sketcher(320, 6)
    few = np.array([5, 1 << 63], dtype=np.uint64)
    assert set(sketcher.signature(few).tolist()) == {5, 1 << 63}
    many = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2))
    values = sketcher.signature(many)
    bins = (values >> np.uint64(32)).astype(object) * 320 >> 32
    assert list(bins) == list(range(320))


@pytest.mark.parametrize("similarity", [80, 85, 90])
def test_rows_per_band(similarity):
    rows = near_dedup.rows_per_band(similarity)
    assert (1 - (similarity / 100) ** rows) ** (320 // rows) <= near_dedup.MISS


def test_components_of_long_chain_and_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1000, 1200)] + [(5, 5)]
    got = smallest_reachable(spark.createDataFrame(links, "a long, b long")).collect()
    want = {i: 100 for i in range(101, 161)} | {i: 7 for i in range(1000, 1200)}
    assert {r["id"]: r["component"] for r in got} == want
