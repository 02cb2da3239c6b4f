"""Scores and ranks equal plain integer arithmetic, whatever the tiles and blocks."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ticklake.llm import ranked_search
from ticklake.llm.ranked_search import EXACT, IMPACT, exact_parts


def terms(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain(docs, items, k=10):
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    found = []
    for item in {i for i, _ in items}:
        wanted = Counter(t for text in {t for i, t in items if i == item} for t in terms(text))
        scored = []
        for doc, have in counted:
            m = 25 + (75 * sum(have.values()) * n_docs) // n_terms
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((10**9 * have[t]) // (1000 * have[t] + 8 * m))
                for t, times in wanted.items() if t in have
            )
            if score > 0:
                scored.append((-score, doc is not None, doc or 0, doc))
        found += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(found, key=str)


def made(seed=3, docs=300):
    rng = random.Random(seed)
    pool = ["the", "of", *(f"w{i}" for i in range(60)), "Ünï", "日本", "x1"]
    texts = [" ".join(rng.choices(pool, k=rng.randrange(0, 50))) for _ in range(docs)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(1000 + i, texts[5]) for i in range(40)]  # equal scores
    rows += [(5, texts[5]), (None, texts[5]), (2000, None), (2001, ""), (-7, texts[5].upper()), (3000, "the " * 5000)]
    items = [(i, " ".join(rng.choices(pool, k=rng.randrange(1, 30)))) for i in range(30)]
    items += [(40, texts[5]), (40, texts[5]), (41, "the the THE"), (41, "of"), (42, None), (43, "!"), (None, "w1 w2"), (44, "absent")]
    return rows, items


@pytest.mark.parametrize("block_terms", [500_000, 60, 1])
def test_equals_plain(spark, monkeypatch, block_terms):
    rows, items = made()
    if block_terms == 1:  # one item a block; a few are enough
        items = items[-8:]
    monkeypatch.setattr(ranked_search, "ITEMS", 7)
    monkeypatch.setattr(ranked_search, "DOCS", 16)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, score int").repartition(3)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    got = ranked_search.rank(docs, asked, block_terms=block_terms).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows, items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_search.rank(docs, items.limit(0)).collect() == []
    assert ranked_search.rank(docs.limit(0), items).collect() == []
    assert ranked_search.rank(docs.filter("false"), items.filter("false")).columns == ["item_id", "rank", "doc_id", "score"]


def test_no_tile_reaches_the_exact_range():
    worth = np.array([[9_000, 4 * 10**9, 7 * 10**9, 1], [3, 8 * 10**10, 0, 5]], dtype=np.int64)
    parts = list(exact_parts(np.arange(4), worth))
    total = np.zeros_like(worth)
    for codes, part in parts:
        assert int(part.sum(axis=1).max()) * IMPACT < EXACT
        total[:, codes] += part
    assert (total == worth).all() and len(parts) > 4
