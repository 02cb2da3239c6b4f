"""Segments equal a brute-force definition; held-out accuracy; degenerate labels."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from ticklake.llm import toxicity as tox


def maximal(scores):
    """Maximal scoring segments by recursion: the best one, then both sides of it."""

    def best(low, high):
        found = None
        for a in range(low, high):
            total = 0.0
            for b in range(a, high):
                total += scores[b]
                if total > 1e-12 and (found is None or total > found[0] + 1e-12):
                    found = (total, a, b)
        if found is None:
            return []
        return best(low, found[1]) + [found] + best(found[2] + 1, high)

    return best(0, len(scores))


def test_segments_like_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        scores = np.array([rng.choice([-3, -2, -1.5, -1, -0.5, 0.7, 1.1, 2.3]) + rng.random() * 1e-3 for _ in range(rng.randrange(25))])
        got, want = tox.segments(scores), maximal(scores)
        assert [(a, b) for _, a, b in got] == [(a, b) for _, a, b in want]
        assert np.allclose([g[0] for g in got], [w[0] for w in want])


def test_decay_is_the_root():
    scores, weights = np.array([-1.0, 2.0]), np.array([0.9, 0.1])
    x = tox.decay_of(scores, weights)
    assert abs((weights * np.exp(x * scores)).sum() - 1) < 1e-6 and x > 0


def made(spark):
    rng = random.Random(1)
    words = ["".join(rng.choices("aeioulnrst", k=5)) for _ in range(400)]
    rows = []
    for i in range(900):
        text = rng.choices(words, k=rng.randrange(30, 200))
        if i % 5 == 0:
            at = rng.randrange(len(text))
            text[at:at] = rng.choices(["vile", "scorn", "filth"], k=6)
        rows.append((i, " ".join(text), int(i % 5 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_planted_passages_are_found(spark):
    rows = made(spark)
    train = rows.filter("doc_id % 7 <> 0")
    model = tox.fit(rows.select("doc_id", "text"), train.select("doc_id", "toxic"))
    scored = rows.select("doc_id", "toxic", tox.score(tox.share(rows, model), F.col("text")).alias("s"), tox.passages(
        tox.share(rows, model), F.col("text")).alias("p"))
    held = scored.filter("doc_id % 7 = 0").collect()
    assert np.mean([(r["s"] >= 0.5) == bool(r["toxic"]) for r in held]) >= 0.97
    assert all(r["p"] for r in held if r["toxic"])


def test_calibration_on_clean_random_text(spark):
    """Of clean texts that no half has seen, about 1 - 1/e have a best segment above the
    threshold, as the extreme-value law has it; each half gives a calibrated model."""
    rows = made(spark)
    model = tox.fit(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))
    assert len(model.models) == 2
    rng, buckets = random.Random(9), tox.Buckets()
    words = sorted({w for r in rows.filter("toxic = 0").select("text").collect() for w in r.text.split()})
    texts = [" ".join(rng.choices(words, k=rng.randrange(30, 200))) for _ in range(300)]
    for half in model.models:
        above = [bool(half.passages(buckets.of(t))) for t in texts]
        assert 0.3 < np.mean(above) < 0.9
    codes = buckets.of(texts[0] + " vile scorn filth vile scorn filth " + texts[1])
    found = model.passages(codes)
    assert found == sorted(found) and all(a[1] < b[0] for a, b in zip(found, found[1:]))
    both = model.probability(np.array([model.evidence(codes)]))
    each = [m.probability(np.array([m.evidence(codes)])) for m in model.models]
    assert np.allclose(both, np.mean(each, axis=0))


def test_degenerate_labels_and_rows(spark):
    rows = made(spark)
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "vile " * 50_000, 1), (3, "vile", 1), (3, "vile", 1)], "doc_id long, text string, score int")
    one_class = tox.fit(rows.select("doc_id", "text"), rows.select("doc_id", F.lit(0).alias("toxic")))
    none = tox.fit(rows.select("doc_id", "text"), rows.select("doc_id", "toxic").limit(0))
    for model in (one_class, none):
        assert {r[0] for r in docs.select(tox.score(tox.share(docs, model), F.col("text"))).collect()} == {0.0}
    labels = rows.select("doc_id", "toxic").union(rows.select("doc_id", F.lit(0))).union(spark.createDataFrame([(None, 1), (5, None)], "a long, b int"))
    model = tox.fit(rows.select("doc_id", "text"), labels)
    got = [r[0] for r in docs.select(tox.score(tox.share(docs, model), F.col("text"))).collect()]
    assert all(0 <= s <= 1 for s in got) and got[0] == got[1] < 0.5 and got[3] == got[4] and got[2] > 0.5
    assert docs.limit(0).select(tox.score(tox.share(docs, model), F.col("text"))).collect() == []
