"""Base spans equal plain Python's; added ones touch none of them."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticklake.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = int(c) * (1 + place % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def spans(text):
    out = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), order, m.end(), kind))
    return sorted(out)


def joined(found):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in found)


PIECES = ["a.b@c.de", "a@b.c_d@e.f", "@x.y", "é.42@mail.example.com", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.02.3.4", "4111 1111 1111 1111",
          "4111-1111-1111-1112", "5500000000000004", "+1 (988) 555-2485", "+1 (", "++12 34 56 78 90", "12345678901234567890", "🙂", "x", " ",
          "\n", ".", "-", "0", "79927398713", "tel: 030 1234567", "@", "+", "user@host", "a" * 50]


def test_base_spans(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choices(PIECES, k=rng.randrange(0, 25))) for _ in range(300)]
    texts += ["".join(rng.choices("ab1.@+- ()", k=rng.randrange(60))) for _ in range(500)]
    texts += [None, "", "a" * 200_000, "1" * 50_000 + " " + "1.2.3.4 " * 3000, "a@b.c " * 5000, "+1" + "(" * 3000, "1 " * 40_000, ".a" * 30_000 + "@x" + ".a" * 30_000]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, base int, half string").repartition(4)
    got = {r["doc_id"]: r for r in pii.personal_data(docs).collect()}
    assert len(got) == len(texts)
    for number, text, *_ in rows:
        want, row = spans(text), got[number]
        assert row["base_sha256"] == hashlib.sha256(joined(want).encode()).hexdigest(), repr(text)[:200]
        assert [row[f"n_{k}"] for k in PLAIN] == [sum(w[3] == k for w in want) for k in PLAIN]
        every = [(int(a), list(PLAIN).index(k), int(b), k) for k, a, b in (s.split(":") for s in row["spans"].split(",") if s)]
        assert every == sorted(every) and set(want) <= set(every)
        added = [s for s in every if s not in want]
        assert len(added) == row["n_added"]
        assert not any(a[0] < w[2] and w[0] < a[2] for a in added for w in want)


def test_added_spans_come_from_positive_forms(spark):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        number = f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        rows.append((i, f"word {'+1 ' if i % 100 else '1 '}{number} word {rng.randrange(10**6)}"))
    got = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["n_phone"] == (r["doc_id"] % 100 > 0) for r in got)
    assert sum(r["n_added"] for r in got if r["doc_id"] % 100 == 0) >= 3


def test_native(spark):
    docs = spark.createDataFrame([(1, "a@b.cd 4111111111111111")], "doc_id long, text string")
    plan = pii.found_spans(docs, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_empty_and_redaction(spark):
    docs = spark.createDataFrame([(None, "to a@b.cd, +1 234 567 890!"), (1, "to a@b.cd, +1 234 567 890!")], "doc_id long, text string")
    assert pii.personal_data(docs.limit(0)).collect() == []
    marked = docs.withColumn("spans", F.lit("email:3:9,phone:11:25"))
    assert {r[0] for r in marked.select(pii.redacted(F.col("text"), F.col("spans"))).collect()} == {"to <email>, <phone>!"}
    assert len(pii.personal_data(docs).collect()) == 2


def test_trees_and_threshold():
    levels = np.array([[a, b, 0, 0, 0, 0] for a in range(4) for b in range(4)])
    n = np.full(16, 100.0)
    positives = np.where((levels[:, 0] > 1) & (levels[:, 1] <= 2), 99.0, 1.0)
    trees = pii.grown(levels, n, positives)
    margin = sum(pii._applied(t, levels) for t in trees)
    least = pii.threshold(margin, n, positives)
    assert ((margin >= least) == (positives > 50)).all()


@pytest.mark.parametrize("digits", ["79927398713", "79927398710", "0", "", "4111111111111111"])
def test_luhn(spark, digits):
    got = spark.range(1).select(pii.luhn(F.lit(digits))).first()[0]
    assert got == (digits != "" and luhn(digits))
