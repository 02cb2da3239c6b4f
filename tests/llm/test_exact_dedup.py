"""Groups of equal texts, also when hashes collide."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from ticklake.llm import exact_dedup

ROWS = [
    (5, "same"), (3, "same"), (9, "same"), (4, "Same"), (7, None), (8, ""), (1, "x" * 200_000), (2, "x" * 200_000),
    (None, "same"), (6, "same\u0000"), (3, "same"), (None, "alone"),
]


def expected(keep):
    groups = {}
    for number, text in ROWS:
        groups.setdefault(text or "", []).append(number)
    out = []
    for number, text in ROWS:
        members = groups[text or ""]
        known = [m for m in members if m is not None]
        best = (min if keep == "smallest" else max)(known) if known else None
        sha = hashlib.sha256((text or "").encode()).hexdigest()
        out.append((number, best, len(members), number == best, sha))
    return sorted(out, key=str)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("content", [exact_dedup.content_hash, lambda t: F.lit(b"all collide")])
def test_groups(spark, keep, content):
    docs = spark.createDataFrame([(*r, "clash", 1) for r in ROWS], "doc_id long, text string, h string, keep_id int")
    got = exact_dedup.exact_groups(docs, keep=keep, content=content)
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(keep)
    assert exact_dedup.exact_groups(docs.limit(0)).collect() == []


def test_native(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = exact_dedup.exact_groups(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_keep_is_checked(spark):
    with pytest.raises(ValueError):
        exact_dedup.exact_groups(spark.createDataFrame([(1, "a")], "doc_id long, text string"), keep="any")
