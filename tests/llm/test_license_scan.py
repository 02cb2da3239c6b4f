"""Base places equal a plain search; notices are found whole, changed, and not when a key is missing."""

from __future__ import annotations

import random
import re

import pytest

from ticklake.llm import license_scan, queries
from ticklake.llm.license_scan import BASE, KNOWN, Index, Template

PHRASES = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_base(text):
    words = plain_words(text)
    found = sorted(
        (at, label) for label, phrase in PHRASES.items() for at in range(len(words))
        if words[at : at + len(phrase.split())] == phrase.split()
    )
    return (
        len(words), len(found), found[0][0] if found else None, found[-1][0] if found else None,
        ",".join(sorted({label for _, label in found})),
    )


def index(frequency=None, templates=BASE + KNOWN, documents=1000):
    words = {w for t in templates for part in (t.text, *t.keys) for w in license_scan.words_of(part)}
    return Index(templates, documents, {w: (frequency or {}).get(w, 0) for w in words})


def labels(found):
    return {p["label"] for p in found[1]}


@pytest.mark.parametrize("common", [{}, {b"cc": 900}, {b"by": 900}, {b"general": 999, b"public": 5, b"license": 400}])
def test_random_words_equal_plain_search(common):
    rng = random.Random(12)
    pool = ["CC", "by", "General", "public", "license", "all", "rights", "reserved", "nc", "x", "İ", "the"]
    scanner = index(common)
    for size in [0, 1, 2, 3, 7, 60, 400]:
        for _ in range(60):
            text = "".join(rng.choice(pool) + rng.choice([" ", "\n", "-", ". ", "\x00", "_"]) for _ in range(size))
            n, places = scanner.places(text)
            base = [p for p in places if p["base"]]
            starts = [p["first"] for p in base]
            got = (n, len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({p["label"] for p in base})))
            assert got == plain_base(text)


def test_phrase_across_parts_of_a_long_text():
    text = "word " * 300_000 + "all rights reserved" + " word" * 300_000 + " CC BY"
    n, places = index().places(text)
    assert [(p["label"], p["first"]) for p in places] == [("reserved", 300_000), ("cc-by", 600_003)]
    assert n == 600_005


@pytest.mark.parametrize("template", [t for t in KNOWN if t.keys])
def test_notices(template):
    scanner = index({b"the": 990, b"this": 900, b"of": 990, b"software": 60, b"license": 90})
    before, after = "Étion dans. " * 50, " the is of" * 40
    whole = scanner.places(before + template.text.upper() + after)
    assert template.label in labels(whole)
    assert max(p["score"] for p in whole[1] if p["label"] == template.label) == 1.0
    missing = template.text.lower()
    for word in license_scan.words_of(template.keys[0])[-2:]:
        missing = re.sub(rf"\b{word.decode()}\b", "zzz", missing)
    phrases = {p["label"] for p in scanner.places(missing)[1] if p["words"] <= 6}
    assert template.label not in labels(scanner.places(missing)) - phrases


def test_changed_notice_is_found_with_a_lower_score():
    notice = next(t for t in KNOWN if t.label == "mit" and t.keys)
    text = notice.text.replace("associated documentation files", "its associated manuals").replace("sublicense", "lend")
    found = [p for p in index().places("x " * 30 + text)[1] if p["label"] == "mit"]
    assert len(found) == 1 and 0.5 <= found[0]["score"] < 1 and abs(found[0]["first"] - 30) <= 3


def test_own_template_with_repeated_words():
    scanner = index(templates=(Template("echo", "a b a b a"),))
    assert [p["first"] for p in scanner.places("a b a b a b a")[1]] == [0, 2]
    with pytest.raises(ValueError):
        index(templates=(Template("none", "..."),))


def test_rows(spark):
    rows = [
        (1, None, "a"), (2, "", "a"), (3, "Licensed under CC BY-NC 4.0. All rights\nreserved", "a"),
        (3, "Licensed under CC BY-NC 4.0. All rights\nreserved", "a"), (None, "Apache License, Version 2.0", None),
        (5, "no licence here", "b"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, places string")
    got = license_scan.digest(license_scan.scan(docs)).collect()
    assert [tuple(r) for r in got] == [
        (1, 0, 0, None, None, "", "", 0.0), (2, 0, 0, None, None, "", "", 0.0),
        *[(3, 10, 2, 2, 7, "cc-by,reserved", "cc-by,cc-by-nc,reserved", 1.0)] * 2,
        (None, 5, 0, None, None, "", "apache-2.0", 1.0), (5, 3, 0, None, None, "", "", 0.0),
    ]
    assert license_scan.digest(license_scan.scan(docs.limit(0))).collect() == []
    named = docs.withColumnRenamed("doc_id", "id")
    assert license_scan.scan(named, id_col="id").columns == ["id", "n_words", "places"]


def test_query_equals_plain_search_over_all_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    got = queries.op12_license_scan(spark, sf_dir).collect()
    assert {r.doc_id: tuple(r)[1:6] for r in got} == {i: plain_base(t) for i, t in texts.items()}
    assert len(got) == len(texts)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)
