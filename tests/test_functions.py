"""Parsing, payloads and text, at their edges."""

from __future__ import annotations

import hashlib
import html
import json
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from ticklake.functions import text
from ticklake.functions.payload import decode_bytes, decode_hex, decoded_json
from ticklake.operators import parse
from ticklake.sources import snapshots
from test_quality import HASH, entry, frame, tick

SIZES = {0: "empty", 1: "small", 31: "small", 32: "medium", 255: "medium", 256: "large",
         1023: "large", 1024: "xlarge"}


def test_payload_classes(spark):
    rows = spark.createDataFrame([(n, b"x" * n) for n in SIZES], "n int, p binary")
    got = rows.select("n", parse.payload_class("p"), parse.payload_size("p")).collect()
    assert {r[0]: r[1] for r in got} == SIZES
    assert all(r[0] == r[2] for r in got)
    assert spark.range(1).select(parse.payload_class(F.lit(None).cast("binary"))).first()[0] == "empty"


PAYLOADS = {
    b"": None,
    b'FRM_v1.0:{"a": [1, "x"]}': ("protocol", '{"data":{"a":[1,"x"]},"protocol":"FRM_v1.0"}'),
    b"FRM_v1.0:{bad": (
        "protocol_error",
        '{"error":"invalid JSON in payload","protocol":"FRM_v1.0","raw_json":"{bad"}',
    ),
    b"FRM_v1.0:": (
        "protocol_error",
        '{"error":"invalid JSON in payload","protocol":"FRM_v1.0","raw_json":""}',
    ),
    b' {"b": 1}\n': ("json", '{"b":1}'),
    b"12.5": ("json", "12.5"),
    b'"word"': ("json", '"word"'),
    b"true": ("json", "true"),
    b"null": ("json", "null"),
    b"truth": ("text", '{"data":"truth","type":"text"}'),
    b"hello": ("text", '{"data":"hello","type":"text"}'),
    **{
        raw: ("text", json.dumps({"data": raw.decode(), "type": "text"}, separators=(",", ":")))
        for raw in (b"1,2", b"1,null", b"1],[2", b"01", b"[1] x", b"[1],2", b"[1", b'1},{"v":2', b"nul",
                    b"1e", b"-", b"[1],[2")
    },
    b"[[1], {}]": ("json", "[[1],{}]"),
    b"1 2": ("text", '{"data":"1 2","type":"text"}'),
    b"\xff\xfe": ("binary", '{"data":"fffe","type":"binary"}'),
}


@pytest.mark.parametrize("as_hex", [False, True])
def test_payload_decode(spark, as_hex):
    rows = spark.createDataFrame([(p,) for p in PAYLOADS], "p binary")
    decoded = decode_hex(parse.lower_hex("p")) if as_hex else decode_bytes(F.col("p"))
    got = rows.select("p", decoded["kind"], decoded_json(decoded)).collect()
    expected = {p: (e or (None, None)) for p, e in PAYLOADS.items()}
    assert {bytes(r[0]): (r[1], r[2]) for r in got} == expected


def test_bad_hex(spark):
    for raw in ("abc", "zz", "ab\n"):
        decoded = decode_hex(F.lit(raw))
        row = spark.range(1).select(decoded["kind"], decoded_json(decoded)).first()
        assert row[0] == "invalid_hex"
        assert json.loads(row[1]) == {"error": "invalid hex encoding", "raw": raw}


def test_transaction_hash_fallback(spark):
    ticks = frame(spark, [tick(transactions=[entry(tx_hash=""), entry(2), entry(3, body=None), None])])
    rows = {r.sequence_number: r.tx_hash for r in parse.explode_transactions(ticks).collect()}
    one = entry()["transaction"]
    text_ = f"id_1_{one['timestamp']}_{b'test_payload_data'.hex()}"
    assert rows == {1: hashlib.sha256(text_.encode()).hexdigest(), 2: HASH}
    flat = parse.flatten_ticks(ticks).first()
    assert flat.tx_count == 4


def test_absent_proof_and_empty_ticks(spark):
    ticks = frame(spark, [tick(1, vdf_proof=None), tick(2, transactions=[]),
                          tick(3, transactions=None), tick(4, transactions=[entry(body=None)])])
    flat = {r.tick_number: r for r in parse.flatten_ticks(ticks).collect()}
    assert (flat[1].vdf_input, flat[1].vdf_iterations, flat[3].tx_count) == ("", 0, 0)
    stored = parse.tick_rows(ticks, F.current_timestamp()).collect()
    assert [(r.tick_number, r.vdf_input, r.version) for r in stored] == [(1, None, 1)]
    read = parse.read_defaults(parse.tick_rows(ticks, F.current_timestamp())).first()
    assert (read.vdf_input, read.vdf_iterations) == ("", 0)


def sanitize(value: str, max_bytes: int | None) -> str:
    """The rules of the text cleaning, spelled out with Python's own library."""
    value = value.strip(text.WHITE_SPACE)
    if max_bytes is not None and len(value.encode()) > max_bytes:
        data = value.encode()[:max_bytes]
        torn = 0
        while True:
            try:
                value = data[: len(data) - torn].decode() + "�" * torn
                break
            except UnicodeDecodeError:
                torn += 1
    value = html.escape(value, quote=False).replace('"', "&#34;").replace("'", "&#39;")
    value = re.sub(text.KEYWORDS, "", value, flags=re.I)
    value = re.sub(r"<script|<iframe|javascript:|on[0-9A-Za-z_]+=", "", value, flags=re.I)
    value = re.sub(text.TRAVERSAL, "", value)
    return "".join(c for c in value if unicodedata.category(c) != "Cc" or c in "\t\n\r")


TEXTS = [
    "", "   ", "  plain 　\x85", "<script>alert('x')</script>", 'a "b" & c', "DROP table; SeLeCt",
    "selselectect", "onload=x onfoo=bar", "../../etc ..\\x %2e%2e %2E%2E", "tab\tnul\x00bell\x07del\x7f\x9fend",
    "é" * 30, "a" + "é" * 30, "漢字" * 20, "x😀" * 15,
]


@pytest.mark.parametrize("max_bytes", [None, 10, 25])
def test_sanitize(spark, max_bytes):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    got = rows.select("i", text.sanitize(F.col("t"), max_bytes)).collect()
    assert {r[0]: r[1] for r in got} == {i: sanitize(t, max_bytes) for i, t in enumerate(TEXTS)}


def test_sanitize_limit_and_variants(spark):
    row = spark.createDataFrame([("x" * 10_001, "a%00b", "y")], "a string, b string, c string").select(
        F.length(text.sanitize(F.col("a"), text.MAX_BYTES)), text.sanitize_url_param(F.col("b")),
        text.sanitize_json(F.col("c")),
    ).first()
    assert tuple(row) == (10_000, "ab", "y")
    whole = spark.createDataFrame([("x" * 10_001,)], "a string").select(text.sanitize(F.col("a"))).first()[0]
    assert len(whole) == 10_001


def test_submissions(spark):
    good = ("t", b"p", "AbCd", "Key", 1, "18")
    bad = [("", b"p", "ab", "K", 1, "1"), ("t", None, "ab", "K", 1, "1"), ("t", b"p", "ab", "K", 0, "1"),
           ("t", b"p", "abc", "K", 1, "x"), ("t", b"p", "ab", "K", 1, "+5"),
           ("t", b"p", "ab", "K", 1, str(2**63))]
    rows = spark.createDataFrame(
        [(i, *r) for i, r in enumerate([good, *bad])],
        "idx int, tx_id string, payload binary, signature string, public_key string, nonce bigint, "
        "timestamp string",
    )
    accepted, rejected = parse.split_submissions(rows)
    row = accepted.collect()
    assert len(row) == 1 and bytes(row[0].signature) == b"\xab\xcd" and row[0].timestamp == 18
    assert bytes(row[0].public_key) == b"Key"
    missing, hexadecimal, time = "missing required field", "invalid signature hex", "invalid timestamp"
    assert {r.idx: r.reason for r in rejected.collect()} == dict(
        enumerate([missing, missing, missing, hexadecimal, time, time], start=1)
    )


def test_snapshots(spark):
    body = json.dumps([
        {"uuid": "a", "kind": "perp", "perp_state": {"mark_price": 1.5, "mark_price_timestamp": 60}},
        {"uuid": "b", "kind": "perp", "perp_state": {"mark_price": 2.5}},
        {"uuid": "c", "kind": "spot", "perp_state": {"mark_price": 3.5}},
        {"uuid": "d", "kind": "perp"}, {"uuid": "e", "kind": "perp", "perp_state": {}},
    ])
    polls = spark.createDataFrame([(7, body), (8, "not json")], "s bigint, body string").select(
        F.timestamp_seconds("s").alias("poll_time"), "body"
    )
    got = snapshots.perp_prices(snapshots.explode_markets(polls))
    rows = got.select("market_id", F.unix_seconds("ts"), "price").collect()
    assert {tuple(r) for r in rows} == {("a", 60, 1.5), ("b", 7, 2.5)}


def test_keywords_are_those_of_the_plain_list(spark):
    """Grouped by first letters, they match the same places; few letters begin any."""
    plain = (
        "union select insert update delete drop create alter exec execute script javascript onload "
        "onerror onclick"
    ).split()
    texts = [
        before + case(word) + after
        for word in [*plain, "<script", "<iframe", "javascript:", "onx=", "unions", "sele", "scrip"]
        for case in (str.upper, str.title, lambda w: w.replace("s", "ſ").replace("i", "ı"))
        for before, after in [("", ""), ("o", "e"), (word[:2], word[2:])]
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    old = F.regexp_replace("text", f"(?iu)({'|'.join(plain)})", "")
    old = F.regexp_replace(old, r"(?iu)(<script|<iframe|javascript:|on\w+=)", "")
    new = F.regexp_replace("text", f"(?iu)({text.KEYWORDS})", "")
    new = F.regexp_replace(new, f"(?iu)({text.MARKUP})", "")
    assert rows.filter(old != new).count() == 0
    assert text.KEYWORDS.startswith("(?=[") and text.MARKUP.startswith("(?=[")
