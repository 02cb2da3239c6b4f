"""Archives give back every payload; damaged ones give back all but the damage."""

from __future__ import annotations

import gzip
import hashlib
import random

import pytest

from ticklake.llm import warc

DATE = "2020-01-01T00:00:00Z"


def made(count, compress, rng):
    pieces = []
    for number in range(count):
        payload = rng.randbytes(rng.randrange(0, 3000)) + rng.choice([b"", warc.GZIP, b"\r\n\r\nWARC/1.1\r\n", b"x" * 500])
        data = warc.record(number, f"http://a/{number} ü", payload, hashlib.sha256(payload).hexdigest(), None, DATE)
        pieces.append((number, payload, (warc.member(data) + warc.EMPTY_MEMBER) if compress else data))
    return pieces


def check_whole(data, found):
    at = 0
    for f in sorted({(f.offset, f.length) for f in found}):
        assert f[0] >= at
        at = f[0] + f[1]
    assert at <= len(data)


@pytest.mark.parametrize("compress", [True, False])
def test_damage_costs_only_what_it_hits(compress):
    rng = random.Random(11 + compress)
    for _ in range(40):
        pieces = made(12, compress, rng)
        hit = rng.randrange(12)
        bad = bytearray(pieces[hit][2])
        kind = rng.choice(["flip", "cut", "insert", "header"])
        if kind == "flip":
            for _ in range(5):
                bad[rng.randrange(3, len(bad) - 40)] ^= 0xFF
        elif kind == "cut":
            bad = bad[: rng.randrange(1, len(bad) - 30)]
        elif kind == "insert":
            bad = bytearray(rng.randbytes(50)) + bad
        else:
            bad[0:4] = b"\0\0\0\0"
        data = b"".join(bytes(bad) if n == hit else p for n, _, p in pieces)
        found = list(warc.salvaged(data))
        good = {int(f.fields["row-id"]): f.payload for f in found if f.reason is None}
        want = {n: p for n, p, _ in pieces}
        assert all(good.get(n) == want[n] for n in want if n != hit), kind
        if kind == "insert":
            assert good[hit] == want[hit]
        assert any(f.reason for f in found) or good.get(hit) == want[hit]
        check_whole(data, found)


def test_mixed_members_and_plain_records():
    rng = random.Random(1)
    a, b = made(3, True, rng), made(3, False, rng)
    data = a[0][2] + b[0][2] + a[1][2] + b"junk WARC/1.0 junk" + b[1][2]
    found = list(warc.salvaged(data))
    assert [f.payload for f in found if not f.reason] == [a[0][1], b[0][1], a[1][1], b[1][1]]
    assert [f.length for f in found if f.reason] == [18]


def expected(rows):
    groups = {}
    for number, _, html in rows:
        data = (html or "").encode()
        if len(data) >= warc.SMALLEST and number is not None:
            groups[data] = min(number, groups.get(data, number))
    out = []
    for number, _, html in rows:
        data = (html or "").encode()
        first = groups.get(data)
        revisit = first is not None and number != first
        out.append((number, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("compress", [True, False])
def test_archives(spark, tmp_path, compress):
    same = "<p>\r\n\r\nWARC/1.1\r\nñ</p>" * 20
    rows = [(i, f"http://x/{i}", f"<html>{i}</html>" * (i % 9)) for i in range(60)]
    rows += [(100 + i, None, same) for i in range(30)] + [(70, "u\r\nX: y", None), (71, "u", ""), (None, "u", same)]
    rows += [(72, "u", "short"), (73, "u", "short"), (80, "u", "long " * 100_000), (100, None, same)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, id int")
    folder = f"file://{tmp_path}/w"
    warc.archive(pages.repartition(3), folder, compress=compress)
    read = warc.read(spark, folder)
    got = read.filter("reason IS NULL").select("row_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows)
    assert read.filter("reason IS NOT NULL").count() == 0
    payloads = {r["row_id"]: bytes(r["payload"]) for r in read.filter("record_type = 'response'").collect()}
    assert payloads[80] == b"long " * 100_000 and payloads[100] == same.encode()
    raw = b"".join(p.read_bytes() for p in sorted(tmp_path.glob("w/part-*")))
    plain = gzip.decompress(raw) if compress else raw
    assert plain.count(b"WARC-Record-ID:") == len(rows) and plain.endswith(b"\r\n\r\n")
    assert warc.archive_and_read(pages.limit(0)).collect() == []


@pytest.mark.parametrize("compress", [True, False])
def test_long_urls(spark, tmp_path, compress):
    urls = {1: "data:text/html," + "x" * 300_000, 2: "http://x/" + "ü " * 200_000, 3: "http://x/" + "y" * 65_536 + " WARC/1.1", 4: "u"}
    rows = [(i, u, f"<p>{i}</p>" * 30) for i, u in urls.items()]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = f"file://{tmp_path}/w"
    warc.archive(pages.coalesce(1), folder, compress=compress)
    got = warc.read(spark, folder).collect()
    assert not [r["reason"] for r in got if r["reason"]]
    assert {r["row_id"]: r["target"] for r in got} == {i: u.replace(" ", "%20") for i, u in urls.items()}


def test_header_ends_before_the_next_version_line():
    whole = warc.record(5, "u", b"x" * 200, hashlib.sha256(b"x" * 200).hexdigest(), None, DATE)
    cut = whole[: whole.index(b"Content-Type")]
    found = list(warc.salvaged(cut + whole))
    assert [(f.offset, f.reason) for f in found] == [(0, "the header has no end"), (len(cut), None)]


def test_ids_of_all_64_bits(spark):
    ids = [-(1 << 63), -(10**18), 10**18, (1 << 63) - 1]
    rows = [(i, "u", f"<p>{i}</p>" * 30) for i in ids] + [((1 << 63) - 2, "u", f"<p>{ids[0]}</p>" * 30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {(r["row_id"], r["refers_to"]) for r in warc.archive_and_read(pages).collect()}
    assert got == {(i, None) for i in ids} | {((1 << 63) - 2, ids[0])}
    assert warc._long(str(1 << 63)) is None and warc._long(str(-(1 << 63) - 1)) is None
