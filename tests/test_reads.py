"""Candles and lookups at their edges."""

from __future__ import annotations

import contextlib
import io
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from ticklake.operators import candles as c
from ticklake.operators import lookup, parse
from ticklake.plans import adapters

DAY = datetime(2024, 3, 1)


def at(minutes: float) -> datetime:
    return DAY + timedelta(minutes=minutes)


def prices(spark, rows):
    df = spark.createDataFrame(rows, "market_id string, ts timestamp_ntz, price double")
    return df.withColumn("price", F.col("price").cast("decimal(18,8)"))


def shown(df, market="m"):
    rows = df.filter(F.col("market_id") == market).orderBy("t").collect()
    return [((r.t - DAY) // timedelta(minutes=1), r.o, r.h, r.l, r.c) for r in rows]


def test_gaps_first_middle_last_and_lead(spark):
    df = prices(spark, [("m", at(-0.5), 9.0), ("m", at(1), 5.0), ("m", at(1.9), 7.0),
                        ("m", at(1.5), 4.0), ("m", at(3), 2.0), ("m", at(6), 1.0),
                        ("n", at(2), 3.0)])
    got = shown(c.candles(df, "1m", at(0), at(5)))
    empty = (None,) * 4
    assert got == [(-1, 9, 9, 9, 9), (0, *empty), (1, 5, 7, 4, 7), (2, *empty), (3, 2, 2, 2, 2),
                   (4, *empty)]
    got = shown(c.candles(df, "1m", at(0), at(5), fill="locf", lead_bucket=False))
    assert got == [(0, 9, 9, 9, 9), (1, 5, 7, 4, 7), (2, 7, 7, 7, 7), (3, 2, 2, 2, 2),
                   (4, 2, 2, 2, 2)]
    got = shown(c.candles(df, "1m", at(0), at(5), fill="locf"), "n")
    assert got == [(0, *empty), (1, *empty), (2, 3, 3, 3, 3), (3, 3, 3, 3, 3), (4, 3, 3, 3, 3)]
    assert shown(c.candles(df, "1m", at(0), at(5), fill=None)) == [(1, 5, 7, 4, 7), (3, 2, 2, 2, 2)]
    only = c.candles(df, "1m", at(0), at(5), markets=["n"])
    assert {r.market_id for r in only.collect()} == {"n"}


def test_start_off_a_boundary(spark):
    """The bucket holding the start also counts earlier rows, back to start - timeframe."""
    df = prices(spark, [("m", at(-3), 8.0), ("m", at(-2), 6.0), ("m", at(1), 5.0), ("m", at(3), 4.0)])
    got = shown(c.candles(df, "5m", at(2.5), at(6)))
    assert got == [(-5, 6, 6, 6, 6), (0, 5, 5, 4, 4), (5, *(None,) * 4)]


def test_ranges_and_timeframes():
    now = at(0)
    assert c.candle_range(now) == (now - timedelta(hours=24), now)
    assert c.candle_range(now, now - timedelta(days=30)) == (now - timedelta(days=30), now)
    for bad in (dict(start=now, end=now - timedelta(1)), dict(start=now - timedelta(31))):
        with pytest.raises(ValueError):
            c.candle_range(now, **bad)
    c.candle_range(now, now - timedelta(days=400), max_span=None)
    assert c.timeframe() == timedelta(hours=1)
    with pytest.raises(ValueError):
        c.timeframe("2h")


def transactions(spark):
    rows = [  # tick, sequence, hash, minute, version, payload
        (1, 1, "a" * 64, 0, 1, b"{}"), (1, 1, "a" * 64, 5, 1, b"[]"), (1, 2, "ab%_" + "b" * 60, 1, 1, b""),
        (1, 12, "c" * 64, 1, 1, b"x"), (2, 1, "abc" + "d" * 61, 9, -1, b"x"), (2, 2, "e" * 70, 2, 1, b"x"),
    ]
    df = spark.createDataFrame(
        [(t, s, h, f"id{s}", 1, p, 0, b"k", b"s", 0, at(m), len(p), None, v) for t, s, h, m, v, p in rows],
        "tick_number bigint, sequence_number bigint, tx_hash string, tx_id string, nonce bigint, "
        "payload binary, timestamp_us bigint, public_key binary, signature binary, "
        "ingestion_timestamp bigint, processed_at timestamp_ntz, payload_size int, "
        "payload_type string, version int",
    )
    return df


def ticks(spark):
    return spark.createDataFrame(
        [(n, n, None, None, None, None, None, None, 1, at(m), v)
         for n, m, v in [(1, 0, 1), (1, 3, 1), (1, 9, -1), (2, 4, 1), (3, 4, 1), (9, 1, -1)]],
        "tick_number bigint, timestamp_us bigint, vdf_input string, vdf_output string, "
        "vdf_proof string, vdf_iterations bigint, transaction_batch_hash string, "
        "previous_output string, tx_count int, processed_at timestamp_ntz, version int",
    )


def test_tick_documents(spark):
    df = lookup.tick_documents(ticks(spark), transactions(spark), document_rows=10)
    got = {(r.tick_number, r.part): [(t.sequence_number, t.payload_decoded) for t in r.transactions]
           for r in df.collect()}
    text = '{"data":"x","type":"text"}'
    assert got == {(1, 0): [(1, "[]"), (2, None)], (1, 1): [(12, text)], (2, 0): [(2, text)], (3, 0): []}
    one = lookup.tick_documents(ticks(spark), transactions(spark), numbers=[3]).collect()
    assert [(r.tick_number, r.vdf_input, r.vdf_iterations, r.transactions) for r in one] == [(3, "", 0, [])]
    flat = lookup.tick_transactions(ticks(spark), transactions(spark)).collect()
    assert sorted((r.tick_number, r.sequence_number or 0) for r in flat) == [
        (1, 1), (1, 2), (1, 12), (2, 2), (3, 0)
    ]
    whole = lookup.tick_documents(ticks(spark), transactions(spark), document_rows=None).collect()
    assert {r.tick_number: len(r.transactions) for r in whole} == {1: 3, 2: 1, 3: 0}


@pytest.mark.parametrize("wanted, found", [
    ("a", [1, 1]), ("ab", [1, 2]), ("ab%_", [1, 2]), ("a%", None), ("abc", None), ("c" * 64, [1, 12]),
    ("e" * 64, None), ("e" * 70, [2, 2]), ("zz", None),
])
def test_find(spark, wanted, found):
    rows = transactions(spark)
    one = [[r.tick_number, r.sequence_number] for r in lookup.find_transaction(rows, wanted).collect()]
    table = spark.createDataFrame([(wanted,), (wanted,)], "wanted string")
    many = [[r.tick_number, r.sequence_number] for r in lookup.find_transactions(rows, table).collect()]
    assert one == many == ([found] if found else [])


@pytest.mark.parametrize("slices", [1, 5])
def test_find_many(spark, slices):
    """Nested prefixes, gaps between them, repeated hashes, nulls and the empty text."""
    rng = random.Random(11)
    text = lambda most: "".join(rng.choices("abé", k=rng.randrange(most)))
    hashes = [text(9) + "b" * 60 for _ in range(150)] + ["ab" * 32] * 40 + [None]
    start = datetime(2024, 1, 1)
    schema = "tick_number long, sequence_number int, tx_hash string, processed_at timestamp_ntz, version int"
    stored = [(i // 3, i % 3, h, start + timedelta(minutes=rng.randrange(30)), -1 if i % 7 == 0 else 1) for i, h in enumerate(hashes)]
    empty = transactions(spark).filter("false")
    rows = empty.unionByName(spark.createDataFrame(stored, schema), allowMissingColumns=True)
    wanted = {"", "abab", "ab" * 31, "ab" * 32, "zz", None, *(text(10) for _ in range(60)), *hashes[:20]}
    got = lookup.find_transactions(rows, spark.createDataFrame([(w,) for w in wanted], "wanted string"), slices)
    def newest(w):
        fits = (lambda h: h.startswith(w)) if len(w) < 64 else (lambda h: h == w)
        return max(((at, t, s, h) for t, s, h, at, v in stored if v > 0 and h and fits(h)), default=None)
    expected = {w: newest(w) for w in wanted if w is not None}
    found = {r.wanted: (r.processed_at, r.tick_number, r.sequence_number, r.tx_hash) for r in got.collect()}
    assert found == {w: best for w, best in expected.items() if best}
    assert got.count() == len(found)


def test_chain_state(spark):
    state = lookup.chain_state(ticks(spark), transactions(spark), 2).first()
    assert (state.chain_height, state.total_transactions) == ("3", "5")
    assert [t.tick_number for t in state.recent_ticks] == [3, 2]
    assert state.tx_to_tick_sample == {
        "a" * 64: "1", "ab%_" + "b" * 60: "1", "c" * 64: "1", "e" * 70: "2"
    }
    none = lookup.chain_state(ticks(spark).filter("false"), transactions(spark).filter("false")).first()
    assert tuple(none) == ("0", "0", [], {})
    assert lookup.last_tick(ticks(spark)).first()[0] == 3


def test_limits_and_pages(spark):
    rows = spark.range(10)
    assert [r.id for r in lookup.page(rows, ["id"], 3, 4).collect()] == [4, 5, 6]
    assert [r.id for r in lookup.page_after(rows, ["id"], [6], 2).collect()] == [7, 8]
    assert [r.id for r in lookup.page_after(rows, ["id"], None, 2).collect()] == [0, 1]
    for limit, offset in ((0, 0), (1001, 0), (5, -1)):
        with pytest.raises(ValueError):
            lookup.page(rows, ["id"], limit, offset)
    assert lookup.where_equal(rows, id=None).count() == 10
    assert lookup.where_equal(rows, id=3).count() == 1


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_transactions_meet_their_ticks_in_one_shuffle(spark):
    """Ticks, transactions and, of split ticks, the distinct cells and the ticks per cell."""
    heads, rows = ticks(spark), transactions(spark)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        whole = plan(lookup.tick_documents(heads, rows, document_rows=None))
        parts = plan(lookup.tick_documents(heads, rows, document_rows=10))
        flat = plan(lookup.tick_transactions(heads, rows))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert [p.count("Exchange hashpartitioning") for p in (whole, parts, flat)] == [2, 5, 5]
    assert [p.count("collect_list") > 0 for p in (whole, parts, flat)] == [True, True, False]


def test_documents_of_odd_rows(spark):
    """Several cells in a tick, no sequence number, hashes that are not hexadecimal, copies."""
    hashes = ["ab" * 32, "AB" * 32, "", None, "xyz", "abc"]
    rows = spark.createDataFrame(
        [(1, n, h, f"id{i}", 1, b"", 1, None, None, 1, at(i), 0, None, 1)
         for i, (n, h) in enumerate(zip([0, 9_999, 10_000, None, -1, 25_000], hashes))]
        + [(1, 0, "00", "old", 1, b"", 1, None, None, 1, at(-9), 0, None, 1)],
        transactions(spark).schema,
    )
    flat = lookup.tick_transactions(ticks(spark), rows, numbers=[1]).collect()
    assert {(r.sequence_number, r.tx_hash) for r in flat} == {
        (0, "ab" * 32), (9_999, "AB" * 32), (10_000, ""), (None, None), (-1, "xyz"), (25_000, "abc")
    }
    assert len(flat) == 6
    nested = lookup.tick_documents(ticks(spark), rows, numbers=[1], document_rows=5_000).collect()
    assert sorted((r.part is None, r.part, [t.tx_id for t in r.transactions]) for r in nested) == [
        (False, -1, ["id4"]), (False, 0, ["id0"]), (False, 1, ["id1"]), (False, 2, ["id2"]),
        (False, 5, ["id5"]), (True, None, ["id3"]),
    ]
    (whole,) = lookup.tick_documents(ticks(spark), rows, numbers=[1], document_rows=None).collect()
    assert [t.tx_id for t in whole.transactions] == ["id3", "id4", "id0", "id1", "id2", "id5"]


def test_one_large_file_is_not_dealt_anew(spark, tmp_path):
    spark.range(100_000).coalesce(1).write.parquet(f"{tmp_path}/one", compression="none")
    table = spark.read.parquet(f"{tmp_path}/one")
    assert "RoundRobin" in plan(adapters.spread(table))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        assert "RoundRobin" not in plan(adapters.spread(spark.read.parquet(f"{tmp_path}/one")))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_full_hashes_are_found_in_one_reading(spark):
    rows = transactions(spark)
    found = lookup.find_transactions(rows, rows.select(F.rpad("tx_hash", 64, "0").alias("wanted")))
    read = plan(found)
    assert read.count("payload_size#") > 0 and read.count("Join") == 1
    assert read.count("Exchange hashpartitioning") <= 3


def test_prefixes_sort_beginnings_only(spark, monkeypatch):
    """Hashes are sorted by as many characters as the longest prefix has; equal ranks go by text."""
    start = datetime(2024, 1, 1)
    schema = "tick_number long, sequence_number int, tx_hash string, processed_at timestamp_ntz, version int"
    hashes = [f"{i % 3}{i:063x}" for i in range(300)] + ["7A" * 32, "7a" * 32, "7z" * 32]
    stored = [(1, 1, h, start, 1) for h in hashes]
    rows = transactions(spark).filter("false").unionByName(
        spark.createDataFrame(stored, schema), allowMissingColumns=True
    )
    sorted_rows = []
    cut = lookup.cut
    monkeypatch.setattr(lookup, "cut", lambda df, *a: sorted_rows.append(df.count()) or cut(df, *a))
    wanted = spark.createDataFrame([(w,) for w in ["0", "1", "7", "70", hashes[4]]], "wanted string")
    found = lookup.find_transactions(rows, wanted)
    top = {w: max(h for h in hashes if h.startswith(w)) for w in ("0", "1", "7")}
    assert {r.wanted: r.tx_hash for r in found.collect()} == top | {hashes[4]: hashes[4]}
    assert sorted_rows[0] <= 4 + len({h[:2] for h in hashes}) < 12


def test_packed_texts_come_back(spark):
    given = [b"ab", b"abc", b"AB", b"\xff\xfe\x00", b"", None, b"\x00", b"0a\n", b"\xab", b"\x01\xab", b"00"]
    rows = spark.createDataFrame([(None if g is None else bytearray(g),) for g in given], "g binary")
    got = rows.select("g", parse.packed("g").alias("p")).withColumn("u", parse.unpacked("p").cast("binary")).collect()
    assert all(r.g == r.u for r in got)
    assert len({bytes(r.p) for r in got if r.p is not None}) == len(given) - 1
    assert len(next(r.p for r in got if r.g == b"ab")) == 2


def test_hexadecimal_texts_travel_as_bytes(spark, monkeypatch):
    dealt = []
    repartition = DataFrame.repartition
    monkeypatch.setattr(DataFrame, "repartition", lambda self, *a: dealt.append(self) or repartition(self, *a))
    keys = [b"0a" * 32, b"\xff" * 32, b"0A" * 32, None]
    rows = transactions(spark).limit(0).union(spark.createDataFrame(
        [(1, n, "ab" * 32, f"id{n}", 1, b"", 1, key and bytearray(key), bytearray(b"00" * 32), 1, at(n), 0, None, 1)
         for n, key in enumerate(keys)], transactions(spark).schema,
    ))
    (found,) = lookup.tick_documents(ticks(spark), rows, numbers=[1], document_rows=None).collect()
    assert [t.public_key for t in found.transactions] == [key.hex() if key else None for key in keys]
    assert {(t.tx_hash, t.signature) for t in found.transactions} == {("ab" * 32, (b"00" * 32).hex())}
    moved = dealt[0].select(*[F.octet_length(c) for c in ("tx_hash", "signature", "public_key")]).collect()
    assert sorted(moved, key=lambda r: r[2] or 0) == [(33, 33, None), (33, 33, 33), (33, 33, 33), (33, 33, 65)]
