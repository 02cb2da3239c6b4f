"""Rules on nested ticks, case by case."""

from __future__ import annotations

import contextlib
import io
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ticklake import schemas
from ticklake.operators import quality, reorg
from ticklake.operators.ordered import fold_kept, fold_with_states
from ticklake.plans import quality_plans

NOW = datetime(2024, 5, 1, 12, 0)
HASH = "ab" * 32


def micros(at: datetime) -> int:
    return (at - datetime(1970, 1, 1)) // timedelta(microseconds=1)


def entry(number=1, tx_hash=HASH, body="default", **changes):
    if body == "default":
        body = {
            "tx_id": "id", "payload": b"test_payload_data", "signature": b"s" * 64,
            "public_key": b"k" * 32, "nonce": 1, "timestamp": micros(NOW), **changes,
        }
    return {"transaction": body, "sequence_number": number, "tx_hash": tx_hash,
            "ingestion_timestamp": 1}


def tick(number=100, arrival=None, source="s", **changes):
    proof = {"input": HASH, "output": HASH, "proof": "proof_data_here", "iterations": 1000}
    if changes.get("vdf_proof", "") is None:
        proof = None
    for name in ("input", "output", "proof", "iterations"):
        if name in changes:
            proof[name] = changes.pop(name)
    return {
        "source_id": source, "arrival": number if arrival is None else arrival,
        "tick_number": number, "transactions": [entry()], "transaction_batch_hash": HASH,
        "timestamp": micros(NOW), "previous_output": HASH, **changes, "vdf_proof": proof,
    }


def frame(spark, ticks):
    return spark.createDataFrame(ticks, schemas.TICK)


def issues(spark, one, strict=False):
    row = quality.tick_issues(frame(spark, [one]), NOW, strict).first()
    sound = frame(spark, [one]).select(quality.is_sound(NOW, strict)).first()[0]
    assert sound == (len(row["issues"]) == 0)
    return [(i["field"], i["rule"]) for i in row["issues"]]


ZERO_BODY = dict(tx_id="", payload=b"", signature=b"s", public_key=b"k", timestamp=0)
TX = "transactions[0]"

CASES = [
    (tick(), []),
    (tick(timestamp=0), [("timestamp", "not_zero")]),
    (tick(timestamp=micros(NOW + timedelta(minutes=10))), [("timestamp", "future_limit")]),
    (tick(timestamp=micros(NOW + timedelta(minutes=5))), []),
    (tick(timestamp=micros(NOW - timedelta(hours=25))), [("timestamp", "past_limit")]),
    (tick(timestamp=micros(NOW - timedelta(hours=24))), []),
    (tick(vdf_proof=None), [("vdf_proof", "not_null")]),
    (tick(input=""), [("vdf_input", "not_empty")]),
    (tick(input=None), [("vdf_input", "not_empty")]),
    (tick(input=HASH + "\n"), [("vdf_input", "hex_format")]),
    (tick(input="zz" * 32), [("vdf_input", "hex_format")]),
    (tick(proof=""), [("vdf_proof.proof", "not_empty")]),
    (tick(iterations=0), [("vdf_proof.iterations", "positive")]),
    (tick(iterations=1_000_000), []),
    (tick(iterations=1_000_001), [("vdf_proof.iterations", "reasonable_limit")]),
    (tick(transaction_batch_hash="invalid_hash"), []),
    (tick(transactions=[]), []),
    (tick(transactions=None), []),
    (tick(transactions=[None]), [(TX, "not_null")]),
    (tick(transactions=[entry(body=None)]), [(TX + ".transaction", "not_null")]),
    (tick(transactions=[entry(tx_hash="invalid_hash")]), [(TX + ".tx_hash", "hex_format")]),
    (tick(transactions=[entry(tx_hash="")]), [(TX + ".tx_hash", "not_empty")]),
    (tick(transactions=[entry(tx_id="")]), [(TX + ".tx_id", "not_empty")]),
    (tick(transactions=[entry(payload=None)]), [(TX + ".payload", "not_empty")]),
    (tick(transactions=[entry(signature=b"", public_key=None)]), []),
    (
        tick(transactions=[entry(), entry(), entry(2), entry()]),
        [("transactions[1].sequence_number", "unique"), ("transactions[3].sequence_number", "unique")],
    ),
    (
        tick(transactions=[entry(3), entry(3, **ZERO_BODY)]),
        [(f"transactions[1].{f}", r) for f, r in [
            ("sequence_number", "unique"), ("tx_id", "not_empty"), ("payload", "not_empty"),
            ("signature", "signature_format"), ("public_key", "public_key_format"),
            ("timestamp", "positive"),
        ]],
    ),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_stateless_rules(spark, case):
    one, expected = CASES[case]
    assert issues(spark, one) == expected


def test_many_transactions(spark):
    many = tick(transactions=[entry(i) for i in range(10_001)])
    assert issues(spark, many) == [("transactions", "count_limit")]
    assert issues(spark, tick(transactions=[entry(i) for i in range(10_000)])) == []


def test_strict_rules(spark):
    bad = tick(output="xyz", previous_output="")
    assert issues(spark, bad) == []
    assert issues(spark, bad, strict=True) == [
        ("vdf_output", "hex_format"), ("previous_output", "not_empty")
    ]


def checked(spark, ticks, **options):
    rows = quality.validate(frame(spark, ticks), NOW, **options).orderBy("arrival").collect()
    return [[(i["field"], i["rule"]) for i in r["issues"]] for r in rows]


NUMBER, TIME = "tick_number", "timestamp"


def test_sequence_rules(spark):
    numbers = [1002, 2002, 3003, 2003, 2003, 2000]
    got = checked(spark, [tick(n, arrival=i) for i, n in enumerate(numbers)])
    assert got == [
        [], [], [(NUMBER, "jump_limit")], [], [(NUMBER, "sequence")],
        [(NUMBER, "sequence"), (NUMBER, "jump_limit")],
    ]


def test_backward_number_and_time(spark):
    later = tick(50, arrival=2, timestamp=micros(NOW) - 1)
    assert checked(spark, [tick(100, arrival=1), later])[1] == [
        (NUMBER, "sequence"), (NUMBER, "jump_limit"), (TIME, "sequence")
    ]
    message = quality.validate(frame(spark, [tick(100, arrival=1), later]), NOW).filter(
        "arrival = 2"
    ).first()["issues"][1]["message"]
    assert message == f"tick number jump of {2**64 - 50} exceeds maximum allowed 1000"


def test_severity_and_stats(spark):
    ticks = [tick(1, arrival=1), tick(2, arrival=2, iterations=0), tick(3, arrival=3),
             tick(3, arrival=4), tick(4, arrival=5), tick(9000, arrival=6)]
    parts = quality.split_by_severity(quality.validate(frame(spark, ticks), NOW))
    assert [sorted(r.arrival for r in p.collect()) for p in parts] == [[1, 3, 5], [2, 6], [4]]
    state = quality.sequence_state(quality.slim_ticks(frame(spark, ticks), NOW))
    stats = quality.validation_stats(state).first()
    assert (stats.last_validated_tick, stats.sequence_gaps) == (4, 1)


def test_fold_goes_on_from_stored_states(spark):
    """Two batches with the state handed over equal one batch; idle keys keep theirs."""
    ticks = [tick(n, arrival=i, source=s) for i, (s, n) in enumerate(
        [("a", 5), ("b", 7), ("a", 4), ("a", 6), ("b", 9), ("a", 6), ("a", 8)]
    )]
    slim = quality.slim_ticks(frame(spark, ticks), NOW)
    inputs = {"number": F.col("tick_number"), "time": F.col("timestamp"), "good": F.col("good")}

    def run(rows, start, group_rows):
        return fold_with_states(
            rows, ["source_id"], ["arrival"], quality.sequence_step, [0, 0], inputs,
            quality.STATE_FIELDS, group_rows, start,
        )

    def rows(df):
        return {r.arrival: (r.last_number, r.accepted) for r in df.collect()}

    whole, states = run(slim, None, None)
    for group_rows in (None, 1):
        first, between = run(slim.filter("arrival < 5"), None, group_rows)
        between = spark.createDataFrame(between.collect(), between.schema)
        second, final = run(slim.filter("arrival >= 5"), between, group_rows)
        assert {**rows(first), **rows(second)} == rows(whole)
        assert {tuple(r) for r in final.collect()} == {tuple(r) for r in states.collect()}


def test_reorg_cases(spark):
    ticks = [
        tick(100, arrival=1), tick(100, arrival=2), tick(200, arrival=3),
        tick(200, arrival=4, output="cd" * 32), tick(300, arrival=5),
        tick(300, arrival=6, output="1", transaction_batch_hash="2", previous_output="3",
             transactions=[]),
    ]
    rows = reorg.comparable(frame(spark, ticks))
    for events in (reorg.reorg_events(rows), reorg.windowed_events(rows)):
        assert [tuple(r) for r in events.orderBy("arrival").collect()] == [
            ("s", 200, 4, 3, "VDF output mismatch"),
            ("s", 300, 6, 5, "VDF output mismatch, transaction batch hash mismatch, "
             "previous output mismatch, transaction count mismatch (1 vs 0)"),
        ]
    window = reorg.windowed(reorg.comparable(frame(spark, [tick(n) for n in range(1, 6)])), 3)
    stats = reorg.reorg_stats(window, 3).first()
    assert (stats.window_size, stats.current_window, stats.conflicts_found) == (3, 3, 0)


def test_row_predicates(spark):
    rows = spark.createDataFrame(
        [(1, 1, "h", "h", "i", b"k", b"s"), (0, 1, "h", "h", "i", b"k", b"s"),
         (1, 0, None, "h", "", b"k", b""), (None,) * 7],
        "tick_number int, timestamp_us int, transaction_batch_hash string, tx_hash string, "
        "tx_id string, public_key binary, signature binary",
    ).select(quality.tick_row_is_valid(), quality.transaction_row_is_valid(), quality.is_parseable())
    assert [tuple(r) for r in rows.collect()] == [
        (True, True, True), (False, False, False), (False, False, True), (False, False, False)
    ]


def test_severity_checks_ticks_once(spark, tmp_path):
    """The three parts read one stored check; there is no join of ticks in their plan."""
    orders = spark.createDataFrame([(k, k % 3) for k in range(200)], "o_orderkey bigint, o_custkey bigint")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    rows = quality_plans._severity(spark, str(tmp_path))
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        rows.explain()
    assert "Join" not in out.getvalue()
    assert rows.count() == 200 and rows.select("severity").distinct().count() == 3


@pytest.mark.parametrize("one", [c[0] for c in CASES] + [
    tick(transactions=None), tick(transactions=[None]), tick(transactions=[entry(body=None)]),
    tick(transactions=[entry(), entry(body=None)]), tick(vdf_proof=None, transactions=[None]),
])
def test_lacking_parts_are_the_critical_issues(spark, one):
    rows = quality.tick_issues(frame(spark, [one]), NOW, True)
    assert rows.select(quality.lacks_parts() == quality.is_critical()).first()[0]


@pytest.mark.parametrize("group_rows", [None, 20])
def test_fold_kept_is_the_fold(spark, group_rows):
    """Rows that meet the condition, and the states, of one shuffle; with keys whole and split."""
    rng = random.Random(3)
    rows = spark.createDataFrame(
        [(rng.choice("aab"), i, rng.randrange(9), rng.choice([HASH, "zz", None, "0A"]), "b", "p", 1) for i in range(200)],
        "source_id string, arrival long, tick_number long, output string, batch_hash string, previous_output string, tx_count int",
    )
    start = spark.createDataFrame([("=a", '{"3": [-1, "q", "b", "p", 1]}')], "_key string, state string")
    arguments = (
        rows, ["source_id"], ["arrival"], reorg.window_step(4), {},
        {n: F.col(n) for n in reorg.WINDOW_INPUTS}, reorg.WINDOW_OUTPUTS,
    )
    wanted, states = fold_with_states(*arguments, group_rows=group_rows, start=start)
    hit = F.col("conflict_reason").isNotNull()
    got, ends, held = fold_kept(*arguments, hit, ["source_id", "arrival"], ["output"], group_rows, start)
    names = ["source_id", "arrival", *[f.name for f in reorg.WINDOW_OUTPUTS]]
    assert got.columns == names and got.count() > 10
    assert sorted(got.collect()) == sorted(wanted.filter(hit).select(*names).collect())
    assert sorted(ends.collect()) == sorted(states.collect())
    held.unpersist()
