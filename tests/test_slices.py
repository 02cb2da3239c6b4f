"""Summaries of slices equal the fold they stand for, and the number of jobs is fixed."""

from __future__ import annotations

import json
import random
import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ticklake.operators import metrics, prices, quality
from ticklake.operators.sequence import _Chains, sequence_step
from ticklake.operators.slices import Smoothing


def jobs(spark, action) -> tuple[int, object]:
    """Spark jobs that an action starts, and its result."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        result = action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), result


visits = st.lists(st.integers(0, 9_000_000), max_size=40)


@settings(max_examples=300, deadline=None)
@given(visits, visits, st.sampled_from([(0.25, 4), (1 / 3, 1), (2.5, 3), (1e-9, 2)]))
def test_bucket_summaries(before, gaps, rate):
    bucket = metrics.bucket(*rate)
    times, at = [], 0
    for gap in before + gaps:
        at += gap
        times.append(at)
    head, tail = times[: len(before)], times[len(before) :]
    state = bucket.step(bucket.start, [head], [[]])
    summary = bucket.open()
    for low in range(0, len(tail), 7):
        bucket.absorb(summary, [tail[low : low + 7]])
    closed = json.loads(json.dumps(bucket.close(summary)))
    for entered in (state, bucket.start, [0, tail[0] if tail else None], [bucket.unit - 1, tail[0] if tail else None]):
        assert bucket.apply(closed, entered) == bucket.step(entered, [tail], [[]])


def test_bucket_summary_stays_small():
    """About as many pieces as tokens, or as rows while one token comes."""
    rng = random.Random(1)
    bucket = metrics.bucket(1 / 3, 50)
    for wait in (100_000, 2_900_000, 3_000_000, 3_100_000, 160_000_000):
        summary, at = bucket.open(), 0
        for _ in range(6000):
            at += rng.randrange(2 * wait)
            bucket.absorb(summary, [[at]])
        assert len(bucket.close(summary)["credits"]) <= 2 * 50 + 2 + 2 * 3_000_000 / wait


@settings(max_examples=100, deadline=None)
@given(
    st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=30), st.floats(-1e6, 1e6),
    st.integers(0, 900), st.sampled_from([0.1, 0.5, 0.9]),
)
def test_smoothing_summaries(values, state, constant, alpha):
    column = values + [values[-1]] * constant
    smoothing = Smoothing(alpha, (-1e6, 1e6))
    summary = smoothing.open()
    for low in range(0, len(column), 100):
        smoothing.absorb(summary, [column[low : low + 100]])
    for entered in (None, state, -1e6, 1e6):
        assert smoothing.apply(summary, entered) == smoothing.step(entered, [column], [[]])
    assert len(summary["values"]) <= 1200


ticks = st.lists(
    st.tuples(st.sampled_from([0, 1, 5, 900, 1000, 1001, 1500, 2400, 10**9]), st.integers(0, 6)), max_size=25
)


@settings(max_examples=300, deadline=None)
@given(ticks)
def test_chains_of_a_slice(rows):
    chains = _Chains()
    for place, (number, time) in enumerate(rows):
        chains.add(place, number, time)
    for at, end in enumerate(chains.ends()):
        state = sequence_step(
            list(rows[at]), [[n for n, _ in rows[at + 1 :]], [t for _, t in rows[at + 1 :]], [True] * len(rows)], [[], [], []]
        )
        assert list(chains.ticks[end][1:]) == state


def walked(rows):
    state, expected = {}, {}
    for source, arrival, number, time, good in rows:
        before = state.get(source, [0, 0])
        accepted: list = []
        state[source] = sequence_step(before, [[number], [time], [good]], [[], [], accepted])
        expected[source, arrival] = (*before, accepted[0])
    return expected


def shaped(kind):
    rng = random.Random(kind)
    rows, number = [], 0
    for arrival in range(1200):
        number += rng.choice([1, 1, 2, 300])
        tick = {
            "steady": number,
            "stuck": 10**9 if arrival == 3 else number,
            "random": rng.randrange(1, 2**62),
            "down": 10**6 - arrival * 400,
            "same": 7,
            "zeros": 0 if arrival % 3 else number,
            "restarts": number % 5000,
            "late": number,
        }[kind]
        time = 10_000 - arrival if kind == "down" else 0 if rng.random() < 0.1 else arrival * 10 + rng.randrange(-30, 30)
        good = rng.random() < 0.9 if kind != "late" else arrival > 700
        rows.append(("s", arrival, tick, time, good))
        if arrival % 5 == 0:
            rows.append((f"t{arrival // 100}", arrival, number, time, True))
    return rows


@pytest.mark.parametrize("kind", ["steady", "stuck", "random", "down", "same", "zeros", "restarts", "late"])
def test_sequence_in_many_slices(spark, kind):
    rows = shaped(kind)
    df = spark.createDataFrame(
        rows, "source_id string, arrival bigint, tick_number bigint, timestamp bigint, good boolean"
    ).repartition(3)
    counted, got = jobs(spark, lambda: quality.sequence_state(df, 32).collect())
    found = {(r.source_id, r.arrival): (r.last_number, r.last_time, r.accepted) for r in got}
    assert found == walked(rows)
    # AQE gives each stage of a query its own job; none of them grows with the slices.
    assert counted <= 24


def test_jobs_do_not_grow_with_slices(spark):
    """Also for a source that is stuck and a key that is always limited."""
    stuck = spark.createDataFrame(
        [("s", i, 10**9 if i == 0 else i, 0, True) for i in range(800)],
        "source_id string, arrival bigint, tick_number bigint, timestamp bigint, good boolean",
    )
    limited = spark.createDataFrame([("k", 400_000 * i, i) for i in range(800)], "key string, us bigint, event_id int")
    limited = limited.withColumn("ts", F.timestamp_micros("us"))
    counts = {}
    for slices in (4, 64):
        a, states = jobs(spark, lambda: quality.sequence_state(stuck, slices).collect())
        b, admitted = jobs(spark, lambda: metrics.admit(limited, 1.0, 2, slices=slices).collect())
        assert sum(r.accepted for r in states) == 1
        assert sum(r.admitted for r in admitted) == int(2 + 0.4 * 799)
        counts[slices] = (a, b)
    # AQE may plan a join with a job more or less; sixteen times the slices make no difference
    assert all(abs(few - many) <= 3 for few, many in zip(counts[4], counts[64]))


@pytest.mark.parametrize("group_rows", [None, 60])
def test_one_island(spark, group_rows):
    """A price that never changes, seen every second or so for hours."""
    rng = random.Random(5)
    rows, at = [], 0
    for i in range(4000):
        at += rng.choice([0, 400_000, 1_000_000, 2_500_000, 29_000_000 if i % 50 == 0 else 1])
        rows.append(("m", at, 5.0, i))
    rows += [("n", 1_000_000 * i, None if i % 4 == 1 else 2.0, 5000 + i) for i in range(200)]
    df = spark.createDataFrame(rows, "market_id string, us bigint, price double, arrival int")
    df = df.withColumn("poll_time", F.timestamp_micros("us")).repartition(4)
    kept, last = set(), {}
    for market, us, _, arrival in rows:
        if market not in last or us - last[market] >= 30_000_000:
            kept.add(arrival)
            last[market] = us
    thinned = prices.thin(df, group_rows=group_rows)
    assert {r.arrival for r in thinned.collect()} == kept
    plan = thinned._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_means_are_the_same_in_any_split(spark):
    rng = random.Random(2)
    rows = [("q", i, rng.choice([0.1, 1e6 / 3, 1e-7, 123.456])) for i in range(900)]
    df = spark.createDataFrame(rows, "query_id string, seq int, duration_ms double")
    found = [
        sorted((r.seq, r.average_ms) for r in metrics.flush_means(df.repartition(5), size).collect())
        for size in (None, 30, 200)
    ]
    assert found[0] == found[1] == found[2]
    emas = [sorted((r.seq, r.ema_ms) for r in metrics.flush_ema(df, slices=n).collect()) for n in (1, 7, 40)]
    assert emas[0] == emas[1] == emas[2]
    state, expected = None, []
    for _, i, value in rows:
        state = value if state is None else (1 - 0.1) * state + 0.1 * value
        expected.append((i, state))
    assert emas[0] == expected
