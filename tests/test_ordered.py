"""Ordered computations give the same answer whether or not keys are split."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ticklake.operators import metrics, prices, quality, reorg
from ticklake.operators.ordered import running

# Small enough that the hot keys below span many slices.
SPLIT = 40


def hot_rows(seed: int, rows: int = 900):
    """One key holds two thirds of the rows."""
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < 0.67 else f"k{rng.randrange(6)}", i, rng.randrange(5))
        for i in range(rows)
    ]


@pytest.mark.parametrize("group_rows", [None, SPLIT])
@pytest.mark.parametrize("inclusive", [False, True])
def test_running(spark, group_rows, inclusive):
    rows = hot_rows(1)
    df = spark.createDataFrame(rows, "k string, at int, v int").repartition(5)
    wanted = {kind: (kind, F.when(F.col("v") > 0, F.col("v"))) for kind in
              ("sum", "max", "min", "first", "last")}
    got = running(df, ["k"], ["at"], wanted, inclusive=inclusive, group_rows=group_rows)
    assert got.columns == ["k", "at", "v", *wanted]
    seen: dict = {}
    expected = {}
    for k, at, v in rows:
        past = seen.setdefault(k, [])
        if inclusive and v > 0:
            past.append(v)
        expected[(k, at)] = (
            (sum(past), max(past), min(past), past[0], past[-1]) if past else (None,) * 5
        )
        if not inclusive and v > 0:
            past.append(v)
    assert {(r.k, r.at): tuple(r)[3:] for r in got.collect()} == expected


def test_sums_of_decimals_keep_their_last_place(spark):
    rows = hot_rows(3)
    df = spark.createDataFrame(rows, "k string, at int, v int").repartition(5)
    tiny = {"total": ("sum", (F.when(F.col("v") > 0, F.col("v")) / 1_000_000_000).cast("decimal(28,9)"))}
    whole, split = (running(df, ["k"], ["at"], tiny, inclusive=True, group_rows=n) for n in (None, SPLIT))
    assert split.dtypes == whole.dtypes
    units, past = {}, {}
    for k, at, v in rows:
        if v > 0:
            past[k] = past.get(k, 0) + v
        units[k, at] = past.get(k)
    for got in (whole, split):
        assert {(r.k, r.at): r.total and int(r.total.scaleb(9)) for r in got.collect()} == units


def observed(spark, seed):
    rng = random.Random(seed)
    rows, at = [], 0
    for key, i, v in hot_rows(seed):
        at += rng.choice([0, 1_000_000, 7_000_000, 29_999_000, 30_000_000])
        rows.append((key, at, float(v // 2), i))
    df = spark.createDataFrame(rows, "market_id string, us bigint, price double, arrival int")
    stamped = df.withColumn("poll_time", F.timestamp_micros("us"))
    return rows, stamped.repartition(4)


@pytest.mark.parametrize("group_rows", [None, SPLIT])
@pytest.mark.parametrize("min_tick", [None, 1.0])
def test_thin(spark, group_rows, min_tick):
    rows, df = observed(spark, 2)
    kept, state = set(), {}
    for market, at, price, arrival in rows:
        last, kept_at = state.get(market, (0.0, None))
        moved = (
            last == 0 or price != last if min_tick is None
            else abs(price - last) >= max(min_tick, 0.5 * last)
        )
        if kept_at is None or moved or at - kept_at >= 30_000_000:
            kept.add(arrival)
            kept_at = at
        state[market] = (price, kept_at)
    got = prices.thin(df, min_tick=min_tick, epsilon=0.5, group_rows=group_rows)
    assert {r.arrival for r in got.select("arrival").collect()} == kept
    assert 0 < len(kept) < len(rows)


@pytest.mark.parametrize("group_rows", [None, SPLIT])
def test_changed_and_moved_only(spark, group_rows):
    rows, df = observed(spark, 3)
    changed, moved, last = set(), set(), {}
    for market, _, price, arrival in rows:
        before = last.get(market)
        if before is None or before == 0 or price != before:
            changed.add(arrival)
        if before is None or abs(price - before) >= max(0.5, 0.1 * before):
            moved.add(arrival)
        last[market] = price
    got = prices.changed_only(df, group_rows).select("arrival").collect()
    assert {r.arrival for r in got} == changed
    got = prices.moved_only(df, 0.5, 0.1, group_rows).select("arrival").collect()
    assert {r.arrival for r in got} == moved


@pytest.mark.parametrize("slices", [None, 24])
def test_sequence_state(spark, slices):
    rng = random.Random(4)
    rows, number = [], 0
    for source, arrival, v in hot_rows(4):
        number += rng.choice([1, 1, 1, 2, 400, -3, 1500 if v == 0 else 1])
        rows.append((source, arrival, max(number, 0), arrival * 10 - (200 if v == 1 else 0), v != 2))
    df = spark.createDataFrame(
        rows, "source_id string, arrival int, tick_number bigint, timestamp bigint, good boolean"
    ).repartition(3)
    state, expected = {}, {}
    for source, arrival, number, time, good in rows:
        last, last_time = state.get(source, (0, 0))
        ok = good
        if last > 0 and (number <= last or number - last > 1000):
            ok = False
        if time and last_time > 0 and time < last_time:
            ok = False
        expected[arrival] = (last, last_time, ok)
        if ok:
            state[source] = (number, time)
    got = quality.sequence_state(df, slices).collect()
    assert {r.arrival: (r.last_number, r.last_time, r.accepted) for r in got} == expected


def test_sequence_state_stuck_source(spark):
    """After one accepted far number all later ticks fail, slice after slice."""
    rows = [("s", 0, 10**9, 1, True)] + [("s", i, i, 1 + i, True) for i in range(1, 500)]
    df = spark.createDataFrame(
        rows, "source_id string, arrival int, tick_number bigint, timestamp bigint, good boolean"
    )
    got = quality.sequence_state(df, 24).collect()
    assert sum(r.accepted for r in got) == 1
    assert {r.last_number for r in got if r.arrival > 0} == {10**9}


def copies(seed):
    rng = random.Random(seed)
    rows = []
    for source, arrival, v in hot_rows(seed):
        number = rng.randrange(12) + arrival // 60
        output = None if rng.random() < 0.2 else f"o{number}{'x' if rng.random() < 0.3 else ''}"
        batch = f"b{number}{'x' if rng.random() < 0.1 else ''}"
        rows.append((source, arrival, number, output, batch, "p", 1 + (v == 0)))
    return rows


def brute_reorg(rows, size=None):
    windows, events, sizes, conflicts = {}, {}, {}, {}
    for source, arrival, number, output, batch, previous, count in rows:
        window = windows.setdefault(source, {})
        old = window.get(number)
        reasons = []
        if old:
            if old[1] is not None and output is not None and old[1] != output:
                reasons.append(reorg.OUTPUT_REASON)
            if old[2] != batch:
                reasons.append(reorg.BATCH_REASON)
            if old[3] != previous:
                reasons.append(reorg.PREVIOUS_REASON)
            if old[4] != count:
                reasons.append(f"transaction count mismatch ({old[4]} vs {count})")
        if reasons:
            events[arrival] = (source, number, old[0], ", ".join(reasons))
            conflicts[source] = conflicts.get(source, 0) + 1
        else:
            window[number] = (arrival, output, batch, previous, count)
            if size is not None and len(window) > size:
                for stale in [n for n in window if n < max(number - size + 1, 0)]:
                    del window[stale]
        sizes[source] = len(window)
    return events, sizes, conflicts


COPY = ("source_id string, arrival bigint, tick_number bigint, output string, batch_hash string, "
        "previous_output string, tx_count int")


@pytest.mark.parametrize("group_rows", [None, 15])
def test_reorg_events(spark, group_rows):
    rows = copies(5)
    df = spark.createDataFrame(rows, COPY).repartition(4)
    events, _, _ = brute_reorg(rows)
    got = reorg.reorg_events(df, group_rows).collect()
    assert {r.arrival: (r.source_id, r.tick_number, r.old_arrival, r.conflict_reason)
            for r in got} == events
    assert len(events) > 50


@pytest.mark.parametrize("group_rows", [None, SPLIT])
@pytest.mark.parametrize("size", [3, 128])
def test_windowed_events(spark, group_rows, size):
    rows = copies(6)
    df = spark.createDataFrame(rows, COPY).repartition(4)
    events, sizes, conflicts = brute_reorg(rows, size)
    windowed = reorg.windowed(df, size, group_rows)
    got = reorg.windowed_events(df, size, group_rows).collect()
    assert {r.arrival: (r.source_id, r.tick_number, r.old_arrival, r.conflict_reason)
            for r in got} == events
    stats = {r.source_id: r for r in reorg.reorg_stats(windowed, size).collect()}
    assert {s: r.current_window for s, r in stats.items()} == sizes
    assert {s: r.conflicts_found for s, r in stats.items()} == {
        s: conflicts.get(s, 0) for s in sizes
    }


@pytest.mark.parametrize("slices", [None, 24])
def test_token_bucket(spark, slices):
    rng = random.Random(7)
    rows, at = [], 0
    for key, i, _ in hot_rows(7):
        at += rng.randrange(3_000_000)
        rows.append((key, at, i))
    df = spark.createDataFrame(rows, "key string, us bigint, event_id int").withColumn(
        "ts", F.timestamp_micros("us")
    )
    state, expected = {}, {}
    for key, at, i in rows:
        tokens, last = state.get(key, (4.0, at))
        tokens = min(tokens + (at - last) / 1_000_000 * 0.25, 4)
        expected[i] = tokens >= 1
        state[key] = (tokens - 1 if tokens >= 1 else tokens, at)
    got = metrics.admit(df, 0.25, 4, slices=slices).collect()
    assert {r.event_id: r.admitted for r in got} == expected
    assert 0 < sum(expected.values()) < len(expected)


@pytest.mark.parametrize("group_rows", [None, SPLIT])
def test_flush_statistics(spark, group_rows):
    rows = [(key, i, v * 7) for key, i, v in hot_rows(8)]
    df = spark.createDataFrame(rows, "query_id string, seq int, duration_ms bigint")
    past, ema, expected = {}, {}, {}
    for key, i, value in rows:
        past.setdefault(key, []).append(value)
        ema[key] = float(value) if key not in ema else 0.9 * ema[key] + 0.1 * value
        expected[i] = (len(past[key]), sum(past[key]) / len(past[key]), ema[key])
    means = {r.seq: (r.flush_count, r.average_ms)
             for r in metrics.flush_means(df, group_rows).collect()}
    emas = {r.seq: r.ema_ms for r in metrics.flush_ema(df, slices=group_rows and 24).collect()}
    assert {i: (*means[i], emas[i]) for i in means} == expected


@pytest.mark.parametrize("group_rows", [None, SPLIT])
def test_error_runs_and_progress(spark, group_rows):
    rows = [(key, i, v == 0 and i % 4 == 0) for key, i, v in hot_rows(9)]
    df = spark.createDataFrame(rows, "source_id string, ts int, ok boolean")
    run, expected = {}, {}
    for key, i, ok in rows:
        run[key] = 0 if ok else run.get(key, 0) + 1
        expected[i] = (run[key], metrics.ALERTS.get(run[key]))
    got = metrics.error_runs(df, group_rows=group_rows).collect()
    assert {r.ts: (r.run, r.alert) for r in got} == expected
    assert {alert for _, alert in expected.values()} == {None, "WARNING", "ALERT", "CRITICAL"}

    saves = [(key, i, (i * 37) % 1000) for key, i, _ in rows]
    df = spark.createDataFrame(saves, "source_id string, arrival int, tick_number int")
    best, kept = {}, set()
    for key, i, tick in saves:
        if tick > best.get(key, 0):
            best[key] = tick
            kept.add(i)
    assert {r.arrival for r in metrics.progress_history(df, group_rows).collect()} == kept
