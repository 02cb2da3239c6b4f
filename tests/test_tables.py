"""Stored tables: layout, upserts, refresh, retention, compaction, ingest and streams."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame as ClassicFrame

from test_quality import HASH, NOW, entry, frame, tick
from ticklake import schemas
from ticklake.functions.session import scratch_path
from ticklake.operators import lookup, metrics, ordered, prices, quality, reorg, rollups
from ticklake.plans import adapters
from ticklake.sinks import folders, tables, upkeep
from ticklake.sources import ticks as sources
from ticklake.streaming import ingest, keyed, live
from test_ordered import COPY, copies, observed

DAY = datetime(2024, 3, 1)


def stored(spark, rows):
    """Transactions from (tick, sequence, hash, hours after DAY)."""
    return spark.createDataFrame(
        [(t, s, h, "id", 1, b"p", 0, b"k", b"s", 0, DAY + timedelta(hours=x), 1, None, 1)
         for t, s, h, x in rows], schemas.TRANSACTIONS,
    )


def current(spark, path):
    rows = tables.read_current(
        tables.read_rows(spark, path, schemas.TRANSACTIONS), schemas.TRANSACTION_KEYS
    )
    return sorted((r.tick_number, r.sequence_number, r.tx_hash) for r in rows.collect())


def test_upsert_replay_and_compaction(spark):
    path = scratch_path(spark, "t")
    first = stored(spark, [(1, 1, "a", 0), (1, 1, "b", 1), (1, 2, "c", 1)])
    second = stored(spark, [(1, 1, "d", 2), (2, 1, "e", 30)])
    for batch_id, rows in [(0, first), (1, second), (1, second)]:
        tables.write_rows(rows, path, schemas.TRANSACTION_KEYS, batch_id)
    wanted = [(1, 1, "d"), (1, 2, "c"), (2, 1, "e")]
    assert current(spark, path) == wanted
    assert tables.read_rows(spark, path, schemas.TRANSACTIONS).count() == 4

    third = stored(spark, [(1, 2, "f", 1.5)])
    tables.write_rows(third, path, schemas.TRANSACTION_KEYS, 2)
    wanted[1] = (1, 2, "f")
    now = DAY + timedelta(hours=10)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.TRANSACTIONS.fields)
    before = folders.file_count(spark, path)
    options = (ddl, now, timedelta(hours=2), schemas.TRANSACTION_KEYS)
    assert upkeep.compact(spark, path, *options) == 2
    assert upkeep.compact(spark, path, *options) == 0
    assert current(spark, path) == wanted
    assert folders.file_count(spark, path) < before
    assert [v["batch_id"] for v, _ in folders.partitions(spark, path, tables.PARTITIONS)] == ["-1", "-1", "1"]
    tables.write_rows(stored(spark, [(5, 1, "g", 1.2)]), path, schemas.TRANSACTION_KEYS, 3)
    assert upkeep.compact(spark, path, *options) == 1
    assert current(spark, path) == [*wanted, (5, 1, "g")]


def test_time_ranges_prune_partitions(spark):
    path = scratch_path(spark, "t")
    rows = stored(spark, [(h, 1, str(h), h) for h in range(0, 50, 5)])
    tables.write_rows(rows, path, schemas.TRANSACTION_KEYS)
    read = tables.read_rows(
        spark, path, schemas.TRANSACTIONS, DAY + timedelta(hours=10), DAY + timedelta(hours=25)
    )
    assert sorted(r.tick_number for r in read.collect()) == [10, 15, 20]
    plan = read._jdf.queryExecution().executedPlan()
    files = plan.collectLeaves().head().metrics().apply("numFiles").value()
    read.collect()
    text = read._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    partition_filters = [line for line in text.splitlines() if line.startswith("PartitionFilters")]
    assert partition_filters and "p_hour" in partition_filters[0]
    assert files <= 5


def test_price_table(spark):
    path = scratch_path(spark, "p")

    def rows(values):
        return spark.createDataFrame(
            [(m, DAY + timedelta(hours=h), p, a) for m, h, p, a in values],
            "market_id string, ts timestamp, price double, arrival int",
        )

    tables.write_prices(rows([("m", 1, 5.0, 2), ("m", 1, 4.0, 1), ("m", 30, 6.0, 3)]), path, 0)
    later = rows([("m", 1, 9.0, 4), ("n", 1, 7.0, 5), ("m", 31, 8.0, 6)])
    for _ in range(2):
        tables.write_prices(later, path, 1)
    got = {(r.market_id, (r.ts - DAY).total_seconds() / 3600, float(r.price))
           for r in tables.read_prices(spark, path).collect()}
    assert got == {("m", 1, 4), ("m", 30, 6), ("n", 1, 7), ("m", 31, 8)}
    now = DAY + timedelta(days=91)
    assert len(upkeep.drop_older_than(spark, path, now, 90)) == 1
    assert tables.read_prices(spark, path).count() == 4
    upkeep.drop_older_than(spark, path, now, 90, dry_run=False)
    assert tables.read_prices(spark, path).count() == 2
    assert upkeep.compact(spark, path, "market_id string, ts timestamp, price decimal(18,8)",
                          DAY + timedelta(days=30), timedelta(days=7), ["market_id", "ts"], hourly=False) == 1
    assert tables.read_prices(spark, path).count() == 2


def test_refresh_follows_changes(spark):
    path = scratch_path(spark, "r")
    rows = stored(spark, [(1, 1, "a", 0.1), (1, 2, "b", 0.9), (2, 1, "c", 1.1), (3, 1, "d", 2.0)])
    rollup = rollups.TRANSACTIONS_HOURLY
    hours = [DAY + timedelta(hours=h) for h in range(4)]

    def counts():
        return {(r.hour - DAY) // timedelta(hours=1): r.tx_count
                for r in upkeep.read_rollup(spark, path).collect()}

    upkeep.refresh(rows, rollup, path, hours[0], hours[2])
    assert counts() == {0: 2, 1: 1}
    fewer = rows.filter("tx_hash <> 'b'").filter("tx_hash <> 'c'")
    upkeep.refresh(fewer, rollup, path, hours[1], hours[3])
    assert counts() == {0: 2, 2: 1}
    upkeep.refresh(fewer, rollup, path, hours[0], hours[1])
    assert counts() == {0: 1, 2: 1}
    with pytest.raises(ValueError):
        upkeep.refresh(rows, rollup, path, hours[0], hours[1] + timedelta(minutes=1))


def test_refresh_schedules():
    now = datetime(2024, 3, 1, 12, 7)
    assert rollups.TICKS_HOURLY.due(now) == (datetime(2024, 3, 1, 11), datetime(2024, 3, 1, 11))
    assert rollups.TICKS_HOURLY.due(datetime(2024, 3, 1, 12)) == (
        datetime(2024, 3, 1, 10), datetime(2024, 3, 1, 11)
    )
    assert rollups.TICK_TX_SUMMARY.due(now) == (datetime(2024, 3, 1, 11, 40), datetime(2024, 3, 1, 11, 55))


OTHER = "cd" * 32
FILES = [
    [tick(1), tick(2, transactions=[entry(1), entry(2)]), tick(3, transactions=[])],
    # 2 comes again with other content and fewer transactions; 1 is just repeated.
    [tick(2, arrival=4, output=OTHER, transactions=[entry(1)]), tick(1, arrival=5), tick(4, arrival=6),
     tick(5, arrival=7, vdf_proof=None)],
    # 6 comes twice in one batch; 7 only draws a warning.
    [tick(6, arrival=8), tick(6, arrival=9, output=OTHER, transactions=[entry(9)]),
     tick(7, arrival=10, iterations=0)],
]


def landed(spark, count, file_format="parquet"):
    path = scratch_path(spark, "landing")
    for i, rows in enumerate(FILES[:count]):
        frame(spark, rows).coalesce(1).write.mode("append").format(file_format).save(path)
    return path


def clock():
    at = NOW

    def tell():
        nonlocal at
        at += timedelta(seconds=1)
        return at

    return tell


def run_ingest(spark, path, root, checkpoint, file_format="parquet", **options):
    stream = sources.stream_ticks(spark, path, file_format, max_files=1)
    ingest.ingest(
        stream, root, checkpoint, trigger={"availableNow": True}, **options
    ).awaitTermination()


def contents(spark, root):
    rows = tables.read_current(lookup.live(ingest.stored_ticks(spark, root)), schemas.TICK_KEYS)
    pairs = tables.read_current(
        lookup.live(ingest.stored_transactions(spark, root)), schemas.TRANSACTION_KEYS
    )
    return (
        {r.tick_number: r.vdf_output for r in rows.collect()},
        {(r.tick_number, r.sequence_number) for r in pairs.collect()},
    )


def test_checked_ingest_with_restart_and_replay(spark):
    path, root, checkpoint = (scratch_path(spark, n) for n in ("landing", "root", "checkpoint"))
    tell = clock()
    # One file per start, so every batch but the first goes on from a checkpoint.
    for rows in FILES:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(path)
        run_ingest(spark, path, root, checkpoint, validate=True, clock=tell)
    wanted = (
        {1: HASH, 2: OTHER, 4: HASH, 6: OTHER, 7: HASH},
        {(1, 1), (2, 1), (4, 1), (6, 9), (7, 1)},
    )
    assert contents(spark, root) == wanted
    quarantine = spark.read.parquet(f"{root}/quarantine").collect()
    assert sorted((r.arrival, r.issues[0].rule) for r in quarantine) == [(5, "sequence"), (7, "not_null")]
    events = spark.read.parquet(f"{root}/invalidations").collect()
    assert sorted((r.tick_number, r.arrival, r.old_arrival) for r in events) == [(2, 4, 2), (6, 9, 8)]

    # The last batch again, as after a failure before its commit: nothing changes.
    before = ingest.stored_transactions(spark, root).count()
    ingest.ingest_batch(frame(spark, FILES[2]), root, 2, validate=True, clock=tell)
    assert contents(spark, root) == wanted
    assert ingest.stored_transactions(spark, root).count() == before
    assert spark.read.parquet(f"{root}/quarantine").count() == 2


@pytest.mark.parametrize("file_format", ["parquet", "json"])
def test_plain_ingest(spark, file_format):
    path, root = landed(spark, 3, file_format), scratch_path(spark, "root")
    run_ingest(spark, path, root, scratch_path(spark, "checkpoint"), file_format, clock=clock())
    found, pairs = contents(spark, root)
    assert set(found) == {1, 2, 4, 5, 6, 7} and (2, 2) in pairs
    batch = sources.read_ticks(spark, path, file_format, start_tick=6)
    assert {r.tick_number for r in batch.collect()} == {6, 7}
    with pytest.raises(ValueError):
        sources.read_ticks(spark, path, "csv")


def test_ingest_plugins_and_dry_run(spark, capfd):
    path, root = landed(spark, 2), scratch_path(spark, "root")
    written = []
    run_ingest(
        spark, path, root, scratch_path(spark, "checkpoint"),
        transform=lambda df: sources.from_tick(df, 2),
        write=lambda df, batch_id: written.append((batch_id, sorted(r.tick_number for r in df.collect()))),
    )
    assert sorted(n for _, numbers in written for n in numbers) == [2, 2, 3, 4, 5]
    assert [b for b, _ in written] == [0, 1]
    assert not folders.exists(spark, f"{root}/ticks")
    run_ingest(spark, path, root, scratch_path(spark, "checkpoint"), dry_run=True)
    assert not folders.exists(spark, f"{root}/ticks")
    assert "vdf_output" in capfd.readouterr().out


def streamed(spark, df, order, parts, run):
    """Collect a stream over ``df`` landing in several files, restarted after the first."""
    path, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "checkpoint"))
    rows = df.orderBy(*order).collect()
    size = -(-len(rows) // parts)
    for i in range(parts):
        part = spark.createDataFrame(rows[i * size:(i + 1) * size], df.schema)
        part.coalesce(1).write.mode("append").parquet(path)
        if i in (0, parts - 1):
            stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
            result = run(stream)
            query = (
                result.writeStream.format("parquet").option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start(out)
            )
            query.awaitTermination()
    return {tuple(r) for r in spark.read.schema(result.schema).parquet(out).collect()}


def rows_of(df):
    return {tuple(r) for r in df.collect()}


def test_thin_stream(spark):
    _, seen = observed(spark, 11)
    assert streamed(spark, seen, ["arrival"], 3, keyed.thin_stream) == rows_of(prices.thin(seen))


@pytest.mark.parametrize("idle_ms", [None, keyed.IDLE_MS])
def test_admit_stream(spark, idle_ms):
    _, seen = observed(spark, 11)
    visits = seen.select(F.col("market_id").alias("key"), F.col("poll_time").alias("ts"),
                         F.col("arrival").alias("event_id"))
    # With a time limit Spark would run empty batches for ever to look at the clock.
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        got = streamed(
            spark, visits, ["event_id"], 2, lambda s: keyed.admit_stream(s, 0.05, 3, idle_ms)
        )
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    assert got == rows_of(metrics.admit(visits, 0.05, 3))


def test_reorg_and_sequence_streams(spark):
    sent = spark.createDataFrame(copies(12), COPY)
    assert streamed(spark, sent, ["arrival"], 3, lambda s: keyed.reorg_stream(s, 3)) == rows_of(
        reorg.windowed_events(sent, 3)
    )
    slim = sent.select("source_id", "arrival", "tick_number", F.col("arrival").alias("timestamp"),
                       (F.col("tx_count") == 1).alias("good"))
    assert streamed(spark, slim, ["arrival"], 3, keyed.sequence_stream) == rows_of(
        quality.sequence_state(slim)
    )


def test_late_prices(spark):
    """Rows behind the watermark are missing from closed candles, not from the table."""
    def part(minutes):
        return spark.createDataFrame(
            [("m", DAY + timedelta(minutes=m), float(m), i) for i, m in enumerate(minutes)],
            "market_id string, ts timestamp, price double, arrival int",
        )

    path, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "checkpoint"))
    for minutes in ([1, 2], [61], [3], [125]):
        part(minutes).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(part([0]).schema).parquet(path)
        query = (
            live.live_candles(stream, "5m").writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
        )
        query.awaitTermination()
    closed = {(r.t - DAY) // timedelta(minutes=1): (r.o, r.c) for r in spark.read.parquet(out).collect()}
    assert closed == {0: (1, 2), 60: (61, 61)}


def test_touched_ranges(spark):
    rows = stored(spark, [(1, 1, "a", 0.2), (1, 1, "a", 1.2), (1, 1, "a", 5.0)])
    assert live.touched_ranges(rows, rollups.TRANSACTIONS_HOURLY) == [
        (DAY, DAY + timedelta(hours=2)), (DAY + timedelta(hours=5), DAY + timedelta(hours=6))
    ]


def test_a_batch_of_one_time_is_not_dealt_by_hour(spark, tmp_path, monkeypatch):
    """Ticks, transactions and quarantine of a batch go to one folder each, from the tasks that have them."""
    hints = []
    hint = DataFrame.hint
    monkeypatch.setattr(DataFrame, "hint", lambda self, *a: hints.append(self.columns) or hint(self, *a))
    orders = spark.createDataFrame([(k, k % 3) for k in range(200)], "o_orderkey bigint, o_custkey bigint")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    ticks = adapters.nested_ticks(spark, str(tmp_path))
    ingest.ingest_batch(ticks, f"{tmp_path}/plain", 0)
    assert hints == []
    ingest.ingest_batch(ticks, f"{tmp_path}/checked", 0, validate=True)
    assert [c for c in hints if "conflict_reason" not in c] == []
    assert lookup.live(ingest.stored_ticks(spark, f"{tmp_path}/plain")).count() > 100


def test_a_batch_is_not_kept_for_its_writes(spark, tmp_path, monkeypatch):
    """Whole nested ticks stay out of the executors' storage, and are sorted after the shuffle only."""
    kept, plans = [], []
    persist, save = ClassicFrame.persist, tables.replace_partitions
    monkeypatch.setattr(ClassicFrame, "persist", lambda self, *a: kept.append(self.columns) or persist(self, *a))
    monkeypatch.setattr(
        tables, "replace_partitions",
        lambda rows, *a: plans.append(rows._jdf.queryExecution().executedPlan().toString()) or save(rows, *a),
    )
    orders = spark.createDataFrame([(k, k % 3) for k in range(200)], "o_orderkey bigint, o_custkey bigint")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    ticks = adapters.nested_ticks(spark, str(tmp_path))
    ingest.ingest_batch(ticks, f"{tmp_path}/plain", 0)
    assert kept == [] and len(plans) == 2
    assert all("Sort" not in plan.split("Exchange")[-1] for plan in plans)
    got = lookup.live(ingest.stored_ticks(spark, f"{tmp_path}/plain")).select("tick_number").collect()
    filled = ticks.filter("exists(transactions, t -> t.transaction IS NOT NULL)").select("tick_number").distinct()
    assert sorted(got) == sorted(filled.collect())


def test_whole_ticks_are_not_kept_by_the_checks(spark, tmp_path, monkeypatch):
    """Checked ingest keeps slim frames only and folds once; hashes come back as they were."""
    kept, folds = [], []
    persist, emit = ClassicFrame.persist, ordered._emit_both
    monkeypatch.setattr(ClassicFrame, "persist", lambda self, *a: kept.append(self.columns) or persist(self, *a))
    monkeypatch.setattr(ordered, "_emit_both", lambda *a: folds.append(a[2]) or emit(*a))
    texts = [HASH, "AB" * 32, "", None, "zz", "0a" * 32]
    rows = [
        tick(n, transaction_batch_hash=texts[n % 6], transactions=[entry(1, texts[n % 6])])
        for n in range(1, 30)
    ]
    stale = [tick(7, arrival=40), tick(3, arrival=41, previous_output="cd" * 32), tick(4, arrival=42, timestamp=0)]
    lacking = [tick(50, arrival=50, vdf_proof=None, transaction_batch_hash="AB")]
    root = f"{tmp_path}/root"
    ingest.ingest_batch(frame(spark, rows + stale + lacking), root, 0, validate=True, clock=lambda: NOW)
    assert kept and all("transactions" not in columns and "vdf_proof" not in columns for columns in kept)
    assert len(folds) == 2 and all("output" not in keep for keep in folds)
    got = {r.tick_number: r for r in ingest.stored_ticks(spark, root).collect()}
    assert set(got) == set(range(1, 30))
    assert all((got[n].transaction_batch_hash or "") == (texts[n % 6] or "") for n in got if n not in (3, 4, 7))
    assert got[3].previous_output == "cd" * 32 and got[3].transaction_batch_hash == HASH
    held = {r.arrival: r for r in spark.read.parquet(f"{root}/quarantine").collect()}
    assert set(held) == {50} and held[50].transaction_batch_hash == "AB"
    assert held[50].transactions[0].tx_hash == HASH
