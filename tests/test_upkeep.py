"""Exact counts from stored changes, dirty buckets, and compaction that may stop anywhere."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ticklake import schemas
from ticklake.functions.session import scratch_path
from ticklake.operators import rollups
from ticklake.sinks import dirty, folders, signers, tables, upkeep

DAY = datetime(2024, 1, 1)
SIGNED = [rollups.TRANSACTIONS_HOURLY, rollups.TICK_TX_SUMMARY]


def transactions(spark, rows):
    """Transactions from (tick, sequence, signer, type, minutes after DAY, payload bytes)."""
    return spark.createDataFrame(
        [(t, s, f"h{t}-{s}", "id", 1, b"p", 0, k and k.encode(), b"s", 0, DAY + timedelta(minutes=x), size, kind, 1)
         for t, s, k, kind, x, size in rows], schemas.TRANSACTIONS,
    )


def some(n, shift=0):
    return [
        (i % 7 + shift, i, [None, "a", "b", "c"][i % 4], ["x", "y", None][i % 3], (i * 37) % 300, None if i % 5 == 0 else i)
        for i in range(n)
    ]


def as_rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


@pytest.mark.parametrize("rollup", SIGNED, ids=lambda r: r.name)
def test_counts_from_changes_equal_the_full_computation(spark, rollup):
    path = scratch_path(spark, "changes")
    first, second, late = some(90), some(60, shift=3), some(25, shift=50)
    wrong = first[10:40] + second[::2]
    signers.store_changes(rollup, path, 0, transactions(spark, first))
    for _ in range(2):  # a batch that runs again
        signers.store_changes(rollup, path, 1, transactions(spark, second), transactions(spark, first[10:40]))
    signers.store_changes(rollup, path, 2, added=transactions(spark, late), removed=transactions(spark, second[::2]))
    left = [r for r in first + second + late if r not in wrong]
    got = signers.read_counts(spark, path, rollup)
    assert as_rows(got) == as_rows(rollup.compute(transactions(spark, left)))
    since, until = DAY + timedelta(hours=1), DAY + timedelta(hours=3)
    part = signers.read_counts(spark, path, rollup, since, until)
    inside = [r for r in left if 60 <= r[4] < 180]
    assert as_rows(part) == as_rows(rollup.compute(transactions(spark, inside)))
    assert set(got.columns) == set(rollup.compute(transactions(spark, left)).columns)


def test_everything_taken_back(spark):
    path = scratch_path(spark, "changes")
    rows = transactions(spark, some(20))
    signers.store_changes(rollups.TRANSACTIONS_HOURLY, path, 0, rows)
    signers.store_changes(rollups.TRANSACTIONS_HOURLY, path, 1, removed=rows)
    assert signers.read_counts(spark, path, rollups.TRANSACTIONS_HOURLY).collect() == []


def test_dirty_buckets(spark, monkeypatch):
    rollup, path, log = rollups.TRANSACTIONS_HOURLY, scratch_path(spark, "r"), scratch_path(spark, "log")
    stored = scratch_path(spark, "t")
    rows = some(120)
    tables.write_rows(transactions(spark, rows), stored, schemas.TRANSACTION_KEYS, 0)

    def source():
        return tables.read_rows(spark, stored, schemas.TRANSACTIONS)

    def hours(found):
        return [(b - DAY) // timedelta(hours=1) for b in found]

    def left():
        return sorted(hours(r.bucket for r in dirty.dirty(spark, rollup, log).collect()))

    def counted():
        return {(r.hour.replace(tzinfo=None) - DAY) // timedelta(hours=1) for r in upkeep.read_rollup(spark, path).collect()}

    assert dirty.run_due(source(), rollup, path, log, DAY + timedelta(hours=4)) == []
    for _ in range(2):
        dirty.mark(transactions(spark, rows), rollup, log, 1)
    assert left() == [0, 1, 2, 3, 4]
    # due at 5:10: whole hours from 3:10 on, up to 4:10; at 5:00 the hour from 3:00
    assert dirty.run_due(source(), rollup, path, log, DAY + timedelta(hours=5, minutes=10)) == []
    assert hours(dirty.run_due(source(), rollup, path, log, DAY + timedelta(hours=5))) == [3]
    assert counted() == {3}
    assert dirty.run_due(source(), rollup, path, log, DAY + timedelta(hours=5)) == []
    before = left()
    assert before == [0, 1, 2, 4]
    # a late row marks a bucket that was clean, and one that is not due
    late = [(99, 1, "z", "x", 130, 7), (99, 2, "z", "x", 5, 7)]
    tables.write_rows(transactions(spark, late), stored, schemas.TRANSACTION_KEYS, 1)
    dirty.mark(transactions(spark, late), rollup, log, 2)
    assert left() == sorted({*before, 2, 0})

    # a run that stops before its log entry is run again
    def stop(*_):
        raise OSError("stopped")

    with monkeypatch.context() as patched:
        patched.setattr(dirty, "_log", stop)
        with pytest.raises(OSError):
            dirty.run_between(source(), rollup, path, log, DAY, DAY + timedelta(hours=24))
    assert left() == sorted({*before, 2, 0})
    assert hours(dirty.run_between(source(), rollup, path, log, DAY, DAY + timedelta(hours=24))) == sorted({*before, 2, 0})
    assert left() == []
    got = upkeep.read_rollup(spark, path)
    assert as_rows(got) == as_rows(rollup.compute(transactions(spark, rows + late)))


def test_only_dirty_buckets_are_read(spark):
    rollup, path, stored = rollups.TRANSACTIONS_HOURLY, scratch_path(spark, "r"), scratch_path(spark, "t")
    tables.write_rows(transactions(spark, some(120)), stored, schemas.TRANSACTION_KEYS, 0)
    seen = []
    spy = rollups.Rollup(
        rollup.name, lambda rows: seen.append(rows) or rollup.compute(rows), rollup.bucket, rollup.width,
        rollup.start_offset, rollup.end_offset, rollup.schedule,
    )
    upkeep.refresh_buckets(tables.read_rows(spark, stored, schemas.TRANSACTIONS), spy, path, [DAY, DAY + timedelta(hours=3)])
    files = {f.split("p_hour=")[1].split("/")[0] for f in seen[0].select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert files == {"0", "3"} and len(seen) == 1
    upkeep.refresh_buckets(transactions(spark, some(120)).filter("tick_number < 0"), spy, path, [DAY])
    assert {r.hour.hour for r in upkeep.read_rollup(spark, path).collect()} == {3}
    with pytest.raises(ValueError):
        upkeep.refresh_buckets(transactions(spark, some(5)), spy, path, [DAY + timedelta(minutes=1)])


class Stopped(Exception):
    pass


def stop_at(monkeypatch, step):
    """Stop a compaction at its n-th change of the file system."""
    done = 0
    for name in ("write_lines", "delete"):
        real = getattr(folders, name)

        def counted(*args, real=real):
            nonlocal done
            if done == step:
                raise Stopped
            done += 1
            return real(*args)

        monkeypatch.setattr(folders, name, counted)


def test_compaction_may_stop_anywhere(spark, monkeypatch):
    path, kinds = scratch_path(spark, "p"), "market_id string, ts timestamp, price decimal(18,8)"
    wanted = []
    for batch in range(3):
        rows = [("m", DAY + timedelta(hours=30 * h + batch), float(h + batch), h) for h in range(3)]
        tables.write_prices(spark.createDataFrame(rows, "market_id string, ts timestamp, price double, arrival int"), path, batch)
        wanted += [(m, t, p) for m, t, p, _ in rows]

    def read():
        return sorted((r.market_id, r.ts, float(r.price)) for r in tables.read_prices(spark, path).collect())

    def run():
        return upkeep.compact(spark, path, kinds, DAY + timedelta(days=30), timedelta(days=7), ["market_id", "ts"], hourly=False)

    assert read() == sorted(wanted)
    stops = 0
    for step in range(40):
        try:
            with monkeypatch.context() as patched:
                stop_at(patched, step)
                run()
        except Stopped:
            stops += 1
            assert read() == sorted(wanted)
            continue
        break
    assert stops >= 8 and read() == sorted(wanted)
    assert run() == 0
    left = folders.partitions(spark, path, ["p_date", "batch_id"])
    assert len({v["p_date"] for v, _ in left}) == len(left) and all(int(v["batch_id"]) < 0 for v, _ in left)
    # a later batch, and compaction of what was compacted
    more = [("m", DAY + timedelta(hours=9), 1.0, 1)]
    tables.write_prices(spark.createDataFrame(more, "market_id string, ts timestamp, price double, arrival int"), path, 9)
    wanted.append(("m", DAY + timedelta(hours=9), 1.0))
    assert run() == 1 and read() == sorted(wanted)


def test_compaction_keeps_the_newest_row_of_a_key(spark):
    path = scratch_path(spark, "t")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.TRANSACTIONS.fields)
    for batch, signer in enumerate(["a", "b", "c"]):
        tables.write_rows(transactions(spark, [(1, 1, signer, "x", 5, 1), (2, batch, signer, "x", 6, 1)]), path, schemas.TRANSACTION_KEYS, batch)
    options = (ddl, DAY + timedelta(hours=9), timedelta(hours=2), schemas.TRANSACTION_KEYS)
    assert upkeep.compact(spark, path, *options, keys=schemas.TRANSACTION_KEYS) == 1
    rows = tables.read_rows(spark, path, schemas.TRANSACTIONS)
    assert sorted((r.tick_number, r.sequence_number, bytes(r.public_key)) for r in rows.collect()) == [
        (1, 1, b"c"), (2, 0, b"a"), (2, 1, b"b"), (2, 2, b"c")
    ]
    # of equal times, a batch after the compaction still comes later
    tables.write_rows(transactions(spark, [(1, 1, "d", "x", 5, 1)]), path, schemas.TRANSACTION_KEYS, 3)
    kept = tables.read_current(tables.read_rows(spark, path, schemas.TRANSACTIONS), schemas.TRANSACTION_KEYS)
    assert {bytes(r.public_key) for r in kept.filter("tick_number = 1").collect()} == {b"d"}


def test_prices_read_only_the_dates_of_the_batch(spark):
    path = scratch_path(spark, "p")
    kinds = "market_id string, ts timestamp, price double, arrival int"
    days = [("m", DAY + timedelta(days=d), 1.0, d) for d in range(9)]
    tables.write_prices(spark.createDataFrame(days, kinds), path, 0)
    wide = spark.createDataFrame([("m", DAY, 2.0, 1), ("m", DAY + timedelta(days=8), 2.0, 2), ("n", DAY + timedelta(days=20), 3.0, 3)], kinds)
    tables.write_prices(wide, path, 1)
    assert tables.read_prices(spark, path).count() == 10
    tables.write_prices(wide.filter("price > 9"), path, 2)
    assert tables.read_prices(spark, path).count() == 10
