"""Streams that give each bucket once, exactly, over restarts and behind-the-watermark rows."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ticklake import schemas
from ticklake.functions.session import scratch_path
from ticklake.operators import rollups
from ticklake.streaming import closing, signers

DAY = datetime(2024, 1, 1)


def transactions(spark, rows):
    return spark.createDataFrame(
        [(t, 1, "h", "id", 1, b"p", 0, k and k.encode(), b"s", 0, DAY + timedelta(minutes=x), size, kind, 1)
         for t, k, kind, x, size in rows], schemas.TRANSACTIONS,
    )


@pytest.mark.parametrize("lanes", [1, 3])
def test_hourly_over_a_restart(spark, lanes):
    rollup = rollups.TRANSACTIONS_HOURLY
    source, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "cp"))
    first = [(i, [None, "a", "b", "c", "d"][i % 5], "xy"[i % 2], i * 2, i if i % 3 else None) for i in range(100)]
    second = [(500 + i, "ae"[i % 2], None, 170 + i, 7) for i in range(180)]
    late = [(9, "late", "x", 5, 1), (9, "late", None, 160, 1)]  # behind the watermark of the first run

    def run(rows):
        transactions(spark, rows).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schemas.TRANSACTIONS).parquet(source)
        closed = signers.closed_buckets(stream, rollup, "30 minutes", lanes)
        query = (
            closed.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return signers.whole_buckets(spark.read.schema(closed.schema).parquet(out), rollup)

    def as_rows(found):
        return sorted((tuple(r[c] for c in sorted(found.columns)) for r in found.collect()), key=str)

    def wanted(rows, until):
        inside = [r for r in rows if r[3] < until]
        return as_rows(rollup.compute(transactions(spark, inside)))

    # watermark: 198 - 30 minutes, so two hours are closed
    assert as_rows(run(first)) == wanted(first, 120)
    # 349 - 30: five hours
    assert as_rows(run(second + late)) == wanted(first + second, 300)
    hours = spark.read.parquet(out).groupBy("begins_us", "group_payload_type", "lane").count()
    assert hours.filter("count > 1").isEmpty()
    assert signers.closed_buckets(
        spark.readStream.schema(schemas.TRANSACTIONS).parquet(source), rollups.TICK_TX_SUMMARY
    ).columns[:2] == ["begins_us", "group_tick_number"]


def test_lanes_add_up(spark):
    closed = spark.createDataFrame(
        [(0, 7, lane, 3 + lane, 2, 10, None, None, 2) for lane in range(3)],
        "begins_us long, group_tick_number long, lane int, n long, sized long, bytes long, low long, high long, signers long",
    )
    row = signers.whole_buckets(closed, rollups.TICK_TX_SUMMARY).select(F.unix_micros("bucket"), "*").first()
    assert (row[0], row.tick_number, row.tx_count, row.unique_signers, row.total_payload_bytes) == (0, 7, 12, 6, 30)
    assert row.avg_payload_size == 5.0


@pytest.mark.parametrize("fill", ["locf", "null"])
def test_candles_over_a_restart(spark, fill):
    source, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "cp"))
    kinds = "market_id string, ts timestamp, price decimal(18,8)"

    def run(rows):
        table = spark.createDataFrame([(m, DAY + timedelta(seconds=s), str(p)) for m, s, p in rows], "m string, ts timestamp, p string")
        table.selectExpr("m AS market_id", "ts", "cast(p AS decimal(18,8)) AS price").coalesce(1).write.mode("append").parquet(source)
        closed = closing.closed_candles(spark.readStream.schema(kinds).parquet(source), "1m", "2 minutes", fill)
        closed.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(
            availableNow=True
        ).start().awaitTermination()
        found = spark.read.schema(closed.schema).parquet(out).collect()
        return sorted(
            ((r.market_id, int((r.t - DAY).total_seconds()), r.o, r.h, r.l, r.c) for r in found), key=str
        )

    first = [("m", 5, 2), ("m", 50, 1), ("m", 30, 3), ("m", 200, 4), ("n", 130, 9), ("m", 600, 5)]
    # watermark 480 s: buckets up to 420 s are closed
    gap = (lambda c: (c,) * 4) if fill == "locf" else (lambda c: (None,) * 4)
    wanted = [("m", 0, 2.0, 3.0, 1.0, 1.0), ("m", 180, 4.0, 4.0, 4.0, 4.0), ("n", 120, 9.0, 9.0, 9.0, 9.0)]
    wanted += [("m", t, *gap(1.0)) for t in (60, 120)] + [("m", t, *gap(4.0)) for t in range(240, 480, 60)]
    wanted += [("n", t, *gap(9.0)) for t in range(180, 480, 60)]
    assert run(first) == sorted(wanted, key=str)
    # one price is late; a silent market goes on; the open candle of 600 s gets another price
    second = [("m", 100, 77), ("m", 610, 6), ("n", 900, 1)]
    wanted += [("m", t, *gap(4.0)) for t in (480, 540)] + [("m", 600, 5.0, 6.0, 5.0, 6.0)]
    wanted += [("m", t, *gap(6.0)) for t in (660, 720)] + [("n", t, *gap(9.0)) for t in range(480, 780, 60)]
    assert run(second) == sorted(wanted, key=str)
    with pytest.raises(ValueError):
        closing.closed_candles(spark.readStream.schema(kinds).parquet(source), fill="zero")
