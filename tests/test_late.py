"""Rows behind the watermark are counted per batch."""

from __future__ import annotations

import time
from datetime import datetime, timedelta

from ticklake.functions.session import scratch_path
from ticklake.streaming import late, live

DAY = datetime(2024, 1, 1)
SCHEMA = "market_id string, ts timestamp_ntz, price double"


def append(spark, path, minutes):
    rows = [("m", m if m is None else DAY + timedelta(minutes=m), 1.0) for m in minutes]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_accounts_over_restarts_and_repeats(spark):
    source, path, checkpoint = (scratch_path(spark, n) for n in ("in", "accounts", "cp"))
    stored = []

    def run(minutes):
        append(spark, source, minutes)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        write = late.account(lambda b, i: stored.append((i, b.count())), path, "ts", "10 minutes")
        query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start().awaitTermination()

    run([100, 0, None])
    run([89, 90, 89, 95, None, 130])
    run([119, 20, 120, 110])
    run([119, 121, 119, 119])  # nothing newer came, so the watermark stays
    table = late.accounts(spark, path).orderBy("batch_id").collect()
    assert [(r.batch_id, r.n_rows, r.n_late) for r in table] == [(0, 3, 0), (1, 6, 2), (2, 4, 3), (3, 4, 3)]
    minutes = lambda t: t and (t - DAY) / timedelta(minutes=1)
    assert [(minutes(r.watermark), minutes(r.newest)) for r in table] == [(None, 100), (90, 130), (120, 130), (120, 130)]
    assert stored == [(r.batch_id, r.n_rows) for r in table]

    again = late.account(lambda b, i: None, path, "ts", "10 minutes")
    again(spark.createDataFrame([("m", DAY, 1.0)], SCHEMA), 3)
    assert [r.n_late for r in late.accounts(spark, path).orderBy("batch_id").collect()] == [0, 2, 3, 1]
    again(spark.createDataFrame([], SCHEMA), 4)
    again(spark.createDataFrame([("m", DAY, 1.0)], SCHEMA), 5)
    assert [r.n_late for r in late.accounts(spark, path).orderBy("batch_id").collect()] == [0, 2, 3, 1, 0, 1]


def test_rows_that_operators_drop(spark):
    source, path, checkpoint, out = (scratch_path(spark, n) for n in ("in", "dropped", "cp", "out"))
    listener = late.DroppedRows(spark, path, {"unique_prices"})
    spark.streams.addListener(listener)
    try:
        for minutes in ([0, 100, 100], [5, 6, 99, 95], [200]):
            append(spark, source, minutes)
            stream = spark.readStream.schema(SCHEMA).parquet(source)
            unique = live.deduplicate_prices(stream, "10 minutes")
            query = (
                unique.writeStream.queryName("unique_prices").format("parquet").option("path", out)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
            )
            query.awaitTermination()
        found = []
        for _ in range(60):  # reports come a little later than the rows
            try:
                found = [(r.query, r.n_dropped) for r in late.dropped(spark, path).filter("n_rows > 0").orderBy("batch_id").collect()]
            except Exception:  # nothing written yet
                found = []
            if len(found) == 3:
                break
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    assert found == [("unique_prices", n) for n in (0, 2, 0)]
