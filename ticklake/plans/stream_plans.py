"""Streaming forms, run until their input is used up and compared with the batch forms."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake import schemas
from ticklake.functions.session import scratch_path
from ticklake.operators import candles, lookup, quality, rollups
from ticklake.plans import adapters as a
from ticklake.plans import chain_plans, metric_plans, price_plans, quality_plans
from ticklake.sinks import tables, upkeep
from ticklake.streaming import closing, ingest, keyed, late, live, signers


class StreamInput:
    """Stands in for a session where an adapter reads a table, and opens it as a stream."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    @property
    def read(self) -> "StreamInput":
        return self

    def parquet(self, path: str) -> DataFrame:
        schema = self.spark.read.parquet(path).schema
        # As a pattern the path may name one file as well as a folder of files.
        return self.spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")


def _run(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Write a stream to files until its input is used up, and read them."""
    spark = stream.sparkSession
    out, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    if mode == "append":
        writer = stream.writeStream.format("parquet").option("path", out)
    else:

        def save(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(out)

        writer = stream.writeStream.outputMode(mode).foreachBatch(save)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def _sequence(spark, sf_dir):
    slim = quality.slim_ticks(a.nested_ticks(StreamInput(spark), sf_dir), quality_plans.NOW)
    return _run(keyed.sequence_stream(slim), "sequence").drop("good")


def _reorg(spark, sf_dir):
    rows = a.tick_copies(StreamInput(spark), sf_dir)
    return _run(keyed.reorg_stream(rows), "reorg")


def _thin(spark, sf_dir):
    observed = a.observed_prices(StreamInput(spark), sf_dir)
    return _run(keyed.thin_stream(observed, heartbeat_seconds=7200), "thin")


def _admit(spark, sf_dir):
    visits = a.visits(StreamInput(spark), sf_dir)
    return _run(keyed.admit_stream(visits, 1 / 3600, 2, idle_ms=None), "admit")


def _live_candles(spark, sf_dir):
    prices = a.market_prices(StreamInput(spark), sf_dir)
    rows = _run(live.live_candles(prices, "15m", "30 days"), "candles", "complete")
    return rows.withColumn("t", F.col("t").cast("timestamp_ntz"))


def _closed_candles(fill):
    """Candles that closed a day before the newest price, without gaps."""

    def query(spark, sf_dir):
        prices = a.market_prices(StreamInput(spark), sf_dir)
        rows = _run(closing.closed_candles(prices, "15m", "1 day", fill), "closed")
        return rows.withColumn("t", F.col("t").cast("timestamp_ntz"))

    return query


def _live_ticks(spark, sf_dir):
    """Per-minute ticks are stored first; their stream feeds the rollup."""
    stored = scratch_path(spark, "ticks")
    a.ticks_dense(spark, sf_dir).write.parquet(stored)
    stream = StreamInput(spark).parquet(stored)
    rows = _run(live.live_ticks_hourly(stream, "30 days"), "hourly", "complete")
    return rows.withColumn("hour", F.col("hour").cast("timestamp_ntz"))


def _closed(rollup):
    """A rollup in ``append`` mode: buckets that closed before the watermark of the end, which
    is an hour behind the newest row."""

    def query(spark, sf_dir):
        stored = scratch_path(spark, f"{rollup.name}-rows")
        a.transactions_squeezed(spark, sf_dir).write.parquet(stored)
        stream = StreamInput(spark).parquet(stored)
        closed = _run(signers.closed_buckets(stream, rollup, "1 hour", lanes=2), rollup.name)
        rows = signers.whole_buckets(closed, rollup)
        return rows.withColumn(rollup.bucket, F.col(rollup.bucket).cast("timestamp_ntz"))

    return query


def _refreshed(rollup, source):
    """A rollup kept by a stream that recomputes the buckets each batch touches."""

    def query(spark, sf_dir):
        path = scratch_path(spark, rollup.name)
        stored = scratch_path(spark, f"{rollup.name}-rows")
        source(spark, sf_dir).write.parquet(stored)
        run = live.refresh_touched(lambda s: s.read.parquet(stored), rollup, path)
        stream = StreamInput(spark).parquet(stored)
        started = (
            stream.writeStream.foreachBatch(run)
            .option("checkpointLocation", scratch_path(spark, "checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        started.awaitTermination()
        return upkeep.read_rollup(spark, path)

    return query


def _refreshed_in_steps(spark, sf_dir):
    """An hourly rollup refreshed range by range, one of them twice."""
    path = scratch_path(spark, "transactions_hourly")
    rows = a.transactions_squeezed(spark, sf_dir)
    begin = datetime(2024, 1, 1)
    for since, until in [(0, 10), (10, 20), (10, 20), (20, 31)]:
        upkeep.refresh(
            rows, rollups.TRANSACTIONS_HOURLY, path,
            begin + timedelta(hours=since), begin + timedelta(hours=until),
        )
    return upkeep.read_rollup(spark, path)


def _stored_prices(spark, sf_dir):
    """Prices stored in two overlapping batches; the first one of a time stays."""
    path = scratch_path(spark, "prices")
    rows = a.observed_prices(spark, sf_dir).select(
        "market_id", F.date_trunc("hour", "poll_time").cast("timestamp_ntz").alias("ts"),
        "price", "arrival",
    )
    first = rows.filter(F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    tables.write_prices(first, path, 0)
    tables.write_prices(rows, path, 1)
    tables.write_prices(rows, path, 1)
    return tables.read_prices(spark, path, "timestamp_ntz").select(
        "market_id", "ts", F.col("price").cast("double").alias("price")
    )


def _deduplicated(spark, sf_dir):
    """Hourly times, so that most rows repeat one; which price stays is not defined."""
    prices = a.market_prices(StreamInput(spark), sf_dir).withColumn(
        "ts", F.date_trunc("hour", "ts").cast("timestamp_ntz")
    )
    rows = _run(live.deduplicate_prices(prices, "30 days"), "unique")
    return rows.select("market_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


def _ingest(spark, sf_dir, validate):
    root = scratch_path(spark, "chain")
    started = ingest.ingest(
        a.nested_ticks(StreamInput(spark), sf_dir), root, scratch_path(spark, "checkpoint"),
        validate=validate, clock=lambda: quality_plans.NOW, trigger={"availableNow": True},
    )
    started.awaitTermination()
    return root


def _ingested_transactions(spark, sf_dir):
    root = _ingest(spark, sf_dir, validate=False)
    rows = lookup.live(ingest.stored_transactions(spark, root))
    return tables.read_current(rows, schemas.TRANSACTION_KEYS).select(
        "tick_number", "sequence_number", "tx_hash", "payload_size", "payload_type"
    )


def _ingested_ticks(spark, sf_dir):
    root = _ingest(spark, sf_dir, validate=True)
    rows = lookup.live(ingest.stored_ticks(spark, root))
    return tables.read_current(rows, schemas.TICK_KEYS).select("tick_number", "tx_count")


def _upserted(spark, sf_dir):
    """Stored as two batches, the second one twice: the newest row of each key stays."""
    path = scratch_path(spark, "transactions")
    rows = a.transactions_squeezed(spark, sf_dir).withColumns(
        {
            "sequence_number": F.col("nonce") % 3,
            "tick_number": F.floor(F.col("tick_number") / 100),
            "processed_at": F.col("processed_at").cast("timestamp"),
        }
    )
    for batch_id in (0, 1, 1):
        tables.write_rows(rows, path, schemas.TRANSACTION_KEYS, batch_id)
    stored = tables.read_rows(spark, path, schemas.TRANSACTIONS)
    return tables.read_current(stored, schemas.TRANSACTION_KEYS).select(
        "tick_number", "sequence_number", "tx_hash",
        F.col("processed_at").cast("timestamp_ntz").alias("processed_at"),
    )


def _late_rows(spark, sf_dir):
    """Transactions come in four batches; each counts those a day behind the batches before."""
    stored, path = scratch_path(spark, "rows"), scratch_path(spark, "late")
    rows = a.transactions_dense(spark, sf_dir).select(
        "sequence_number", F.col("processed_at").cast("timestamp").alias("processed_at")
    )
    files = 4
    for part in range(4):
        batch = rows.filter(F.col("sequence_number") % 4 == part)
        batch.repartition(files).write.mode("append").parquet(stored)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(stored)
    run = late.account(lambda batch, batch_id: None, path, lateness="1 day")
    started = (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", scratch_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    ntz = {c: F.col(c).cast("timestamp_ntz") for c in ("watermark", "newest")}
    return late.accounts(spark, path).withColumns(ntz)


QUERIES = {
    "stream_late_rows": _late_rows,
    "stream_sequence_state": _sequence,
    "stream_reorg_events": _reorg,
    "stream_prices_thinned": _thin,
    "stream_rate_limited": _admit,
    "stream_live_candles": _live_candles,
    "stream_ticks_hourly": _live_ticks,
    "stream_transactions_hourly": _refreshed(rollups.TRANSACTIONS_HOURLY, a.transactions_squeezed),
    "stream_unique_prices": _deduplicated,
    "stream_ingested_transactions": _ingested_transactions,
    "stream_ingested_ticks_checked": _ingested_ticks,
    "refreshed_in_steps": _refreshed_in_steps,
    "stream_candles_closed": _closed_candles("locf"),
    "stream_candles_closed_gaps": _closed_candles("null"),
    "stream_transactions_hourly_closed": _closed(rollups.TRANSACTIONS_HOURLY),
    "stream_tick_summary_closed": _closed(rollups.TICK_TX_SUMMARY),
    "stored_prices_first_wins": _stored_prices,
    "stored_transactions_upsert": _upserted,
}

_CANDLES = """SELECT market_id, time_bucket(INTERVAL 900 SECOND, ts, TIMESTAMP '1970-01-01') AS t,
  CAST(arg_min(price, ts) AS DOUBLE) AS o, CAST(max(price) AS DOUBLE) AS h,
  CAST(min(price) AS DOUBLE) AS l, CAST(arg_max(price, ts) AS DOUBLE) AS c
FROM market_prices GROUP BY 1, 2"""
_ALL_CANDLES = f"WITH {a.MARKET_PRICES} {_CANDLES}"

_CLOSED_CANDLES = f"""WITH {a.MARKET_PRICES}, found AS ({_CANDLES}),
spans AS (
  SELECT market_id, min(t) AS first, time_bucket(INTERVAL 900 SECOND,
    (SELECT max(ts) FROM market_prices) - INTERVAL 1 DAY, TIMESTAMP '1970-01-01')
    - INTERVAL 900 SECOND AS last FROM found GROUP BY market_id),
filled AS (
  SELECT g.market_id, g.t, f.o, f.h, f.l, f.c FROM (
    SELECT market_id, unnest(generate_series(first, last, INTERVAL 900 SECOND)) AS t FROM spans) g
  LEFT JOIN found f ON f.market_id = g.market_id AND f.t = g.t)"""

SQL = {
    "stream_late_rows": f"""WITH {a.TRANSACTIONS_DENSE},
batches AS (
  SELECT sequence_number % 4 AS batch_id, max(processed_at) AS top FROM transactions GROUP BY 1),
marks AS (
  SELECT batch_id, max(top) OVER (ORDER BY batch_id) AS newest, max(top) OVER (ORDER BY batch_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 DAY AS watermark FROM batches)
SELECT batch_id, count(*) AS n_rows, count(*) FILTER (processed_at < watermark) AS n_late,
  any_value(watermark) AS watermark, any_value(newest) AS newest
FROM transactions JOIN marks ON sequence_number % 4 = batch_id GROUP BY batch_id""",
    "stream_candles_closed": f"""{_CLOSED_CANDLES}, carried AS (
  SELECT *, last_value(c IGNORE NULLS) OVER (PARTITION BY market_id ORDER BY t
    ROWS UNBOUNDED PRECEDING) AS seen FROM filled)
SELECT market_id, t, coalesce(o, seen) AS o, coalesce(h, seen) AS h, coalesce(l, seen) AS l,
  coalesce(c, seen) AS c FROM carried""",
    "stream_candles_closed_gaps": f"{_CLOSED_CANDLES} SELECT * FROM filled",
    "stream_sequence_state": quality_plans.SQL["sequence_state_exact"],
    "stream_reorg_events": quality_plans.SQL["reorg_events_windowed"],
    "stream_prices_thinned": price_plans.SQL["prices_thinned"],
    "stream_rate_limited": metric_plans.SQL["rate_limited"],
    "stream_live_candles": _ALL_CANDLES,
    "stream_ticks_hourly": chain_plans.ROLLUP_SQL["ticks_hourly"],
    "stream_transactions_hourly": chain_plans.SQUEEZED_SQL,
    "stream_unique_prices": "SELECT DISTINCT event_type AS market_id, "
    "date_trunc('hour', ts) AS ts FROM events",
    "stream_ingested_transactions": f"""{chain_plans._EXPLODED}
SELECT tick_number, sequence_number, tx_hash, payload_size,
  CASE WHEN payload_size = 0 THEN 'empty' WHEN payload_size < 32 THEN 'small' ELSE 'medium' END
    AS payload_type FROM flat
QUALIFY row_number() OVER (PARTITION BY tick_number, sequence_number
  ORDER BY arrival DESC, tx_hash DESC) = 1""",
    "refreshed_in_steps": chain_plans.SQUEEZED_SQL,
    "stream_transactions_hourly_closed": f"""WITH {a.TRANSACTIONS_SQUEEZED} {chain_plans.HOURLY_TRANSACTIONS}
WHERE epoch_ms(date_trunc('hour', processed_at)) + 3600000
  <= (SELECT epoch_ms(max(processed_at)) FROM transactions) - 3600000 GROUP BY 1, 2""",
    "stream_tick_summary_closed": f"""WITH {a.TRANSACTIONS_SQUEEZED} {chain_plans.TICK_SUMMARY}
WHERE epoch_ms(time_bucket(INTERVAL 300 SECOND, processed_at, TIMESTAMP '1970-01-01')) + 300000
  <= (SELECT epoch_ms(max(processed_at)) FROM transactions) - 3600000 GROUP BY 1, 2""",
    "stored_prices_first_wins": f"""WITH {a.OBSERVED_PRICES}
SELECT market_id, date_trunc('hour', poll_time) AS ts, arg_min(price, arrival) AS price
FROM observed GROUP BY 1, 2""",
    "stored_transactions_upsert": f"""WITH {a.TRANSACTIONS_SQUEEZED}
SELECT tick_number // 100 AS tick_number, nonce % 3 AS sequence_number, tx_hash, processed_at
FROM transactions
QUALIFY row_number() OVER (PARTITION BY tick_number // 100, nonce % 3
  ORDER BY processed_at DESC) = 1""",
}
