"""Windowed aggregates over streams."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.operators import candles, rollups
from ticklake.operators.prices import KEYS
from ticklake.sinks.upkeep import refresh


def _timed(rows: DataFrame, time: str, lateness: str) -> DataFrame:
    """Watermarks need a time with zone; times without one are taken as UTC."""
    return rows.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness)


def live_candles(
    prices: DataFrame, tf: str = candles.DEFAULT_TIMEFRAME, lateness: str = "10 minutes"
) -> DataFrame:
    """Candles of a price stream. In output mode ``update`` each new price changes its
    candle or opens one; ``append`` gives only candles that cannot change any more.
    Prices later than ``lateness`` are still stored by their own stream, but not seen
    here; refreshing a rollup or reading candles from the table repairs that."""
    return candles.ohlc(_timed(prices, "ts", lateness), tf)


def live_ticks_hourly(ticks: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """The hourly tick rollup of a stream of stored rows."""
    return rollups.ticks_hourly(_timed(ticks, "processed_at", lateness))


def live_transactions_hourly(transactions: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """The hourly transaction rollup with approximate signers: Spark does not keep exact
    distinct counts over a stream. ``refresh_touched`` gives exact ones."""
    rows = _timed(transactions, "processed_at", lateness)
    return rollups.transactions_hourly(rows, approximate=True)


def live_tick_summary(transactions: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    rows = _timed(transactions, "processed_at", lateness)
    return rollups.tick_tx_summary(rows, approximate=True)


def touched_ranges(rows: DataFrame, rollup: rollups.Rollup) -> list[tuple[datetime, datetime]]:
    """Time ranges of the buckets that rows fall into, neighbouring ones joined. At most
    one row per bucket of the batch comes to the driver."""
    start = candles.bucket_start("processed_at", rollup.width).cast("timestamp_ntz")
    begins = sorted(r["b"] for r in rows.select(start.alias("b")).distinct().collect())
    ranges: list[tuple[datetime, datetime]] = []
    for begin in begins:
        if ranges and ranges[-1][1] == begin:
            ranges[-1] = (ranges[-1][0], begin + rollup.width)
        else:
            ranges.append((begin, begin + rollup.width))
    return ranges


def refresh_touched(
    stored: Callable[[SparkSession], DataFrame], rollup: rollups.Rollup, path: str
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that recomputes, from the stored table, every bucket
    the batch touches. Late rows just touch older buckets."""

    def run(batch: DataFrame, batch_id: int) -> None:
        for since, until in touched_ranges(batch, rollup):
            refresh(stored(batch.sparkSession), rollup, path, since, until)

    return run


def deduplicate_prices(prices: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """A price stream with one row per market and time."""
    return _timed(prices, "ts", lateness).dropDuplicatesWithinWatermark([*KEYS, "ts"])
