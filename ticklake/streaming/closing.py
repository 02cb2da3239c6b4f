"""Candles of a price stream that are given once, when they close, without gaps.

Each market keeps its open candles by bucket in a map state, and where its output has come to
in a value state. An event-time timer at the end of the next bucket gives everything that
the watermark has passed: candles, and for buckets without prices nulls or the last close. So
a market that falls silent goes on as time does. Memory per market is its open buckets,
whatever number of prices they hold. Prices behind the watermark are dropped by Spark; the
price table keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ticklake.operators import candles

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_NAMES = ["market_id", "t_us", "o", "h", "l", "c"]


class ClosingCandles(StatefulProcessor):
    """The candles of one market."""

    def __init__(self, width_us: int, carry: bool):
        self._width, self._carry = width_us, carry

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        kinds = "first_us long, o double, h double, l double, last_us long, c double"
        self._open = handle.getMapState("open", "t_us long", kinds)
        # the next bucket to give, the last close, and the newest timer
        self._place = handle.getValueState("place", "t_us long, c double, timer_ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        earliest = None
        for frame in rows:
            frame = frame.sort_values("us", kind="stable")
            for bucket, some in frame.groupby(frame["us"] // self._width * self._width):
                prices, times, at = some["price"], some["us"], (int(bucket),)
                found = (
                    int(times.iloc[0]), float(prices.iloc[0]), float(prices.max()), float(prices.min()),
                    int(times.iloc[-1]), float(prices.iloc[-1]),
                )
                if self._open.containsKey(at):
                    found = self._joined(self._open.getValue(at), found)
                self._open.updateValue(at, found)
                earliest = at[0] if earliest is None else min(earliest, at[0])
        next_us, close, timer = self._place.get() if self._place.exists() else (None, None, None)
        if next_us is None and earliest is not None:
            wanted = (earliest + self._width) // 1000
            if timer is None or wanted < timer:
                self._handle.registerTimer(wanted)
                self._place.update((None, None, wanted))
        yield self._rows([])

    @staticmethod
    def _joined(a: tuple, b: tuple) -> tuple:
        first, last = (a if a[0] <= b[0] else b), (a if a[4] > b[4] else b)
        return first[0], first[1], max(a[2], b[2]), min(a[3], b[3]), last[4], last[5]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark_us = timerValues.getCurrentWatermarkInMs() * 1000
        at, close, timer = self._place.get()
        ready = {b[0]: candle for b, candle in self._open.iterator() if b[0] + self._width <= watermark_us}
        if at is None and ready:
            at = min(ready)
        rows = []
        while at is not None and at + self._width <= watermark_us:
            if at in ready:
                _, o, h, l, _, close = ready[at]
                rows.append((key[0], at, o, h, l, close))
                self._open.removeKey((at,))
            else:
                rows.append((key[0], at, *[close if self._carry else None] * 4))
            at += self._width
        if at is not None and expiredTimerInfo.getExpiryTimeInMs() >= timer:
            timer = (at + self._width) // 1000
            self._handle.registerTimer(timer)
        self._place.update((at, close, timer))
        yield self._rows(rows)

    def _rows(self, rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=_NAMES)
        return frame.astype({"market_id": "object", "t_us": "int64", **{c: "float64" for c in "ohlc"}})

    def close(self) -> None:
        pass


def closed_candles(
    prices: DataFrame, tf: str = candles.DEFAULT_TIMEFRAME, lateness: str = "10 minutes", fill: str = "locf"
) -> DataFrame:
    """Candles for output mode ``append``: every bucket of a market from its first one on,
    in order. ``fill`` is ``"locf"`` (empty buckets repeat the last close) or ``"null"``."""
    if fill not in ("null", "locf"):
        raise ValueError(f"unknown fill {fill!r}")
    spark = prices.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    rows = (
        prices.filter("price IS NOT NULL").withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", lateness)
        .select("market_id", F.unix_micros("ts").alias("us"), F.col("price").cast("double").alias("price"), "ts")
    )
    width = int(candles.timeframe(tf).total_seconds() * 1_000_000)
    closed = rows.groupBy("market_id").transformWithStateInPandas(
        statefulProcessor=ClosingCandles(width, fill == "locf"),
        outputStructType="market_id string, t_us long, o double, h double, l double, c double",
        outputMode="Append", timeMode="EventTime",
    )
    empty = [F.when(~F.isnan(x), F.col(x)).alias(x) for x in "ohlc"]
    return closed.select("market_id", F.timestamp_micros("t_us").alias("t"), *empty)
