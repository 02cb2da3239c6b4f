"""Rollups over streams that count signers exactly and give each bucket once, when it closes.

Every group of a bucket keeps its sums in a value state and its signers in a map state, so
a signer is looked up alone and a busy group need not fit into memory. An event-time timer
at the end of the bucket gives the finished row and clears both. Rows behind the
watermark are dropped by Spark; the tables keep them, and a refresh repairs the rollup.

A hot bucket can be spread: the stream is keyed by ``lanes`` hashed parts of the signers,
whose distinct counts add up, and ``whole_buckets`` adds them up.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ticklake.operators.candles import bucket_start
from ticklake.operators.rollups import Rollup
from ticklake.sinks.signers import GROUPS

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_SUMS = "n long, sized long, bytes long, low long, high long"
_OUTPUT = f"lane int, {_SUMS}, signers long"


class ClosingBuckets(StatefulProcessor):
    """One group of one bucket: sums, and the set of its signers."""

    def __init__(self, width_ms: int, names: list[str]):
        self._width_ms, self._names = width_ms, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._sums = handle.getValueState("sums", f"{_SUMS}, signers long")
        self._signers = handle.getMapState("signers", "signer string", "seen boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        begun = self._sums.exists()
        n, sized, total, low, high, signers = self._sums.get() if begun else (0, 0, 0, None, None, 0)
        for frame in rows:
            sizes = frame["payload_size"].dropna()
            ticks = frame["tick_number"].dropna()
            n, sized, total = n + len(frame), sized + len(sizes), total + int(sizes.sum())
            if len(ticks):
                low = int(ticks.min()) if low is None else min(low, int(ticks.min()))
                high = int(ticks.max()) if high is None else max(high, int(ticks.max()))
            for signer in frame["signer"].dropna().unique():
                if not self._signers.containsKey((signer,)):
                    self._signers.updateValue((signer,), (True,))
                    signers += 1
        self._sums.update((n, sized, total, low, high, signers))
        if not begun:
            self._handle.registerTimer(int(key[0]) // 1000 + self._width_ms)
        yield self._rows([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        row = (*key, *self._sums.get())
        self._sums.clear()
        self._signers.clear()
        yield self._rows([row])

    def _rows(self, rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=self._names)
        return frame.astype({c: "Int64" for c in self._names[-6:]})

    def close(self) -> None:
        pass


def closed_buckets(transactions: DataFrame, rollup: Rollup, lateness: str = "10 minutes", lanes: int = 1) -> DataFrame:
    """The rollup's buckets that cannot change any more, for output mode ``append``: one row
    per bucket, group and lane of signers (see ``whole_buckets``)."""
    spark = transactions.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    group = GROUPS[rollup.name]
    rows = (
        transactions.withColumn("processed_at", F.col("processed_at").cast("timestamp"))
        .withWatermark("processed_at", lateness)
        .select(
            F.unix_micros(bucket_start("processed_at", rollup.width)).alias("begins_us"),
            *[F.col(c).alias(f"group_{c}") for c in group],
            F.pmod(F.xxhash64("public_key"), F.lit(lanes)).cast("int").alias("lane"),
            F.hex("public_key").alias("signer"), "payload_size", "tick_number", "processed_at",
        )
    )
    keys = ["begins_us", *[f"group_{c}" for c in group], "lane"]
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys[:-1]) + f", {_OUTPUT}"
    names = [*keys, "n", "sized", "bytes", "low", "high", "signers"]
    width = int(rollup.width.total_seconds() * 1000)
    return rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=ClosingBuckets(width, names), outputStructType=schema, outputMode="Append", timeMode="EventTime"
    )


def whole_buckets(closed: DataFrame, rollup: Rollup) -> DataFrame:
    """Rollup rows from the stored output of ``closed_buckets``."""
    group = GROUPS[rollup.name]
    sized, total = F.sum("sized"), F.sum("bytes")
    found = [
        F.sum("n").alias("tx_count"), F.when(sized > 0, total / sized).alias("avg_payload_size"),
        F.when(sized > 0, total).alias("total_payload_bytes"), F.sum("signers").alias("unique_signers"),
    ]
    if "tick_number" not in group:
        found += [F.min("low").alias("min_tick_number"), F.max("high").alias("max_tick_number")]
    named = [F.col(f"group_{c}").alias(c) for c in group]
    begin = F.timestamp_micros("begins_us").alias(rollup.bucket)
    return closed.groupBy(begin, *named).agg(*found)
