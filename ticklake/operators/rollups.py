"""Hourly and five-minute aggregates of the stored tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.operators.candles import bucket_floor, bucket_key, named_bucket
from ticklake.operators.lookup import live

HOUR = timedelta(hours=1)
FIVE_MINUTES = timedelta(minutes=5)


def _source(rows: DataFrame, live_only: bool) -> DataFrame:
    return live(rows) if live_only else rows


def ticks_hourly(ticks: DataFrame, live_only: bool = False) -> DataFrame:
    """Ticks per hour. Like the other rollups it counts invalidated rows too, unless
    ``live_only`` is set."""
    rows = _source(ticks, live_only)
    found = (
        rows.groupBy(bucket_key(rows, "processed_at", HOUR, "hour"))
        .agg(
            F.count(F.lit(1)).alias("tick_count"),
            F.avg("tx_count").alias("avg_tx_per_tick"),
            F.min("tick_number").alias("min_tick_number"),
            F.max("tick_number").alias("max_tick_number"),
            F.count_if(F.col("vdf_iterations") > 0).alias("ticks_with_vdf"),
        )
    )
    return named_bucket(found, "hour")


def _signers(approximate: bool):
    count = F.approx_count_distinct if approximate else F.count_distinct
    return count("public_key").alias("unique_signers")


def transactions_hourly(
    transactions: DataFrame, live_only: bool = False, approximate: bool = False
) -> DataFrame:
    """Transactions per hour and payload type. The exact count of signers groups by
    signer first, so one busy hour is spread over many tasks."""
    rows = _source(transactions, live_only)
    found = (
        rows.groupBy(bucket_key(rows, "processed_at", HOUR, "hour"), "payload_type")
        .agg(
            F.count(F.lit(1)).alias("tx_count"),
            F.avg("payload_size").alias("avg_payload_size"),
            F.sum("payload_size").alias("total_payload_bytes"),
            _signers(approximate),
            F.min("tick_number").alias("min_tick_number"),
            F.max("tick_number").alias("max_tick_number"),
        )
    )
    return named_bucket(found, "hour")


def tick_tx_summary(
    transactions: DataFrame, live_only: bool = False, approximate: bool = False
) -> DataFrame:
    """Transactions per tick in five-minute buckets."""
    rows = _source(transactions, live_only)
    found = (
        rows.groupBy(bucket_key(rows, "processed_at", FIVE_MINUTES, "bucket"), "tick_number")
        .agg(
            F.count(F.lit(1)).alias("tx_count"),
            _signers(approximate),
            F.avg("payload_size").alias("avg_payload_size"),
            F.sum("payload_size").alias("total_payload_bytes"),
        )
    )
    return named_bucket(found, "bucket")


@dataclass(frozen=True)
class Rollup:
    """How a rollup is computed and which buckets a scheduled refresh covers."""

    name: str
    compute: Callable[[DataFrame], DataFrame]
    bucket: str
    width: timedelta
    start_offset: timedelta
    end_offset: timedelta
    schedule: timedelta

    def due(self, now: datetime) -> tuple[datetime, datetime]:
        """Whole buckets within [now - start_offset, now - end_offset)."""
        since = now - self.start_offset
        first = bucket_floor(since, self.width)
        if first < since:
            first += self.width
        return first, bucket_floor(now - self.end_offset, self.width)


# The refresh offsets and schedules.
TICKS_HOURLY = Rollup(
    "ticks_hourly", ticks_hourly, "hour", HOUR, timedelta(hours=2), HOUR, HOUR
)
TRANSACTIONS_HOURLY = Rollup(
    "transactions_hourly", transactions_hourly, "hour", HOUR, timedelta(hours=2), HOUR, HOUR
)
TICK_TX_SUMMARY = Rollup(
    "tick_tx_summary", tick_tx_summary, "bucket", FIVE_MINUTES,
    timedelta(minutes=30), timedelta(minutes=10), timedelta(minutes=15),
)
ROLLUPS = [TICKS_HOURLY, TRANSACTIONS_HOURLY, TICK_TX_SUMMARY]
