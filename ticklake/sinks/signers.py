"""Rollups that count signers exactly, kept up to date from changes alone.

A count of distinct signers does not add up, so what is stored is one level finer: for each
bucket, group, tick and signer the number of transactions and their bytes. These add up, and
a transaction that is taken back adds with the opposite sign. Each batch stores the
changes it makes, in folders of the bucket's hour and the batch, so a batch that runs again
replaces its own. A refresh adds up the changes of the buckets it covers; it does not read
the transactions again.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.operators.candles import bucket_start
from ticklake.operators.rollups import TICK_TX_SUMMARY, TRANSACTIONS_HOURLY, Rollup
from ticklake.sinks.tables import PARTITIONS, between, replace_partitions, with_partitions

#: Columns that make up a row of the rollup beside its bucket.
GROUPS = {TRANSACTIONS_HOURLY.name: ["payload_type"], TICK_TX_SUMMARY.name: ["tick_number"]}

_SUMS = ["n", "sized", "bytes"]


def _grain(rollup: Rollup) -> list[str]:
    return list(dict.fromkeys([rollup.bucket, *GROUPS[rollup.name], "tick_number", "public_key"]))


def changes(transactions: DataFrame, rollup: Rollup, sign: int = 1) -> DataFrame:
    """What transactions add to a rollup (or, with ``sign`` -1, take from it): sums per
    bucket, group, tick and signer."""
    rows = transactions.withColumn(rollup.bucket, bucket_start("processed_at", rollup.width))
    return rows.groupBy(*_grain(rollup)).agg(
        F.sum(F.lit(sign).cast("bigint")).alias("n"),
        F.sum(F.when(F.col("payload_size").isNotNull(), F.lit(sign).cast("bigint")).otherwise(0)).alias("sized"),
        F.sum(F.coalesce(F.col("payload_size").cast("bigint") * sign, F.lit(0))).alias("bytes"),
    )


def merged(parts: DataFrame, rollup: Rollup) -> DataFrame:
    """The sums of several batches as one; what was taken back wholly is gone."""
    return parts.groupBy(*_grain(rollup)).agg(*[F.sum(c).alias(c) for c in _SUMS]).filter("n > 0")


def finished(parts: DataFrame, rollup: Rollup) -> DataFrame:
    """The rows of the rollup from merged sums."""
    groups = [rollup.bucket, *GROUPS[rollup.name]]
    sized, total = F.sum("sized"), F.sum("bytes")
    found = [
        F.sum("n").alias("tx_count"),
        F.when(sized > 0, total / sized).alias("avg_payload_size"),
        F.when(sized > 0, total).alias("total_payload_bytes"),
        F.count_distinct("public_key").alias("unique_signers"),
    ]
    if "tick_number" not in groups:
        found += [F.min("tick_number").alias("min_tick_number"), F.max("tick_number").alias("max_tick_number")]
    return parts.groupBy(*groups).agg(*found)


def store_changes(
    rollup: Rollup, path: str, batch_id: int, added: DataFrame | None = None, removed: DataFrame | None = None
) -> None:
    """Store the changes of one batch: transactions added and transactions taken back."""
    parts = [changes(rows, rollup, sign) for rows, sign in ((added, 1), (removed, -1)) if rows is not None]
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    summed = both.groupBy(*_grain(rollup)).agg(*[F.sum(c).alias(c) for c in _SUMS])
    replace_partitions(with_partitions(summed, rollup.bucket, batch_id), path, PARTITIONS)


def read_changes(
    spark: SparkSession, path: str, rollup: Rollup, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """Stored changes of the buckets in ``[since, until)``; other folders are not read."""
    return between(spark.read.parquet(path), rollup.bucket, since, until)


def read_counts(
    spark: SparkSession, path: str, rollup: Rollup, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """The rollup as the stored changes give it."""
    return finished(merged(read_changes(spark, path, rollup, since, until), rollup), rollup)

