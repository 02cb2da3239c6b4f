"""Time-partitioned Parquet tables with idempotent writes.

Layout: ``p_date`` / ``p_hour`` of the row's time, then ``batch_id``. A batch that is
written again replaces its own folders only, so a replayed micro-batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake import schemas
from ticklake.operators.lookup import current, first_per_key
from ticklake.sinks import folders

PARTITIONS = ["p_date", "p_hour", "batch_id"]


def with_partitions(rows: DataFrame, time: str, batch_id: int = 0) -> DataFrame:
    return rows.withColumns(
        {
            "p_date": F.col(time).cast("date"),
            "p_hour": F.hour(time),
            "batch_id": F.lit(batch_id).cast("bigint"),
        }
    )


def replace_partitions(
    rows: DataFrame, path: str, partitions: Sequence[str], one_partition: bool = False
) -> None:
    """Overwrite just the partitions that occur in ``rows``. The rebalance hint merges
    small and splits large partitions by size, so one busy hour is written by many tasks.
    Rows that all belong to ``one_partition`` are written by the tasks that have them."""
    if not one_partition:
        rows = rows.hint("rebalance", *[F.col(c) for c in partitions])
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_rows(
    rows: DataFrame,
    path: str,
    keys: Sequence[str],
    batch_id: int = 0,
    newest: Sequence[str] = ("processed_at",),
    columns: Sequence[str] | None = None,
    one_time: bool = False,
    dealt: bool = False,
) -> None:
    """Upsert by appending: within the batch the newest row of a key is kept, and readers
    take the newest row over all batches (see ``read_current``). ``columns`` are those to
    store, when ``newest`` names others. With ``one_time`` all rows have the same time; they are
    dealt by key as they come and sorted there only; ``dealt`` tells that they already are."""
    if one_time and not dealt:
        rows = rows.repartition(*keys)
    latest = current(rows, keys, newest).select(*(columns or rows.columns))
    dated = with_partitions(latest, "processed_at", batch_id)
    replace_partitions(dated, path, PARTITIONS, one_time)


def read_rows(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    since: datetime | None = None,
    until: datetime | None = None,
    time: str = "processed_at",
) -> DataFrame:
    """Stored rows with ``since <= time < until``. The same range goes to the partition
    columns, so other folders are not listed or read."""
    stored = T.StructType(
        [
            *schema.fields,
            T.StructField("p_date", T.DateType()),
            T.StructField("p_hour", T.IntegerType()),
            T.StructField("batch_id", T.LongType()),
        ]
    )
    rows = _counted(spark.read.schema(stored).parquet(path), path, PARTITIONS)
    return between(rows, time, since, until)


def _counted(rows: DataFrame, path: str, partitions: Sequence[str]) -> DataFrame:
    """Rows without the folders that a compaction under way has doubled."""
    spark = rows.sparkSession
    hidden = [
        F.struct(*[F.lit(value).cast(dict(rows.dtypes)[name]) for name, value in _values(folder, partitions).items()])
        for folder in folders.hidden(spark, path)
    ]
    if not hidden:
        return rows
    return rows.filter(~F.struct(*[F.col(c) for c in partitions]).isin(*hidden))


def _values(folder: str, partitions: Sequence[str]) -> dict[str, str]:
    return dict(part.split("=", 1) for part in folder.split("/")[-len(partitions) :])


def between(
    rows: DataFrame, time: str, since: datetime | None, until: datetime | None
) -> DataFrame:
    kind = dict(rows.dtypes)[time]
    if since is not None:
        rows = rows.filter(F.col(time) >= _at(since, kind)).filter(_place() >= _hour_of(since))
    if until is not None:
        rows = rows.filter(F.col(time) < _at(until, kind)).filter(_place() <= _hour_of(until))
    return rows


def _at(moment: datetime, kind: str) -> Column:
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(kind)


def _place() -> Column:
    """Hours since the epoch of the partition a row lies in."""
    return F.unix_date("p_date") * 24 + F.col("p_hour")


def _hour_of(moment: datetime) -> int:
    return (moment.date() - date(1970, 1, 1)).days * 24 + moment.hour


def read_current(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest stored row of each key; of equal times, that of the later batch."""
    return current(rows, keys, ["processed_at", "batch_id"])


def write_prices(prices: DataFrame, path: str, batch_id: int = 0) -> None:
    """Store prices; the first one of a market and time wins, within the batch and
    against what is stored. Only the dates of the batch are read of what is stored."""
    spark = prices.sparkSession
    first = first_per_key(prices, schemas.PRICE_KEYS, ["arrival"])
    first = first.select(
        "market_id", "ts", F.col("price").cast("decimal(18,8)").alias("price")
    )
    fresh = first
    if folders.exists(spark, path):
        # At most one row per day of the batch comes to the driver.
        days = [r["day"] for r in prices.select(F.to_date("ts").alias("day")).distinct().collect()]
        stored = read_prices(spark, path, dict(prices.dtypes)["ts"]).filter(
            F.col("p_date").isin([d for d in days if d is not None]) & (F.col("batch_id") != batch_id)
        )
        fresh = first.join(stored, schemas.PRICE_KEYS, "left_anti")
    dated = fresh.withColumns(
        {"p_date": F.col("ts").cast("date"), "batch_id": F.lit(batch_id).cast("bigint")}
    )
    replace_partitions(dated, path, ["p_date", "batch_id"])


def read_prices(spark: SparkSession, path: str, time_type: str = "timestamp") -> DataFrame:
    rows = spark.read.schema(
        f"market_id string, ts {time_type}, price decimal(18,8), p_date date, batch_id bigint"
    ).parquet(path)
    return _counted(rows, path, ["p_date", "batch_id"])


def show_rows(rows: DataFrame, limit: int | None = None) -> None:
    """Dry run: print rows as JSON lines and store nothing; all of them, one partition
    after the other, unless a limit is given."""
    shown = rows if limit is None else rows.limit(limit)
    for row in shown.select(F.to_json(F.struct("*"))).toLocalIterator():
        print(row[0])
