"""Rollup refresh, retention and compaction of stored tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions.session import cut_lineage
from ticklake.operators.lookup import current
from ticklake.operators.rollups import Rollup
from ticklake.sinks import folders
from ticklake.sinks.tables import PARTITIONS, between, replace_partitions

# The ages after which tables are compacted, and the optional retention.
COMPACT_AFTER = {
    "ticks": timedelta(hours=6),
    "transactions": timedelta(hours=2),
    "market_prices": timedelta(days=7),
}
RETENTION_DAYS = 90
COMPACTED = -1

_ROLLUP_PARTITIONS = ["p_date", "p_hour", "p_minute"]


def refresh(
    source: DataFrame, rollup: Rollup, path: str, since: datetime, until: datetime
) -> None:
    """Recompute the buckets in ``[since, until)``, which must lie on bucket boundaries.

    One folder per bucket, replaced as a whole: running it again gives the same table.
    This is also how late and invalidated rows reach a rollup. A bucket left without
    rows loses its folder.
    """
    for at in (since, until):
        _on_boundary(at, rollup)
    if "p_date" in source.columns:
        rows = between(source, "processed_at", since, until)
    else:
        rows = source.filter(_within(source, since, until))
    days = [since.date() + timedelta(days=n) for n in range((until - since).days + 2)]
    _replace_buckets(rows, rollup, path, days, lambda at: since <= at < until)


def refresh_buckets(source: DataFrame, rollup: Rollup, path: str, buckets: Sequence[datetime]) -> None:
    """``refresh`` of some buckets only; rows of others are not read."""
    wanted, inside = set(buckets), F.lit(False)
    for at in sorted(wanted):
        _on_boundary(at, rollup)
        inside = inside | _within(source, at, at + rollup.width)
    if "p_date" in source.columns:
        inside = inside & (F.unix_date("p_date") * 24 + F.col("p_hour")).isin(
            sorted({(at - datetime(1970, 1, 1)) // timedelta(hours=1) for at in wanted})
        )
    days = sorted({at.date() for at in wanted})
    _replace_buckets(source.filter(inside), rollup, path, days, wanted.__contains__)


def _on_boundary(at: datetime, rollup: Rollup) -> None:
    if (at - datetime(1970, 1, 1)) % rollup.width:
        raise ValueError(f"{at} is not on a boundary of {rollup.width}")


def _within(source: DataFrame, since: datetime, until: datetime) -> Column:
    kind = _kind(source)
    time = F.col("processed_at")
    return (time >= F.lit(str(since)).cast(kind)) & (time < F.lit(str(until)).cast(kind))


def _replace_buckets(
    rows: DataFrame, rollup: Rollup, path: str, days: Sequence[date], covered: Callable[[datetime], bool]
) -> None:
    """Write the buckets of rows, computed once, and drop covered ones that have no rows."""
    spark = rows.sparkSession
    fresh = cut_lineage(rollup.compute(rows).withColumns(
        {
            "p_date": F.col(rollup.bucket).cast("date"),
            "p_hour": F.hour(rollup.bucket),
            "p_minute": F.minute(rollup.bucket),
        }
    ))
    # At most one row per bucket of the range comes to the driver.
    filled = {tuple(r) for r in fresh.select(*_ROLLUP_PARTITIONS).distinct().collect()}
    replace_partitions(fresh, path, _ROLLUP_PARTITIONS)
    for day in days:
        for values, folder in folders.partitions(spark, path, _ROLLUP_PARTITIONS, first=day.isoformat()):
            at = datetime.combine(day, datetime.min.time()) + timedelta(
                hours=int(values["p_hour"]), minutes=int(values["p_minute"])
            )
            if covered(at) and (at.date(), at.hour, at.minute) not in filled:
                folders.delete(spark, folder)


def _kind(source: DataFrame) -> str:
    return dict(source.dtypes)["processed_at"]


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(*_ROLLUP_PARTITIONS)


def drop_older_than(
    spark: SparkSession,
    path: str,
    now: datetime,
    days: int = RETENTION_DAYS,
    dry_run: bool = True,
) -> list[str]:
    """Date folders that lie wholly before ``now - days``; deleted unless ``dry_run``."""
    limit = (now - timedelta(days=days)).date()
    old = [
        folder
        for values, folder in folders.partitions(spark, path, ["p_date"])
        if date.fromisoformat(values["p_date"]) < limit
    ]
    if not dry_run:
        for folder in old:
            folders.delete(spark, folder)
    return old


def compact(
    spark: SparkSession,
    path: str,
    schema: str,
    now: datetime,
    age: timedelta,
    sort: Sequence[str],
    hourly: bool = True,
    keys: Sequence[str] = (),
    newest: Sequence[str] = ("processed_at", "batch_id"),
) -> int:
    """Rewrite partitions older than ``age`` as few sorted zstd files; returns how many.

    With ``keys`` only the newest row of a key stays in its partition. The new folder has a
    negative batch number, below all it replaces, so later batches still come after it.

    A run may stop anywhere: readers of ``tables`` leave out the new folders until all of
    them are there, and the old ones from then on, as two small files below the table say
    (``folders.hidden``). The next run first undoes or completes what the last one left.
    """
    columns = PARTITIONS if hourly else ["p_date", "batch_id"]
    _settle(spark, path)
    old: dict[tuple, list[tuple[int, str]]] = {}
    for values, folder in folders.partitions(spark, path, columns):
        begin = datetime.combine(date.fromisoformat(values["p_date"]), datetime.min.time())
        begin += timedelta(hours=int(values.get("p_hour", 0)))
        end = begin + (timedelta(hours=1) if hourly else timedelta(days=1))
        if end <= now - age:
            place = tuple(values[c] for c in columns[:-1])
            old.setdefault(place, []).append((int(values["batch_id"]), folder))
    due = {p: parts for p, parts in old.items() if len(parts) > 1 or parts[0][0] >= 0}
    if not due:
        return 0
    number = min(COMPACTED, *(b - 1 for parts in due.values() for b, _ in parts))
    replaced = [folder for parts in due.values() for _, folder in parts]
    made = [f"{parts[0][1].rsplit('/', 1)[0]}/batch_id={number}" for parts in due.values()]
    folders.write_lines(spark, f"{path}/{folders.MADE}", made)
    types = "p_date date, p_hour int, batch_id bigint" if hourly else "p_date date, batch_id bigint"
    rows = spark.read.option("basePath", path).schema(f"{schema}, {types}").parquet(*replaced)
    if keys:
        rows = current(rows, [*columns[:-1], *keys], newest)
    (
        rows.withColumn("batch_id", F.lit(number).cast("bigint"))
        .hint("rebalance", *[F.col(c) for c in columns])
        .sortWithinPartitions(*columns, *sort)
        .write.mode("append")
        .option("compression", "zstd")
        .partitionBy(*columns)
        .parquet(path)
    )
    folders.write_lines(spark, f"{path}/{folders.REPLACED}", replaced)
    _settle(spark, path)
    return len(due)


def _settle(spark: SparkSession, path: str) -> None:
    """Complete a compaction whose new folders are all written; undo one that stopped before."""
    made, replaced = f"{path}/{folders.MADE}", f"{path}/{folders.REPLACED}"
    gone = folders.read_lines(spark, replaced)
    for folder in (folders.read_lines(spark, made) or []) if gone is None else gone:
        folders.delete(spark, folder)
    folders.delete(spark, made)
    folders.delete(spark, replaced)
