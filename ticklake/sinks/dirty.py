"""Which buckets of a rollup must be computed again: a log of marks and of runs.

Whatever changes stored rows (ingest, late rows, invalidations) marks their buckets, in a
folder of its own number, so marking again changes nothing. A scheduled run computes the
marked buckets within the range that is due and then logs them, each with the newest mark
that it saw. A bucket is dirty while it has a mark that no run has seen, so a mark made
during a run is not lost, and a run that stops before its log entry is just run again.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.operators.candles import bucket_start
from ticklake.operators.rollups import Rollup
from ticklake.sinks import folders
from ticklake.sinks.upkeep import refresh_buckets

_MARKS = "bucket timestamp_ntz, mark bigint"
_RUNS = "bucket timestamp_ntz, seen bigint, run bigint"


def mark(rows: DataFrame, rollup: Rollup, log: str, number: int) -> None:
    """Mark the buckets of rows as dirty. ``number`` grows from one change to the next."""
    start = bucket_start("processed_at", rollup.width).cast("timestamp_ntz")
    marks = rows.select(start.alias("bucket")).filter("bucket IS NOT NULL").distinct()
    marks.coalesce(1).write.mode("overwrite").parquet(f"{log}/{rollup.name}/marks/mark={number}")


def dirty(spark: SparkSession, rollup: Rollup, log: str) -> DataFrame:
    """Dirty buckets, each with its newest ``mark``."""
    marks = _read(spark, f"{log}/{rollup.name}/marks", _MARKS).groupBy("bucket").agg(F.max("mark").alias("mark"))
    seen = _read(spark, f"{log}/{rollup.name}/runs", _RUNS).groupBy("bucket").agg(F.max("seen").alias("seen"))
    left = marks.join(seen, "bucket", "left")
    return left.filter(F.col("seen").isNull() | (F.col("mark") > F.col("seen"))).select("bucket", "mark")


def run_due(source: DataFrame, rollup: Rollup, path: str, log: str, now: datetime) -> list[datetime]:
    """The scheduled refresh: dirty buckets that are due at ``now``. Returns them."""
    return run_between(source, rollup, path, log, *rollup.due(now))


def run_between(
    source: DataFrame, rollup: Rollup, path: str, log: str, since: datetime, until: datetime
) -> list[datetime]:
    """Refresh the dirty buckets in ``[since, until)`` alone; others stay dirty. The buckets
    of the range, and no rows, come to the driver."""
    spark = source.sparkSession
    inside = F.col("bucket").between(F.lit(str(since)).cast("timestamp_ntz"), F.lit(str(until)).cast("timestamp_ntz"))
    found = dirty(spark, rollup, log).filter(inside & (F.col("bucket") < F.lit(str(until)).cast("timestamp_ntz")))
    todo = sorted((r["bucket"], r["mark"]) for r in found.collect())
    if todo:
        refresh_buckets(source, rollup, path, [bucket for bucket, _ in todo])
        _log(spark, f"{log}/{rollup.name}/runs", todo)
    return [bucket for bucket, _ in todo]


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if not folders.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _log(spark: SparkSession, path: str, seen: Iterable[tuple[datetime, int]]) -> None:
    earlier = [int(v["run"]) for v, _ in folders.partitions(spark, path, ["run"])]
    run = max(earlier, default=0) + 1
    rows = spark.createDataFrame(list(seen), "bucket timestamp_ntz, seen bigint")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/run={run}")
