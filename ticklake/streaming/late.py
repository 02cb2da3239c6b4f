"""Accounts of rows that come behind the watermark of a stream.

Two tables, with one folder per batch that is replaced as a whole when the batch runs again:
``account`` counts the late rows themselves, in a stream that stores all its rows;
``DroppedRows`` keeps what Spark reports of a stream whose operators drop them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from ticklake.sinks import folders

ACCOUNTS = "batch_id bigint, n_rows bigint, n_late bigint, watermark timestamp, newest timestamp"
DROPPED = (
    "query string, batch_id bigint, operator string, n_dropped bigint, n_rows bigint, watermark string"
)


def account(
    write: Callable[[DataFrame, int], None],
    path: str,
    time: str = "processed_at",
    lateness: str = "10 minutes",
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that calls ``write`` and then stores the batch's account.

    The watermark of a batch is ``lateness`` behind the newest time of the batches before it,
    as for Spark's own operators; rows before it are late. They are counted by an
    aggregation of the time column, which is exact also when tasks run twice. Rows without a
    time are never late. The first batch, and one that follows none stored here, has no watermark.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        spark = batch.sparkSession
        at = F.col(time).cast("timestamp")
        before = F.lit(_newest(spark, f"{path}/batch_id={batch_id - 1}")).cast("bigint")
        newest = F.timestamp_micros(before)
        watermark = newest - F.expr(f"INTERVAL {lateness}")
        batch.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(at < watermark).alias("n_late"),
            F.max(at).alias("newest"),
        ).select(
            "n_rows", "n_late", watermark.alias("watermark"),
            F.greatest(newest, "newest").alias("newest"),
        ).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return run


def _newest(spark: SparkSession, path: str) -> int | None:
    """The newest time up to a batch, in microseconds."""
    if not folders.exists(spark, f"{path}/_SUCCESS"):
        return None
    row = spark.read.schema("newest timestamp").parquet(path).select(F.unix_micros("newest")).first()
    return row[0] if row else None


def accounts(spark: SparkSession, path: str) -> DataFrame:
    """Rows and late rows of each batch."""
    return spark.read.schema(ACCOUNTS).parquet(path)


class DroppedRows(StreamingQueryListener):
    """Stores per batch and stateful operator how many rows the watermark made it drop.

    Add it with ``spark.streams.addListener``. Only queries named in ``names`` are kept, all
    by default; a query without a name goes by its id. Behind an aggregation Spark counts groups
    that were already combined within a task; ``account`` counts rows.
    """

    def __init__(self, spark: SparkSession, path: str, names: set[str] | None = None):
        self.spark, self.path, self.names = spark, path, names

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress
        query = seen.name or str(seen.id)
        if not seen.stateOperators or self.names is not None and query not in self.names:
            return
        rows = [
            (o.operatorName, o.numRowsDroppedByWatermark, seen.numInputRows, seen.eventTime.get("watermark"))
            for o in seen.stateOperators
        ]
        # A batch without input reports the same number again when it only moves the watermark.
        kind = "operator string, n_dropped bigint, n_rows bigint, watermark string"
        self.spark.createDataFrame(rows, kind).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/query={query}/batch_id={seen.batchId}"
        )


def dropped(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DROPPED).parquet(path)
