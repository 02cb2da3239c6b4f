"""Health, progress and rate measures over log tables."""

from __future__ import annotations

from datetime import datetime, timedelta
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.operators.ordered import running, slice_hot
from ticklake.operators.slices import Bucket, Smoothing, scan

# Texts of the error categories, alert levels, limits of retries.
CATEGORIES = {
    "NETWORK": ["HTTP_REQUEST_FAILED", "HTTP_REQUEST_CREATE_ERROR", "HTTP_INVALID_STATUS"],
    "DATABASE": ["Database insert failed", "database insert errors"],
    "PARSING": ["JSON_DECODE_ERROR"],
}
OTHER_CATEGORY = "UNKNOWN"
ALERTS = {3: "WARNING", 5: "WARNING", 10: "ALERT", 20: "CRITICAL"}
MAX_ATTEMPTS = 3
MAX_AGE = timedelta(minutes=5)
ALPHA = 0.1

# Sums of this type are the same in any order.
EXACT = "decimal(28,9)"


def error_category(error: Column) -> Column:
    """The first category with a marker that occurs in the text."""
    chosen = F.lit(OTHER_CATEGORY)
    for name, markers in reversed(CATEGORIES.items()):
        found = F.lit(False)
        for marker in markers:
            found = found | F.coalesce(error.contains(marker), F.lit(False))
        chosen = F.when(found, name).otherwise(chosen)
    return chosen


def error_runs(
    poll_log: DataFrame,
    order: tuple[str, ...] = ("ts",),
    group_rows: int | None = None,
) -> DataFrame:
    """Polls with ``run`` (errors in a row up to this one, 0 on success) and ``alert``, the
    level reached at exactly 3, 5, 10 and 20 errors."""
    rows, hot = slice_hot(poll_log, ["source_id"], order, group_rows)
    step = running(
        rows, ["source_id"], order, {"_place": ("sum", F.lit(1))}, inclusive=True, sliced=hot
    )
    step = running(
        step, ["source_id"], order,
        {"_good": ("max", F.when(F.col("ok"), F.col("_place")))}, inclusive=True, sliced=hot,
    )
    run = F.col("_place") - F.coalesce("_good", F.lit(0))
    alert = F.lit(None).cast("string")
    for length, level in ALERTS.items():
        alert = F.when(run == length, level).otherwise(alert)
    return step.select(*poll_log.columns, run.alias("run"), alert.alias("alert"))


def poll_health(runs: DataFrame, markets: DataFrame) -> DataFrame:
    """Markets seen, successes, errors, success percentage (0 without polls) and the
    current error run of each source. ``runs`` come from ``error_runs``."""
    polls = runs.groupBy("source_id").agg(
        F.count_if("ok").alias("success"),
        F.count_if(~F.col("ok")).alias("errors"),
        F.max_by("run", "ts").alias("consecutive_errors"),
    )
    seen = markets.groupBy("source_id").agg(F.count_distinct("market_id").alias("markets"))
    total = F.col("success") + F.col("errors")
    rate = F.when(total > 0, F.col("success") / total * 100.0).otherwise(0.0)
    return (
        polls.join(seen, "source_id", "left")
        .fillna(0, ["markets"])
        .withColumn("success_rate", rate)
        .select(
            "source_id", "markets", "success", "errors", "success_rate", "consecutive_errors"
        )
    )


def progress_history(progress: DataFrame, group_rows: int | None = None) -> DataFrame:
    """Saves that go beyond every earlier one of their source."""
    rows = running(
        progress, ["source_id"], ["arrival"],
        {"_before": ("max", F.col("tick_number"))}, group_rows=group_rows,
    )
    advances = F.col("tick_number") > F.coalesce("_before", F.lit(0))
    return rows.filter(advances).drop("_before")


def progress_stats(history: DataFrame) -> DataFrame:
    """Number of saves, the oldest and the newest with their times, per source."""
    return history.groupBy("source_id").agg(
        F.max("tick_number").alias("last_tick_number"),
        F.count(F.lit(1)).alias("total_checkpoints"),
        F.min_by("tick_number", "arrival").alias("oldest_tick"),
        F.min_by("updated_at", "arrival").alias("oldest_checkpoint_time"),
        F.max_by("tick_number", "arrival").alias("newest_tick"),
        F.max_by("updated_at", "arrival").alias("newest_checkpoint_time"),
    )


def flush_means(flush_log: DataFrame, group_rows: int | None = None) -> DataFrame:
    """Flushes with their number so far and the running mean duration, per query.

    Durations are added up as decimals of nine places, so that the order in which parts of
    a hot query are added changes no digit."""
    rows = running(
        flush_log, ["query_id"], ["seq"],
        {
            "flush_count": ("sum", F.lit(1).cast("bigint")),
            "_total": ("sum", F.col("duration_ms").cast(EXACT)),
        },
        inclusive=True,
        group_rows=group_rows,
    )
    mean = F.col("_total").cast("double") / F.col("flush_count")
    return rows.withColumn("average_ms", mean).drop("_total")


def flush_ema(flush_log: DataFrame, alpha: float = ALPHA, slices: int | None = None) -> DataFrame:
    """Flushes with the exponential moving average of their duration, per query."""
    value = F.col("duration_ms").cast("double")
    least, greatest = flush_log.agg(F.min(value), F.max(value)).first()
    return scan(
        flush_log, ["query_id"], ["seq"], Smoothing(alpha, (least or 0.0, greatest or 0.0)), {"value": value},
        [T.StructField("ema_ms", T.DoubleType())], slices,
    )


def retry_decision(
    items: DataFrame,
    now: datetime,
    max_attempts: int = MAX_ATTEMPTS,
    max_age: timedelta = MAX_AGE,
) -> DataFrame:
    """Failed items with ``dropped`` set to the reason, or with one more attempt."""
    moment = F.lit(now.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(dict(items.dtypes)["first_attempt"])
    reason = F.when(F.col("retry_count") >= max_attempts, "attempts").when(
        moment - F.col("first_attempt") > F.lit(max_age), "age"
    )
    kept = reason.isNull()
    return items.withColumns(
        {
            "dropped": reason,
            "last_attempt": F.when(kept, moment).otherwise(F.col("last_attempt")),
            "retry_count": F.when(kept, F.col("retry_count") + 1).otherwise(F.col("retry_count")),
        }
    )


def split_retries(items: DataFrame, now: datetime, **limits) -> tuple[DataFrame, DataFrame]:
    """Items to try again, and dropped items."""
    decided = retry_decision(items, now, **limits)
    again = decided.filter(F.col("dropped").isNull()).drop("dropped")
    return again, decided.filter(F.col("dropped").isNotNull())


def bucket(rate_per_second: float, burst: int) -> Bucket:
    """A token bucket: full at first, refilled by elapsed time up to ``burst``; a visit that
    finds a whole token takes it and is admitted. The rate is taken as a fraction whose
    denominator has at most twelve digits, so 1 / 3600 is meant exactly."""
    rate = Fraction(rate_per_second).limit_denominator(10**12)
    return Bucket(rate.numerator, rate.denominator * 1_000_000, burst)


BUCKET_OUTPUTS = [T.StructField("admitted", T.BooleanType())]


def admit(
    events: DataFrame,
    rate_per_second: float,
    burst: int,
    order: tuple[str, ...] = ("ts", "event_id"),
    slices: int | None = None,
) -> DataFrame:
    """Events of each ``key``, marked admitted or limited by a token bucket."""
    return scan(
        events, ["key"], list(order), bucket(rate_per_second, burst),
        {"time": F.unix_micros(F.col(order[0]).cast("timestamp"))}, BUCKET_OUTPUTS, slices,
    )
