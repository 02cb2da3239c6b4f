"""OHLC candles over price series, with gap filling and carry-forward."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The allowed timeframes.
TIMEFRAMES = {
    "1m": timedelta(minutes=1),
    "5m": timedelta(minutes=5),
    "15m": timedelta(minutes=15),
    "1h": timedelta(hours=1),
    "4h": timedelta(hours=4),
    "1d": timedelta(days=1),
}
DEFAULT_TIMEFRAME = "1h"
MAX_SPAN = timedelta(days=30)
_EPOCH = datetime(1970, 1, 1)


def timeframe(name: str = DEFAULT_TIMEFRAME) -> timedelta:
    if name not in TIMEFRAMES:
        raise ValueError(f"unsupported timeframe {name!r}; allowed: {', '.join(TIMEFRAMES)}")
    return TIMEFRAMES[name]


def candle_range(
    now: datetime,
    start: datetime | None = None,
    end: datetime | None = None,
    max_span: timedelta | None = MAX_SPAN,
) -> tuple[datetime, datetime]:
    """The range to read: the last 24 hours unless given, checked for order and span."""
    start = now - timedelta(hours=24) if start is None else start
    end = now if end is None else end
    if start > end:
        raise ValueError("the start of the range must not be after its end")
    if max_span is not None and end - start > max_span:
        raise ValueError(f"the range cannot exceed {max_span.days} days")
    return start, end


def bucket_floor(at: datetime, width: timedelta) -> datetime:
    return at - (at - _EPOCH) % width


def bucket_start(ts: Column | str, width: timedelta) -> Column:
    """Start of the epoch-aligned bucket a timestamp falls into."""
    return F.window(ts, f"{int(width.total_seconds())} seconds")["start"]


def bucket_key(rows: DataFrame, time: str, width: timedelta, name: str) -> Column:
    """What to group by for buckets of a time column. A stream must be grouped by the
    whole window, which carries the watermark; for tables its start is enough."""
    window = F.window(time, f"{int(width.total_seconds())} seconds")
    return (window if rows.isStreaming else window["start"]).alias(name)


def named_bucket(grouped: DataFrame, name: str) -> DataFrame:
    """A grouped frame with the start of the bucket under the name of its key."""
    return grouped.withColumn(name, F.col(name)["start"]) if grouped.isStreaming else grouped


def _ntz(at: datetime) -> Column:
    return F.lit(at.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def ohlc(prices: DataFrame, tf: str = DEFAULT_TIMEFRAME) -> DataFrame:
    """First, highest, lowest and last price of each market and bucket.

    Prices stay decimal until the end. All four aggregates combine on the map side, so a
    market with most of the rows costs no more than any other.
    """
    found = prices.groupBy("market_id", bucket_key(prices, "ts", timeframe(tf), "t")).agg(
        F.min_by("price", "ts").alias("o"),
        F.max("price").alias("h"),
        F.min("price").alias("l"),
        F.max_by("price", "ts").alias("c"),
    )
    return named_bucket(found, "t").select(
        "market_id", "t", *[F.col(x).cast("double").alias(x) for x in "ohlc"]
    )


def in_range(prices: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Rows with ``start <= ts < end``; also on the date partition where there is one."""
    kept = prices.filter((F.col("ts") >= _ntz(start)) & (F.col("ts") < _ntz(end)))
    if "p_date" in prices.columns:
        kept = kept.filter(F.col("p_date").between(F.lit(start.date()), F.lit(end.date())))
    return kept


def candles(
    prices: DataFrame,
    tf: str,
    start: datetime,
    end: datetime,
    fill: str | None = "null",
    lead_bucket: bool = True,
    markets: list[str] | None = None,
) -> DataFrame:
    """Candles of ``[start, end)`` for all markets at once.

    ``fill`` is ``None`` (only buckets with data), ``"null"`` (every bucket, empty ones
    null) or ``"locf"`` (empty buckets repeat the last close; those before the first
    price stay null). Filled results also read one interval before ``start``; the bucket
    this reaches is part of the output, if it has rows, unless ``lead_bucket`` is off.
    """
    width = timeframe(tf)
    if fill not in (None, "null", "locf"):
        raise ValueError(f"unknown fill {fill!r}")
    if markets is not None:
        prices = prices.filter(F.col("market_id").isin(markets))
    if fill is None:
        return ohlc(in_range(prices, start, end), tf)
    found = ohlc(in_range(prices, start - width, end), tf)
    return _fill_gaps(found, width, start, end, fill, lead_bucket)


def _fill_gaps(
    found: DataFrame,
    width: timedelta,
    start: datetime,
    end: datetime,
    fill: str,
    lead_bucket: bool,
) -> DataFrame:
    """Each candle brings the empty buckets up to the next one; the first of a market also
    those before it. So the candles are shuffled once, and are not joined with a grid.
    """
    first = bucket_floor(start, width)
    after = bucket_floor(end - timedelta(microseconds=1), width) + width
    step = F.lit(width)
    in_market = Window.partitionBy("market_id").orderBy("t")
    following = F.coalesce(F.lead("t").over(in_market), _ntz(after))
    preceding = F.lag("t").over(in_market)
    placed = found.withColumns({"following": following, "preceding": preceding})
    begin = F.when(
        F.col("preceding").isNull() & (F.col("t") > _ntz(first)), _ntz(first)
    ).otherwise(F.col("t"))
    spread = placed.select(
        "market_id",
        F.col("t").alias("own"),
        *"ohlc",
        F.explode(F.sequence(begin, F.col("following") - step, step)).alias("t"),
    )
    is_own = F.col("t") == F.col("own")
    if fill == "locf":
        later = F.col("t") > F.col("own")
        shown = {x: F.when(is_own, F.col(x)).when(later, F.col("c")) for x in "ohl"}
        shown["c"] = F.when(is_own | later, F.col("c"))
    else:
        shown = {x: F.when(is_own, F.col(x)) for x in "ohlc"}
    filled = spread.select("market_id", "t", *[shown[x].alias(x) for x in "ohlc"])
    return filled if lead_bucket else filled.filter(F.col("t") >= _ntz(first))
