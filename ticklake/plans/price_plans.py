"""Observed prices: extraction from snapshots, thinning and storing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticklake.operators import prices as p
from ticklake.plans import adapters as a
from ticklake.sources import snapshots

_OBSERVED = f"WITH {a.OBSERVED_PRICES}"
_PREVIOUS = "lag(price) OVER (PARTITION BY market_id ORDER BY poll_time, arrival)"


def _perp(spark, sf_dir):
    polls = a.polls(spark, sf_dir)
    return snapshots.perp_prices(snapshots.explode_markets(polls))


def _first_per_time(spark, sf_dir):
    """Prices at whole hours, so that many share one market and time."""
    rows = a.observed_prices(spark, sf_dir).select(
        "market_id", F.date_trunc("hour", "poll_time").cast("timestamp_ntz").alias("ts"),
        "price", "arrival",
    )
    return p.first_per_time(rows)


# Greedy thinning in SQL: one observation per market and round.
_THIN = """numbered AS (
  SELECT *, epoch_us(poll_time) AS us, row_number() OVER (
    PARTITION BY market_id ORDER BY poll_time, arrival) AS rn FROM observed),
walk AS (
  SELECT market_id, poll_time, arrival, price, rn, true AS keep, us AS kept_at FROM numbered
  WHERE rn = 1
  UNION ALL
  SELECT market_id, poll_time, arrival, price, rn, keep,
    CASE WHEN keep THEN us ELSE kept_at END
  FROM (SELECT n.*, w.kept_at, ({moved}) OR n.us - w.kept_at >= {heartbeat} AS keep
    FROM walk w JOIN numbered n ON n.market_id = w.market_id AND n.rn = w.rn + 1))
SELECT market_id, poll_time, price, arrival FROM walk WHERE keep"""

QUERIES = {
    "perp_prices": _perp,
    "prices_first_per_time": _first_per_time,
    "prices_changed_only": lambda s, d: p.changed_only(a.observed_prices(s, d)),
    "prices_moved_only": lambda s, d: p.moved_only(
        a.observed_prices(s, d), min_tick=1.0, epsilon=0.5
    ),
    "prices_thinned": lambda s, d: p.thin(a.observed_prices(s, d), heartbeat_seconds=7200),
    "prices_thinned_by_threshold": lambda s, d: p.thin(
        a.observed_prices(s, d), heartbeat_seconds=7200, min_tick=1.0, epsilon=0.5
    ),
}

SQL = {
    "perp_prices": f"""WITH {a.POLLS}
SELECT 'm' || n AS market_id, poll_time,
  coalesce(make_timestamp(engine * 1000000), poll_time) AS ts, value AS price, arrival
FROM polls WHERE arrival % 50 <> 7""",
    "prices_first_per_time": f"""{_OBSERVED}
SELECT market_id, date_trunc('hour', poll_time) AS ts, arg_min(price, arrival) AS price,
  min(arrival) AS arrival FROM observed GROUP BY 1, 2""",
    "prices_changed_only": f"""{_OBSERVED}, lagged AS (SELECT *, {_PREVIOUS} AS last FROM observed)
SELECT market_id, poll_time, price, arrival FROM lagged
WHERE last IS NULL OR last = 0 OR price <> last""",
    "prices_moved_only": f"""{_OBSERVED}, lagged AS (SELECT *, {_PREVIOUS} AS last FROM observed)
SELECT market_id, poll_time, price, arrival FROM lagged
WHERE last IS NULL OR abs(price - last) >= greatest(1.0, 0.5 * last)""",
    "prices_thinned": f"""WITH RECURSIVE {a.OBSERVED_PRICES}, """
    + _THIN.format(moved="w.price = 0 OR n.price <> w.price", heartbeat=7200000000),
    "prices_thinned_by_threshold": f"""WITH RECURSIVE {a.OBSERVED_PRICES}, """
    + _THIN.format(
        moved="abs(n.price - w.price) >= greatest(1.0, 0.5 * w.price)", heartbeat=7200000000
    ),
}
