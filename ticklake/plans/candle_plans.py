"""Candles over the event values, seen as market prices."""

from __future__ import annotations

from datetime import datetime

from ticklake.operators import candles as c
from ticklake.plans.adapters import MARKET_PRICES, market_prices

# The whole span of the event table; the second starts off a bucket boundary.
START, END = datetime(2024, 1, 1), datetime(2024, 1, 31)
ODD_START, ODD_END = datetime(2024, 1, 3, 10, 20), datetime(2024, 1, 9, 5, 30)


def _query(tf, start, end, **options):
    return lambda spark, sf_dir: c.candles(market_prices(spark, sf_dir), tf, start, end, **options)


def _sql(tf: str, start: datetime, end: datetime, fill: str | None, lead_bucket: bool = True):
    width = f"INTERVAL {int(c.timeframe(tf).total_seconds())} SECOND"
    since, until = f"TIMESTAMP '{start}'", f"TIMESTAMP '{end}'"
    origin = "TIMESTAMP '1970-01-01'"
    low = since if fill is None else f"{since} - {width}"
    head = f"""WITH {MARKET_PRICES},
found AS (
  SELECT market_id, time_bucket({width}, ts, {origin}) AS t,
    CAST(arg_min(price, ts) AS DOUBLE) AS o, CAST(max(price) AS DOUBLE) AS h,
    CAST(min(price) AS DOUBLE) AS l, CAST(arg_max(price, ts) AS DOUBLE) AS c
  FROM market_prices WHERE ts >= {low} AND ts < {until} GROUP BY 1, 2)"""
    if fill is None:
        return f"{head} SELECT * FROM found"
    head += f""",
grid AS (
  SELECT market_id, unnest(generate_series(time_bucket({width}, {since}, {origin}),
    {until} - INTERVAL 1 MICROSECOND, {width})) AS t
  FROM (SELECT DISTINCT market_id FROM found)
  UNION SELECT market_id, t FROM found),
filled AS (
  SELECT g.market_id, g.t, f.o, f.h, f.l, f.c
  FROM grid g LEFT JOIN found f ON f.market_id = g.market_id AND f.t = g.t)"""
    keep = "" if lead_bucket else f" WHERE t >= time_bucket({width}, {since}, {origin})"
    if fill == "null":
        return f"{head} SELECT * FROM filled{keep}"
    return f"""{head},
carried AS (
  SELECT *, last_value(c IGNORE NULLS) OVER (PARTITION BY market_id ORDER BY t
    ROWS UNBOUNDED PRECEDING) AS seen FROM filled)
SELECT market_id, t, coalesce(o, seen) AS o, coalesce(h, seen) AS h,
  coalesce(l, seen) AS l, coalesce(c, seen) AS c FROM carried{keep}"""


_CASES = {
    "candles_hourly_locf": ("1h", START, END, dict(fill="locf")),
    "candles_hourly_gapfill": ("1h", ODD_START, ODD_END, dict(fill="null")),
    "candles_5m_locf_no_lead": ("5m", ODD_START, ODD_END, dict(fill="locf", lead_bucket=False)),
    "candles_1m_gapfill": ("1m", ODD_START, ODD_END, dict(fill="null")),
    "candles_15m_only_data": ("15m", START, END, dict(fill=None)),
    "candles_4h_locf": ("4h", ODD_START, ODD_END, dict(fill="locf")),
    "candles_daily_gapfill": ("1d", ODD_START, ODD_END, dict(fill="null")),
}

QUERIES = {k: _query(tf, s, e, **o) for k, (tf, s, e, o) in _CASES.items()}
SQL = {k: _sql(tf, s, e, **o) for k, (tf, s, e, o) in _CASES.items()}
