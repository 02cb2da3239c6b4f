"""Market snapshots: one JSON array of markets per poll."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake import schemas

# Fixed value: the kind of market whose mark price is kept.
PERP = "perp"


def explode_markets(polls: DataFrame, body: Column | str = "body") -> DataFrame:
    """One row per market of each poll; a body that is not a market list gives none."""
    markets = F.from_json(body, schemas.SNAPSHOT_MARKETS)
    kept = [c for c in polls.columns if c != body]
    return polls.select(*kept, F.explode(markets).alias("market")).select(*kept, "market.*")


def perp_prices(markets: DataFrame) -> DataFrame:
    """Mark prices of perpetual markets. The time is the engine's, in seconds, or that of
    the poll when the engine gave none."""
    state = F.col("perp_state")
    engine_time = F.timestamp_seconds(state["mark_price_timestamp"])
    kind = dict(markets.dtypes)["poll_time"]
    kept = [c for c in ("arrival",) if c in markets.columns]
    return markets.filter(
        (F.col("kind") == PERP) & state.isNotNull() & state["mark_price"].isNotNull()
    ).select(
        F.col("uuid").alias("market_id"),
        "poll_time",
        F.coalesce(engine_time.cast(kind), F.col("poll_time")).alias("ts"),
        state["mark_price"].alias("price"),
        *kept,
    )
