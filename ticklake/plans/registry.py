"""All registered queries and their oracle SQL."""

from __future__ import annotations

from ticklake.plans import (
    candle_plans,
    chain_plans,
    metric_plans,
    price_plans,
    quality_plans,
    stream_plans,
    upkeep_plans,
)

_MODULES = [candle_plans, chain_plans, quality_plans, price_plans, metric_plans, stream_plans, upkeep_plans]


def queries() -> dict:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}
