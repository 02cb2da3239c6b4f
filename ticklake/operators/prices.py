"""Thinning of observed prices before they are stored.

Rows are (market_id, poll_time, arrival, price, ...), in order of (poll_time, arrival)
within a market.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.functions.session import cut_lineage
from ticklake.operators.lookup import first_per_key
from ticklake.operators.ordered import SLICE, running, slice_hot

# The heartbeat and the relative threshold.
HEARTBEAT_SECONDS = 30
EPSILON = 0.0001

KEYS, ORDER = ["market_id"], ["poll_time", "arrival"]


def _significant(price: Column, last: Column, min_tick: float, epsilon: float) -> Column:
    """Moved by at least ``min_tick`` and ``epsilon`` of the last observed price."""
    return F.abs(price - last) >= F.greatest(F.lit(min_tick), F.lit(epsilon) * last)


def changed_only(observed: DataFrame, group_rows: int | None = None) -> DataFrame:
    """The first price of a market, each that differs from the one observed before it,
    and each that follows a zero."""
    price = F.col("price")
    rows = running(observed, KEYS, ORDER, {"_last": ("last", price)}, group_rows=group_rows)
    last = F.col("_last")
    return rows.filter(last.isNull() | (last == 0) | (price != last)).drop("_last")


def moved_only(
    observed: DataFrame,
    min_tick: float = 0.0,
    epsilon: float = EPSILON,
    group_rows: int | None = None,
) -> DataFrame:
    """The first price, and each that moved by the threshold from the one before it."""
    price = F.col("price").cast("double")
    rows = running(observed, KEYS, ORDER, {"_last": ("last", price)}, group_rows=group_rows)
    last = F.col("_last")
    return rows.filter(last.isNull() | _significant(price, last, min_tick, epsilon)).drop("_last")


def thinning_step(
    heartbeat_seconds: float = HEARTBEAT_SECONDS,
    min_tick: float | None = None,
    epsilon: float = EPSILON,
):
    """Fold step that keeps a row when its price changed (or, with ``min_tick``, moved by
    the threshold), or when the last kept row of the market is a heartbeat old."""
    heartbeat = int(heartbeat_seconds * 1_000_000)

    def step(state, columns, outputs):
        last, kept_at = state
        keep = outputs[0]
        for time, price in zip(*columns):
            if kept_at is None or time - kept_at >= heartbeat:
                write = True
            elif min_tick is None:
                write = last == 0 or price != last
            else:
                write = abs(price - last) >= max(min_tick, epsilon * last)
            if write:
                kept_at = time
            last = price
            keep.append(write)
        return [last, kept_at]

    return step


THINNING_START = [0.0, None]
THINNING_OUTPUTS = [T.StructField("_keep", T.BooleanType())]


def thinning_inputs() -> dict[str, Column]:
    return {
        "time": F.unix_micros(F.col("poll_time").cast("timestamp")),
        "price": F.col("price").cast("double"),
    }


def thin(
    observed: DataFrame,
    heartbeat_seconds: float = HEARTBEAT_SECONDS,
    min_tick: float | None = None,
    epsilon: float = EPSILON,
    group_rows: int | None = None,
) -> DataFrame:
    """``changed_only`` (or, with ``min_tick``, ``moved_only``) plus a heartbeat: a row is
    also kept when the last kept one is ``heartbeat_seconds`` of poll time ago.

    Rows that moved, and rows a heartbeat after the row before them, are kept whatever came
    earlier. They cut a market into islands; inside one, each kept row points to the next row
    at least a heartbeat on, and the rows reached from the island's first one are kept
    (``_reached``). A row without a price has not moved.
    """
    beat = int(heartbeat_seconds * 1_000_000)
    price = F.col("price").cast("double")
    us = F.unix_micros(F.col("poll_time").cast("timestamp"))
    rows, hot = slice_hot(observed.withColumn("_us", us), KEYS, ORDER, group_rows)
    rows = running(
        rows, KEYS, ORDER, {"_last": ("last", price), "_before": ("last", F.col("_us"))}, sliced=hot
    )
    last = F.col("_last")
    moved = (
        (last == 0) | (price != last) if min_tick is None else _significant(price, last, min_tick, epsilon)
    )
    forced = F.col("_before").isNull() | (F.col("_us") - F.col("_before") >= beat) | moved
    rows = rows.withColumn("_kept", F.coalesce(forced, F.lit(False)))
    here = F.struct("_us", *ORDER)
    rows = running(rows, KEYS, ORDER, {"_island": ("last", F.when(F.col("_kept"), here))}, inclusive=True, sliced=hot)
    block = F.floor((F.col("_us") - F.col("_island._us")) / beat).cast("long")
    rows = rows.withColumns({"_block": block, "_place": here})
    # A row less than a heartbeat after the start of its island is not kept.
    rows = cut_lineage(rows.filter(F.col("_kept") | (F.col("_block") > 0)).drop("_last", "_before", SLICE))
    slim = rows.select(*KEYS, "_island", "_block", "_place")
    node = [*KEYS, "_island", "_place"]
    reached = _reached(_pointers(slim, beat), node)
    beats = rows.filter(~F.col("_kept")).join(reached, node, "left_semi")
    return rows.filter("_kept").unionByName(beats).select(*observed.columns)


def _pointers(rows: DataFrame, beat: int) -> DataFrame:
    """For each row of an island the next row at least ``beat`` on, with its block.

    Blocks are a heartbeat long and none inside an island is empty, so that row is in the
    next block, or is the first one of the block after that. Windows span one block."""
    cell = [*KEYS, "_island", "_block"]
    first = rows.groupBy(*cell).agg(F.min("_place").alias("_place"))
    target = F.struct(F.col("_place"), F.col("_block"))
    seen = rows.select(*cell, F.col("_place._us").alias("at"), F.lit(1).alias("asks"), target.alias("to"), F.col("_place").alias("of"))
    later = first.select(
        *KEYS, "_island", (F.col("_block") - 1).alias("_block"), F.col("_place._us").alias("at"),
        F.lit(1).alias("asks"), target.alias("to"), F.col("_place").alias("of"),
    )
    asking = rows.select(
        *KEYS, "_island", (F.col("_block") + 1).alias("_block"), (F.col("_place._us") + beat).alias("at"),
        F.lit(2).alias("asks"), F.lit(None).cast(seen.schema["to"].dataType).alias("to"), F.col("_place").alias("of"),
    )
    # From the latest on: a row counts for the questions at its time and before. Of equal
    # times the one that is first in order is met last.
    after = Window.partitionBy(*cell).orderBy(F.desc("at"), "asks", F.desc("of")).rowsBetween(
        Window.unboundedPreceding, 0
    )
    found = seen.union(later).union(asking).withColumn("to", F.last("to", ignorenulls=True).over(after))
    return found.filter("asks = 2").select(
        *KEYS, "_island", F.col("of").alias("_place"), (F.col("_block") - 1).alias("_block"),
        F.col("to._place").alias("_next"), F.col("to._block").alias("_next_block"),
    )


def _reached(nodes: DataFrame, node: list[str]) -> DataFrame:
    """The nodes reached from block 0 of their island by pointers that go one or two blocks on.

    Pointers are doubled: that of level k leads out of a span of 2^k blocks, and only the
    nodes of the first two blocks of a span can be where a path enters it, so each level
    has half the nodes of the one before. On the way down, the entry of a span gives the
    entry of its second half.
    """
    levels = [cut_lineage(nodes)]
    deepest = levels[0].agg(F.max("_block")).first()[0] or 0
    for level in range(int(deepest).bit_length()):
        here = levels[-1]
        wide = 2 << level
        entries = here.filter(F.col("_block") % wide < 2)
        onward = here.select(
            *node[:-1], F.col("_place").alias("_next"), F.col("_next").alias("_far"), F.col("_next_block").alias("_far_block")
        )
        inside = _span("_next_block", wide) == _span("_block", wide)
        goes_on = entries.filter(inside).join(onward, [*node[:-1], "_next"])
        levels.append(cut_lineage(
            entries.filter(~F.coalesce(inside, F.lit(False))).select(*nodes.columns).union(
                goes_on.select(*node, "_block", F.col("_far").alias("_next"), F.col("_far_block").alias("_next_block"))
            )
        ))
    reached = levels[-1].filter("_block = 0").select(*node, "_block")
    for level in reversed(range(len(levels) - 1)):
        step = levels[level].select(*node, "_next", "_next_block")
        inside = _span("_next_block", 2 << level) == _span("_block", 2 << level)
        second = F.when(inside, F.struct(F.col("_next").alias("_place"), F.col("_next_block").alias("_block")))
        both = F.array_compact(F.array(F.struct("_place", "_block"), second))
        reached = (
            reached.join(step, node).withColumn("_one", F.explode(both)).select(*node[:-1], "_one._place", "_one._block")
        )
    return reached.filter("_block > 0").select(*node)


def _span(block: str, size: int) -> Column:
    return F.floor(F.col(block) / size)


def first_per_time(prices: DataFrame, arrival: str = "arrival") -> DataFrame:
    """The first price that arrived for each market and time."""
    return first_per_key(prices, ["market_id", "ts"], [arrival])
