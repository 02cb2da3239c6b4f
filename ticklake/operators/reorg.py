"""Ticks that arrive again with other content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.operators.ordered import fold, running, slice_hot
from ticklake.operators.parse import null_to_empty

# The window size and the texts of the reasons.
WINDOW_SIZE = 128
OUTPUT_REASON = "VDF output mismatch"
BATCH_REASON = "transaction batch hash mismatch"
PREVIOUS_REASON = "previous output mismatch"
COUNT_REASON = "transaction count mismatch"

_COMPARED = ["output", "batch_hash", "previous_output", "tx_count"]


def comparable(ticks: DataFrame) -> DataFrame:
    """The compared fields of nested ticks. ``output`` is null without a proof."""
    proof = F.col("vdf_proof")
    return ticks.select(
        "source_id",
        "arrival",
        "tick_number",
        F.when(proof.isNotNull(), null_to_empty(proof["output"])).alias("output"),
        null_to_empty("transaction_batch_hash").alias("batch_hash"),
        null_to_empty("previous_output").alias("previous_output"),
        F.coalesce(F.array_size("transactions"), F.lit(0)).alias("tx_count"),
    )


def conflict_reason(old: Column, new: Column) -> Column:
    """The differing fields in words, joined by commas."""
    counts = F.format_string(
        f"{COUNT_REASON} (%d vs %d)", old["tx_count"], new["tx_count"]
    )
    return F.concat_ws(
        ", ",
        F.when(old["output"] != new["output"], OUTPUT_REASON),
        F.when(old["batch_hash"] != new["batch_hash"], BATCH_REASON),
        F.when(old["previous_output"] != new["previous_output"], PREVIOUS_REASON),
        F.when(old["tx_count"] != new["tx_count"], counts),
    )


def reorg_events(rows: DataFrame, group_rows: int | None = None) -> DataFrame:
    """Every copy of a tick that conflicts with the remembered version of it.

    ``rows`` come from ``comparable``. Nothing is forgotten here; see ``windowed_events``
    for the bounded memory. The remembered version is the last copy that did not
    conflict. All such copies agree on everything but the output, and on the output
    except where one has no proof: a copy without a proof forgets the output, and the
    next one with a proof sets it. So the remembered output is the first one since the
    last copy without a proof, which running aggregates express.
    """
    keys, order = ["source_id", "tick_number"], ["arrival"]
    sliced, hot = slice_hot(rows, keys, order, group_rows)
    fixed = F.struct("batch_hash", "previous_output", "tx_count")
    step = running(sliced, keys, order, {"_first": ("first", fixed)}, inclusive=True, sliced=hot)
    alike = fixed == F.col("_first")
    proven = F.col("output").isNotNull()
    step = running(
        step, keys, order,
        {"_part": ("sum", F.when(alike & ~proven, 1).otherwise(0))}, sliced=hot,
    ).fillna(0, ["_part"])
    step = running(
        step, [*keys, "_part"], order,
        {"_output": ("first", F.when(alike & proven, F.col("output")))}, sliced=hot,
    )
    differs = proven & F.col("_output").isNotNull() & (F.col("output") != F.col("_output"))
    step = step.withColumn("_conflict", ~alike | differs)
    copy = F.struct("arrival", *_COMPARED)
    step = running(
        step, keys, order, {"old": ("last", F.when(~F.col("_conflict"), copy))}, sliced=hot
    )
    new = F.struct(*_COMPARED)
    return step.filter("_conflict").select(
        "source_id",
        "tick_number",
        "arrival",
        F.col("old.arrival").alias("old_arrival"),
        conflict_reason(F.col("old"), new).alias("conflict_reason"),
    )


def window_step(size: int):
    """Fold step that remembers recent ticks by number; the state is a map in JSON."""

    def step(state, columns, outputs):
        seen = {int(number): entry for number, entry in state.items()}
        compare(seen, size, columns, outputs)
        return {str(number): entry for number, entry in seen.items()}

    return step


def compare(seen, size: int, columns: list[list], outputs: list[list]) -> None:
    """Compare ticks with those in the mutable mapping ``seen`` and remember them there.

    After storing tick n with more than ``size`` numbers remembered, those below
    n - size + 1 are forgotten. A conflicting copy is reported and not stored.
    """
    reasons, old_arrivals, sizes = outputs
    for arrival, number, output, batch, previous, count in zip(*columns):
        old = seen.get(number)
        reason = [] if old is None else _differences(old, output, batch, previous, count)
        if reason:
            reasons.append(", ".join(reason))
            old_arrivals.append(old[0])
        else:
            reasons.append(None)
            old_arrivals.append(None)
            seen[number] = [arrival, output, batch, previous, count]
            if len(seen) > size:
                oldest = max(number - size + 1, 0)
                for stale in [n for n in seen if n < oldest]:
                    del seen[stale]
        sizes.append(len(seen))


def _differences(old, output, batch, previous, count) -> list[str]:
    _, old_output, old_batch, old_previous, old_count = old
    reasons = []
    if old_output is not None and output is not None and old_output != output:
        reasons.append(OUTPUT_REASON)
    if old_batch != batch:
        reasons.append(BATCH_REASON)
    if old_previous != previous:
        reasons.append(PREVIOUS_REASON)
    if old_count != count:
        reasons.append(f"{COUNT_REASON} ({old_count} vs {count})")
    return reasons


WINDOW_INPUTS = ["arrival", "tick_number", *_COMPARED]
WINDOW_OUTPUTS = [
    T.StructField("conflict_reason", T.StringType()),
    T.StructField("old_arrival", T.LongType()),
    T.StructField("window_entries", T.IntegerType()),
]


def windowed(
    rows: DataFrame, size: int = WINDOW_SIZE, group_rows: int | None = None
) -> DataFrame:
    """``comparable`` rows with the conflict found against the ticks still remembered."""
    return fold(
        rows,
        ["source_id"],
        ["arrival"],
        window_step(size),
        {},
        {name: F.col(name) for name in WINDOW_INPUTS},
        WINDOW_OUTPUTS,
        group_rows,
    )


def windowed_events(
    rows: DataFrame, size: int = WINDOW_SIZE, group_rows: int | None = None
) -> DataFrame:
    """``reorg_events`` with a memory of the most recent ``size`` tick numbers."""
    found = windowed(rows, size, group_rows).filter(F.col("conflict_reason").isNotNull())
    return found.select("source_id", "tick_number", "arrival", "old_arrival", "conflict_reason")


def reorg_stats(windowed_rows: DataFrame, size: int = WINDOW_SIZE) -> DataFrame:
    """Window size, numbers remembered at the end, and conflicts, per source."""
    return windowed_rows.groupBy("source_id").agg(
        F.lit(size).alias("window_size"),
        F.max_by("window_entries", "arrival").alias("current_window"),
        F.count("conflict_reason").alias("conflicts_found"),
    )


def apply_invalidations(rows: DataFrame, invalidations: DataFrame) -> DataFrame:
    """Rows of an invalidated tick stored before the event get version -1; what was
    stored later, as the replacement, keeps its version."""
    last = invalidations.groupBy("tick_number").agg(F.max("at").alias("_at"))
    hit = F.col("processed_at") < F.col("_at")
    return (
        rows.join(last, "tick_number", "left")
        .withColumn("version", F.when(hit, F.lit(-1)).otherwise(F.col("version")))
        .select(*rows.columns)
    )
