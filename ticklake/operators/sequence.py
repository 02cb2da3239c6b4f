"""Which ticks of a source are accepted in sequence, for sources of any size.

Whether a tick is accepted depends on the last accepted one, but what follows an
accepted tick depends on that tick alone. So the accepted ticks form a chain of pointers,
and a slice of ticks is summed up by a table of outcomes: for each tick that may be the
first one accepted there, the last one accepted in the slice (``_outcomes``; chains that meet
are one from then on). The next slice a chain enters is found by a join on the number, since a
jump is limited, with the least place of the ticks that follow: slices which accept nothing
are skipped, however many they are. Only the last ticks of slices are followed, key by key
in one streamed pass, and a last pass over the slices gives each tick its state. The number
of Spark jobs is fixed.
"""

from __future__ import annotations

import heapq
import json
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.functions.session import cut_lineage
from ticklake.operators.ordered import KEY, SLICE, _column, _segments
from ticklake.operators.slices import Transition, cut, emit

# Fixed value: the largest step between two tick numbers.
MAX_JUMP = 1000

STATE_FIELDS = [
    T.StructField("last_number", T.LongType()),
    T.StructField("last_time", T.LongType()),
    T.StructField("accepted", T.BooleanType()),
]

_OUTCOMES = (
    f"{KEY} string, {SLICE} int, place long, number long, time long, "
    "end_place long, end_number long, end_time long"
)


def sequence_step(state, columns, outputs):
    """State is the last valid tick number and time. Only a tick without any issue moves
    it on, so after a jump beyond the limit all later ticks keep failing."""
    last, last_time = state
    before, before_time, accepted = outputs
    for number, time, good in zip(*columns):
        before.append(last)
        before_time.append(last_time)
        if last > 0 and not 0 < number - last <= MAX_JUMP:
            good = False
        if time and last_time > 0 and time < last_time:
            good = False
        accepted.append(good)
        if good:
            last, last_time = number, time
    return [last, last_time]


class Sequence(Transition):
    """The fold alone; what slices do to a state is found by ``accepted_before``."""

    start = [0, 0]
    step = staticmethod(sequence_step)


def sequence_state(slim: DataFrame, slices: int | None = None) -> DataFrame:
    """Slim rows (source_id, arrival, tick_number, timestamp, good) with the last valid
    number and time before each, and whether the row itself is accepted."""
    inputs = {"number": "tick_number", "time": "timestamp", "good": "good"}
    names = [f"_in_{name}" for name in inputs]
    rows = cut(slim.withColumns({n: F.col(c) for n, c in zip(names, inputs.values())}), ["source_id"], ["arrival"], slices)
    return emit(rows, slim, Sequence(), names, STATE_FIELDS, accepted_before(rows, names))


def accepted_before(rows: DataFrame, names: list[str]) -> dict[int, str]:
    """The state, as JSON, that enters each slice with its first key; as many small rows as
    there are slices come to the driver."""
    slim = rows.select(KEY, SLICE, F.col("arrival").cast("long").alias("place"), *names)
    table = cut_lineage(slim.mapInArrow(_outcomes(names), _OUTCOMES))
    # place -1: what a key ends with that begins in the slice; these give the first and last keys
    own = table.filter("place = -1").select(KEY, SLICE, F.col("time").alias("part")).collect()
    spans = {(r[SLICE], r["part"]): r[KEY] for r in own}
    reached = _walked(table).collect()
    by_key: dict[str, tuple[list, list]] = {}
    for r in sorted(reached, key=lambda r: r[SLICE]):
        slices, states = by_key.setdefault(r[KEY], ([], [[0, 0]]))
        slices.append(r[SLICE])
        states.append([r["number"], r["time"]])
    seeds, last_of = {}, None
    for slice_no in sorted({s for s, _ in spans}):
        first = spans[slice_no, 0]
        slices, states = by_key.get(first, ([], [[0, 0]]))
        seeds[slice_no] = json.dumps(states[bisect_left(slices, slice_no)] if first == last_of else [0, 0])
        last_of = spans.get((slice_no, 1), first)
    return seeds


def _walked(table: DataFrame) -> DataFrame:
    """The last accepted tick of every slice that accepts one, for keys in several slices."""
    ends = table.select(
        KEY, SLICE, (F.col("place") == -1).alias("own"), F.col("end_place").alias("place"),
        F.col("end_number").alias("number"), F.col("end_time").alias("time"),
    ).distinct()
    entries = table.filter("place >= 0").select(
        KEY, F.col(SLICE).alias("to_slice"), F.col("place").alias("to_place"), F.col("number").alias("n"),
        F.col("time").alias("t"), F.expr(f"number div {MAX_JUMP}").alias("span"),
        F.struct(SLICE, "place", "end_place").alias("entry"),
    )
    follows = (
        (F.col("to_slice") > F.col(SLICE))
        & ((F.col("t") == 0) | (F.col("time") <= 0) | (F.col("t") >= F.col("time")))
    )
    step = F.col("n") - F.col("number")
    numbered = (
        ends.filter("number > 0")
        .withColumn("span", F.explode(F.expr(f"array(number div {MAX_JUMP}, number div {MAX_JUMP} + 1)")))
        .join(entries, [KEY, "span"])
        .filter(follows & (step > 0) & (step <= MAX_JUMP))
    )
    unset = ends.filter("number <= 0").join(entries.drop("span"), KEY).filter(follows)
    node = [KEY, SLICE, "own", "place", "number", "time"]
    entered = (
        numbered.select(*node, "entry").union(unset.select(*node, "entry"))
        .groupBy(*node).agg(F.min("entry").alias("entry"))
        .select(*node, F.col(f"entry.{SLICE}").alias("to_slice"), F.col("entry.end_place").alias("to_place"))
    )
    nodes = entered.unionByName(ends.select(*node), allowMissingColumns=True).groupBy(*node).agg(
        F.max("to_slice").alias("to_slice"), F.max("to_place").alias("to_place")
    )
    order = [KEY, SLICE, F.desc("own"), "place"]
    return nodes.repartition(KEY).sortWithinPartitions(*order).mapInArrow(
        _chain, f"{KEY} string, {SLICE} int, number long, time long"
    )


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Follows the nodes of each key, which come in order of their slices."""
    key = wanted = None
    for batch in batches:
        found: list[tuple] = []
        columns = (batch[c].to_pylist() for c in (KEY, SLICE, "own", "place", "number", "time", "to_slice", "to_place"))
        for at, slice_no, own, place, number, time, to_slice, to_place in zip(*columns):
            if at != key:
                key, wanted = at, (slice_no, None)
            if (own and wanted == (slice_no, None)) or (not own and wanted == (slice_no, place)):
                found.append((at, slice_no, number, time))
                wanted = (to_slice, to_place)
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64()]
        arrays = [pa.array(c, kind) for c, kind in zip(list(zip(*found)) or [()] * 4, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=[KEY, SLICE, "number", "time"])


class _Chains:
    """Chains of accepted ticks of one key in a slice, begun at every tick that is good.

    A chain is known by the state it has reached. Open states are kept by number, those of
    equal number in a heap by time, so that a tick meets only states it may follow.
    """

    def __init__(self):
        self.ticks: list[tuple[int, int, int]] = []
        self.follower: list[int] = []  # of a tick, the tick accepted after it in the slice
        self.open: dict[int, dict[int, list[tuple[int, int]]]] = {}

    def add(self, place: int, number: int, time: int) -> None:
        here = len(self.ticks)
        for span in {(number - 1) // MAX_JUMP, (number - MAX_JUMP) // MAX_JUMP}:
            states = self.open.get(span, {})
            for last in [n for n in states if 0 < n < number <= n + MAX_JUMP]:
                self._follow(states, last, time, here)
        unset = self.open.get(None, {})
        for last in list(unset):
            self._follow(unset, last, time, here)
        self.ticks.append((place, number, time))
        self.follower.append(-1)
        states = self.open.setdefault(number // MAX_JUMP if number > 0 else None, {})
        heapq.heappush(states.setdefault(max(number, 0), []), (max(time, 0), here))

    def _follow(self, states: dict, last: int, time: int, here: int) -> None:
        heap = states[last]
        while heap and (time == 0 or heap[0][0] <= 0 or heap[0][0] <= time):
            self.follower[heapq.heappop(heap)[1]] = here
        if not heap:
            del states[last]

    def ends(self) -> list[int]:
        found = list(range(len(self.ticks)))
        for at in reversed(found):
            if self.follower[at] >= 0:
                found[at] = found[self.follower[at]]
        return found


def _outcomes(names: list[str]):
    schema = pa.schema([
        (KEY, pa.string()), (SLICE, pa.int32()), *((c, pa.int64()) for c in (
            "place", "number", "time", "end_place", "end_number", "end_time"))
    ])

    def rows(key, slice_no, columns) -> pa.RecordBatch:
        n = len(columns[0])
        arrays = [pa.array([key] * n, pa.string()), pa.array([slice_no] * n, pa.int32()), *(pa.array(c, pa.int64()) for c in columns)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slice_no = first = last = None
        chains, states = _Chains(), [[0, 0, -1], [0, 0, -1]]  # of the first and the last key
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = _column(batch, KEY)
            if first is None:
                slice_no, first = _column(batch, SLICE)[0].as_py(), keys[0].as_py()
                last = first
            cuts = _segments(keys)
            for low, high in zip(cuts, cuts[1:]):
                key = keys[low].as_py()
                if key != last:
                    last, states[1] = key, [0, 0, -1]
                if key != first and not (key == last and high == batch.num_rows):
                    continue
                places, *columns = (
                    _column(batch, name).slice(low, high - low).to_pylist() for name in ("place", *names)
                )
                state, accepted = states[key != first], []
                state[:2] = sequence_step(state[:2], columns, [[], [], accepted])
                taken = [p for p, good in zip(places, accepted) if good]
                state[2] = taken[-1] if taken else state[2]
                if key == first:
                    for place, number, time, good in zip(places, *columns):
                        if good:
                            chains.add(place, number, time)
        if first is None:
            return
        for part in range(1 + (last != first)):
            number, time, place = states[part]
            yield rows((first, last)[part], slice_no, [[-1], [0], [part], [place], [number], [time]])
        ends = [chains.ticks[at] for at in chains.ends()]
        for low in range(0, len(ends), 10_000):
            some, their = chains.ticks[low : low + 10_000], ends[low : low + 10_000]
            yield rows(first, slice_no, [*map(list, zip(*some)), *map(list, zip(*their))])

    return run
