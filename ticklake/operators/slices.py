"""Folds over slices of equal size whose effects compose.

Rows are range-partitioned on (key, order), so a hot key covers many slices and a slice may
hold many keys. Only the key at the start of a slice can have begun before it. Its rows
there are summed up as a ``Transition``: what they do to any state that may enter. The
summaries of a key are put together in order, which gives the state that enters every
slice, and one more pass gives the rows their outputs. So the number of Spark
jobs is fixed, whether a fold forgets its past or not, and results do not depend on how
the rows were cut.

The order columns must identify a row within its key.
"""

from __future__ import annotations

import heapq
import json
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from math import nextafter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.functions.session import cut_lineage
from ticklake.operators.ordered import _ARROW, KEY, SLICE, _column, _emit, _key_text, _segments

# Parts of a slice that are summed up: its first key, and its last one.
FIRST, LAST = 0, 1


class Transition:
    """A fold, and summaries of what consecutive rows of one key do to its state.

    States are JSON-representable. ``step`` is the fold itself (see ``ordered.Step``).
    ``absorb`` adds rows to what ``open`` returned, ``close`` makes it JSON-representable,
    and ``apply`` of that must equal the fold of those rows.
    """

    start: object = None

    def step(self, state, columns: list[list], outputs: list[list]):
        raise NotImplementedError

    def open(self):
        raise NotImplementedError

    def absorb(self, summary, columns: list[list]) -> None:
        raise NotImplementedError

    def close(self, summary):
        return summary

    def apply(self, summary, state):
        raise NotImplementedError


class Bucket(Transition):
    """A token bucket in whole credits, so that rounding decides nothing.

    The rate is a fraction p / q of tokens per second: a microsecond brings p credits and a
    visit takes 1,000,000 q. State: credits and the time of the last visit. A summary is the
    credits left as a function of those found at the first visit: pieces of slope 1 or 0
    (``_Credits``), at most as many as the bucket holds tokens and the rows of the time that
    one token takes to come.
    """

    def __init__(self, gain: int, unit: int, burst: int):
        self.gain, self.unit, self.full = gain, unit, burst * unit
        self.start = [self.full, None]

    def _refilled(self, state, time) -> int:
        credits, last = state
        if last is None or time is None:
            return credits
        return min(credits + (time - last) * self.gain, self.full)

    def step(self, state, columns, outputs):
        credits, last = state
        admitted = outputs[0]
        for time in columns[0]:
            credits = self._refilled((credits, last), time)
            last = last if time is None else time
            admitted.append(credits >= self.unit)
            if credits >= self.unit:
                credits -= self.unit
        return [credits, last]

    def open(self):
        return {"first": None, "last": None, "credits": _Credits(self.unit, self.full)}

    def absorb(self, summary, columns):
        first, last, visit = summary["first"], summary["last"], summary["credits"].visit
        for time in columns[0]:
            first = time if first is None else first
            visit((time - last) * self.gain if time is not None and last is not None else 0)
            last = last if time is None else time
        summary["first"], summary["last"] = first, last

    def close(self, summary):
        return summary | {"credits": summary["credits"].pieces()}

    def apply(self, summary, state):
        credits = self._refilled(state, summary["first"])
        pieces = summary["credits"]
        _, slope, value = pieces[bisect_right(pieces, credits, key=lambda p: p[0]) - 1]
        return [slope * credits + value, state[1] if summary["last"] is None else summary["last"]]


class _Credits:
    """Credits after some visits as a function of the credits x at the first one.

    A piece is a range of x where the result is x + value or a constant. Gains are added
    to all pieces at once; a heap by the largest result gives those that a visit changes.
    Neighbours of slope 1 that have become equal are joined, and constants that have
    become equal are followed as one.
    """

    def __init__(self, unit: int, full: int):
        self.unit, self.full, self.gained = unit, full, 0
        self.sloped: dict[int, tuple[int, int]] = {}  # by first x: last x, value
        self.ending: dict[int, int] = {}  # by last x: first x
        self.constant: dict[int, list[int]] = {}  # by value: first x of the pieces
        self.heap: list[tuple[int, int, int]] = []  # -(largest result), slope, first x or value
        self._slope(0, full, 0)

    def visit(self, gain: int) -> None:
        self.gained += gain
        slopes, constants = [], []
        while self.heap and self.gained - self.heap[0][0] >= self.unit:
            top, slope, at = heapq.heappop(self.heap)
            if not slope:
                constants.append((min(at + self.gained, self.full) - self.unit, self.constant.pop(at)))
                continue
            high, value = self.sloped.get(at, (0, 0))
            if -top != high + value or at not in self.sloped:
                continue  # joined with another one since
            del self.sloped[at], self.ending[high]
            admitted, full = self.unit - value - self.gained, self.full - value - self.gained
            slopes.append((at, min(high, admitted - 1), value))
            slopes.append((max(at, admitted), min(high, full - 1), value - self.unit))
            if full <= high:
                constants.append((self.full - self.unit, [max(at, full)]))
        for part in slopes:
            if part[0] <= part[1]:
                self._slope(*part)
        for left, starts in constants:
            at = left - self.gained
            held = self.constant.get(at)
            if held is None:
                self.constant[at] = starts
                heapq.heappush(self.heap, (-at, 0, at))
            else:  # the shorter list goes into the longer one
                longer, shorter = (held, starts) if len(held) >= len(starts) else (starts, held)
                longer += shorter
                self.constant[at] = longer

    def _slope(self, low: int, high: int, value: int) -> None:
        before = self.ending.get(low - 1)
        if before is not None and self.sloped[before][1] == value:
            del self.ending[low - 1]
            low = before
        after = self.sloped.get(high + 1)
        if after is not None and after[1] == value:
            del self.sloped[high + 1]
            high = after[0]
        self.sloped[low], self.ending[high] = (high, value), low
        heapq.heappush(self.heap, (-high - value, 1, low))

    def pieces(self) -> list[list[int]]:
        """[least x, slope, value], by x; equal neighbours are one."""
        every = [(low, 1, value + self.gained) for low, (_, value) in self.sloped.items()]
        every += [(low, 0, value + self.gained) for value, starts in self.constant.items() for low in starts]
        found: list[list[int]] = []
        for low, slope, value in sorted(every):
            if not found or found[-1][1:] != [slope, value]:
                found.append([low, slope, value])
        return found


class Smoothing(Transition):
    """An exponential moving average that starts at the first value, to the last bit.

    A step is affine with a rounding that keeps the order of states. So the values are kept
    only until the least and the greatest state that may enter (``bounds`` of the values)
    have come within ``NEAR`` doubles of each other; from there a table of the doubles
    between them is carried on, in which equal ones merge. Nulls change nothing.
    """

    NEAR = 64

    def __init__(self, alpha: float, bounds: tuple[float, float]):
        self.alpha, self.bounds = alpha, bounds

    def _next(self, state: float, value: float) -> float:
        return (1 - self.alpha) * state + self.alpha * value

    def step(self, state, columns, outputs):
        for value in columns[0]:
            if value is not None:
                state = value if state is None else self._next(state, value)
            outputs[0].append(state)
        return state

    def open(self):
        return {"values": [], "ends": list(self.bounds), "points": None, "now": None}

    def absorb(self, summary, columns):
        values, ends, points, now = (summary[k] for k in ("values", "ends", "points", "now"))
        for value in columns[0]:
            if value is None:
                continue
            if points is None:
                values.append(value)
                ends = [self._next(x, value) for x in ends]
                points = self._between(*ends)
                now = None if points is None else list(points)
            else:
                moved = {x: self._next(x, value) for x in set(now)}
                now = [moved[x] for x in now]
        summary |= {"ends": ends, "points": points, "now": now}

    def _between(self, low: float, high: float) -> list[float] | None:
        points = [low]
        while points[-1] < high:
            if len(points) == self.NEAR:
                return None
            points.append(nextafter(points[-1], high))
        return points

    def apply(self, summary, state):
        for value in summary["values"]:
            state = value if state is None else self._next(state, value)
        if summary["points"] is None:
            return state
        return summary["now"][bisect_right(summary["points"], state) - 1]


def cut(df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int | None = None) -> DataFrame:
    """Rows sorted by key and order, with the key as text and the number of their slice.

    The numbers depend on sampled bounds, so they are fixed before any reuse. Without
    ``slices`` their number is that of shuffle partitions, fewer for small tables."""
    rows = df.withColumn(KEY, _key_text(keys))
    ranges = [F.col(c) for c in (KEY, *order)]
    ranged = rows.repartitionByRange(*ranges) if slices is None else rows.repartitionByRange(slices, *ranges)
    return cut_lineage(ranged.sortWithinPartitions(*ranges).withColumn(SLICE, F.spark_partition_id()))


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    transition: Transition,
    inputs: dict[str, Column],
    outputs: list[T.StructField],
    slices: int | None = None,
) -> DataFrame:
    """Add the outputs of a fold over the rows of each key, in order. Pass slim rows:
    everything in ``df`` travels to Python in Arrow batches."""
    names = [f"_in_{name}" for name in inputs]
    rows = cut(df.withColumns(dict(zip(names, inputs.values()))), keys, order, slices)
    seeds = entering(rows.select(KEY, SLICE, *names), transition, names, len(outputs))
    return emit(rows, df, transition, names, outputs, seeds)


def emit(rows: DataFrame, df: DataFrame, transition: Transition, names: list[str], outputs, seeds) -> DataFrame:
    """Rows of ``cut`` with the outputs of a fold, given the state that enters each slice."""
    kept = [T.StructField(f.name, f.dataType) for f in df.schema.fields]
    fields = [pa.field(f.name, _ARROW[f.dataType.simpleString()]) for f in outputs]
    arguments = (transition.step, transition.start, names, len(outputs), seeds, False)
    return rows.mapInArrow(_emit(arguments, fields, df.columns), T.StructType([*kept, *outputs]))


def entering(rows: DataFrame, transition: Transition, names: list[str], n_outputs: int) -> dict[int, str]:
    """The state, as JSON, that enters each slice with its first key. The summaries of a key
    are put together in one streamed pass; one small row per slice comes to the driver."""
    summaries = rows.mapInArrow(
        _summaries(transition, names, n_outputs), f"{KEY} string, {SLICE} int, part int, summary string"
    )
    walked = summaries.repartition(KEY).sortWithinPartitions(KEY, SLICE, "part").mapInArrow(
        _joined(transition), f"{SLICE} int, state string"
    )
    return {r[SLICE]: r["state"] for r in walked.collect()}


def _joined(transition: Transition):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = state = None
        for batch in batches:
            slices, states = [], []
            for at, slice_no, part, summary in zip(*(c.to_pylist() for c in batch.columns)):
                if at != key:
                    key, state = at, transition.start
                if part == LAST:
                    state = json.loads(summary)
                else:
                    slices.append(slice_no)
                    states.append(json.dumps(state))
                    state = transition.apply(json.loads(summary), state)
            yield pa.RecordBatch.from_pydict({SLICE: pa.array(slices, pa.int32()), "state": pa.array(states, pa.string())})

    return run


def _summaries(transition: Transition, names: list[str], n_outputs: int):
    """Per slice the summary of its first key, and if the last key is another one, the state
    after it. Keys between them are passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slice_no = first = last = state = None
        head = transition.open()
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
                    last, state = key, transition.start
                if key == first or key == last and high == batch.num_rows:
                    columns = [_column(batch, name).slice(low, high - low).to_pylist() for name in names]
                    if key == first:
                        transition.absorb(head, columns)
                    else:
                        state = transition.step(state, columns, [[] for _ in range(n_outputs)])
        if first is not None:
            parts = [(first, FIRST, transition.close(head))] + [(last, LAST, state)] * (last != first)
            yield pa.RecordBatch.from_pydict({
                KEY: [key for key, _, _ in parts], SLICE: pa.array([slice_no] * len(parts), pa.int32()),
                "part": pa.array([part for _, part, _ in parts], pa.int32()),
                "summary": [json.dumps(summary) for _, _, summary in parts],
            })

    return run
