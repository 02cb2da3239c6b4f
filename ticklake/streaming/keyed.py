"""Keyed folds over streams, with the state kept by Spark.

These are the streaming forms of ``operators.ordered.fold`` and use the same steps. Rows
of one key within a micro-batch are put in order before they are folded: up to ``RUN_ROWS``
of them in memory, more in sorted runs that wait in a temporary file and are merged. So a
task holds one run, or a piece of each, however many rows a key has in a batch.
"""

from __future__ import annotations

import heapq
import json
import pickle
import tempfile
from collections.abc import Iterator, MutableMapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ticklake.operators import metrics, prices, quality, reorg

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PANDAS = {"boolean": "bool", "int": "Int32", "bigint": "Int64", "double": "float64"}

# Rows of one key that are sorted in memory, and those of a run that are read at once.
RUN_ROWS = 100_000
PIECE_ROWS = 1_000


def in_order(frames: Iterator[pd.DataFrame], order: list[str]) -> Iterator[pd.DataFrame]:
    """All rows in order, in frames of at most about ``RUN_ROWS`` rows."""
    held, count, runs, file = [], 0, [], None
    for frame in frames:
        if held and count + len(frame) > RUN_ROWS:
            file = file or tempfile.TemporaryFile()
            runs.append(_write_run(pd.concat(held).sort_values(order), file))
            held, count = [], 0
        held.append(frame)
        count += len(frame)
    if not held:
        return
    last = pd.concat(held).sort_values(order)
    if file is None:
        yield last
        return
    with file:
        runs.append(_write_run(last, file))
        del held, last, frame
        waiting = []
        for row in heapq.merge(*(_read_run(file, run, order) for run in runs), key=lambda row: row[0]):
            waiting.append(row)
            if len(waiting) >= RUN_ROWS // 4:
                yield _gathered(waiting)
                waiting = []
        if waiting:
            yield _gathered(waiting)


def _write_run(frame: pd.DataFrame, file) -> list[int]:
    """Where the pieces of the run begin in the file."""
    starts = []
    for low in range(0, len(frame), PIECE_ROWS):
        starts.append(file.tell())
        pickle.dump(frame.iloc[low : low + PIECE_ROWS], file, pickle.HIGHEST_PROTOCOL)
    return starts


def _read_run(file, starts: list[int], order: list[str]) -> Iterator[tuple]:
    """Rows of a run: what they are ordered by, their piece and their place in it."""
    for start in starts:
        file.seek(start)
        piece = pickle.load(file)
        keys = [
            [(null, None if null else value) for null, value in zip(piece[c].isna().tolist(), piece[c].tolist())]
            for c in order
        ]
        for place, key in enumerate(zip(*keys)):
            yield key, piece, place


def _gathered(rows: list[tuple]) -> pd.DataFrame:
    pieces: dict[int, tuple[pd.DataFrame, list[int], list[int]]] = {}
    for target, (_, piece, place) in enumerate(rows):
        _, places, targets = pieces.setdefault(id(piece), (piece, [], []))
        places.append(place)
        targets.append(target)
    found = pd.concat([piece.iloc[places] for piece, places, _ in pieces.values()])
    return found.iloc[np.argsort(np.concatenate([targets for *_, targets in pieces.values()]))]


class FoldProcessor(StatefulProcessor):
    """Folds the rows of a key in order; the state is kept as JSON text."""

    def __init__(self, step, init, order, inputs, keep, outputs, ttl_ms=None):
        self._step, self._start = step, json.dumps(init)
        self._order, self._inputs, self._keep = order, inputs, keep
        self._outputs, self._ttl_ms = outputs, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("fold", "state string", self._ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        stored = self._state.get()[0] if self._state.exists() else self._start
        state = json.loads(stored)
        for frame in in_order(rows, self._order):
            outputs: list[list] = [[] for _ in self._outputs]
            columns = [frame[name].tolist() for name in self._inputs]
            state = self._step(state, columns, outputs)
            added = {
                name: pd.array(values, dtype=kind) if kind else values
                for (name, kind), values in zip(self._outputs, outputs)
            }
            yield frame[self._keep].assign(**added)
        self._state.update((json.dumps(state),))

    def close(self) -> None:
        pass


def fold_stream(
    stream: DataFrame,
    keys: list[str],
    order: list[str],
    step,
    init,
    inputs: dict[str, Column],
    outputs: list[T.StructField],
    idle_ms: int | None = None,
) -> DataFrame:
    """``fold`` over a stream. ``idle_ms`` forgets a key that was not seen for that long."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    # No leading underscore: the state runner renames such columns.
    rows = stream.withColumns({f"fold_{name}": column for name, column in inputs.items()})
    schema = T.StructType([*stream.schema.fields, *outputs])
    processor = FoldProcessor(
        step, init, order, [f"fold_{name}" for name in inputs], stream.columns,
        [(f.name, _PANDAS.get(f.dataType.simpleString())) for f in outputs], idle_ms,
    )
    return rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=schema,
        outputMode="Append",
        timeMode="None" if idle_ms is None else "ProcessingTime",
    )


def sequence_stream(slim: DataFrame) -> DataFrame:
    """Slim ticks with the last valid number and time before each."""
    return fold_stream(
        slim, ["source_id"], ["arrival"], quality.sequence_step, [0, 0],
        {"number": F.col("tick_number"), "time": F.col("timestamp"), "good": F.col("good")},
        quality.STATE_FIELDS,
    )


class Remembered(MutableMapping):
    """A map state as a mapping: values are read when asked for, changes written by ``save``."""

    def __init__(self, state):
        self._state, self._changed = state, {}
        self._numbers = {number for (number,) in state.keys()} if state.exists() else set()
        self._stored = set(self._numbers)

    def __getitem__(self, number):
        if number not in self._numbers:
            raise KeyError(number)
        if number not in self._changed:
            self._changed[number] = tuple(self._state.getValue((number,)))
        return self._changed[number]

    def __setitem__(self, number, entry):
        self._numbers.add(number)
        self._changed[number] = tuple(entry)

    def __delitem__(self, number):
        self._numbers.remove(number)
        self._changed.pop(number, None)

    def __iter__(self):
        return iter(self._numbers)

    def __len__(self):
        return len(self._numbers)

    def save(self) -> None:
        for number in self._stored - self._numbers:
            self._state.removeKey((number,))
        for number, entry in self._changed.items():
            self._state.updateValue((number,), entry)


class ReorgProcessor(StatefulProcessor):
    """Compares ticks with those remembered per number. A batch reads the numbers, reads and
    writes the entries of its own ticks and removes those that it puts out of the window."""

    def __init__(self, size: int):
        self._size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._seen = handle.getMapState(
            "seen", "number bigint",
            "arrival bigint, output string, batch_hash string, previous_output string, tx_count int",
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        seen = Remembered(self._seen)
        for frame in in_order(rows, ["arrival"]):
            outputs: list[list] = [[] for _ in reorg.WINDOW_OUTPUTS]
            reorg.compare(seen, self._size, [frame[name].tolist() for name in reorg.WINDOW_INPUTS], outputs)
            reasons, old_arrivals, _ = outputs
            found = frame[["source_id", "tick_number", "arrival"]].assign(
                old_arrival=pd.array(old_arrivals, dtype="Int64"), conflict_reason=reasons
            )
            yield found[[reason is not None for reason in reasons]]
        seen.save()

    def close(self) -> None:
        pass


def reorg_stream(rows: DataFrame, size: int = reorg.WINDOW_SIZE) -> DataFrame:
    """Conflicts with the ticks remembered per source, as they arrive."""
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    columns = ["source_id", "tick_number", "arrival"]
    schema = T.StructType(
        [*rows.select(*columns).schema.fields, T.StructField("old_arrival", T.LongType()),
         T.StructField("conflict_reason", T.StringType())]
    )
    return rows.groupBy("source_id").transformWithStateInPandas(
        statefulProcessor=ReorgProcessor(size), outputStructType=schema, outputMode="Append", timeMode="None"
    )


def thin_stream(
    observed: DataFrame,
    heartbeat_seconds: float = prices.HEARTBEAT_SECONDS,
    min_tick: float | None = None,
    epsilon: float = prices.EPSILON,
) -> DataFrame:
    """Observed prices worth storing, as they arrive."""
    rows = fold_stream(
        observed, prices.KEYS, prices.ORDER,
        prices.thinning_step(heartbeat_seconds, min_tick, epsilon), prices.THINNING_START,
        prices.thinning_inputs(), prices.THINNING_OUTPUTS,
    )
    return rows.filter("_keep").drop("_keep")


# Fixed value: a key that was idle this long starts again with a full bucket.
IDLE_MS = 10 * 60 * 1000


def admit_stream(
    events: DataFrame, rate_per_second: float, burst: int, idle_ms: int | None = IDLE_MS
) -> DataFrame:
    """Events marked admitted or limited, as they arrive.

    With ``idle_ms`` the state depends on the clock, and Spark keeps starting empty
    batches to look at it. A run with the ``availableNow`` trigger then ends only if
    ``spark.sql.streaming.noDataMicroBatches.enabled`` is off.
    """
    bucket = metrics.bucket(rate_per_second, burst)
    return fold_stream(
        events, ["key"], ["ts", "event_id"], bucket.step, bucket.start, {"time": F.unix_micros(F.col("ts").cast("timestamp"))},
        metrics.BUCKET_OUTPUTS, idle_ms,
    )
