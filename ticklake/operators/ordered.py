"""Ordered computations per key that stay split when one key is hot.

A plain ``Window.partitionBy(key).orderBy(...)`` puts all rows of a key into one
task. That is right while keys are of moderate size and hopeless when one market or
one source holds a third of the table. The functions here first measure the largest
key (a map-side combined count over the key columns only). Up to ``group_rows`` the
ordinary window or sorted partition is used. Beyond it the rows are range-partitioned
on (key, order), so a hot key covers many *slices* of equal size; each slice is
computed alone and corrected by what the earlier slices of the key carry into it.

The order columns must identify a row within its key.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from math import ceil

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ticklake.functions.session import cut_lineage, shuffle_partitions
from ticklake.operators.parse import packed, unpacked

SLICE = "_slice"
KEY = "_key"
STORED = "_stored"
MARK = "_mark"

# Rows of one key that a single task may sort or fold.
GROUP_ROWS = 5_000_000


def group_sizes(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Rows of the largest key, and of all keys together."""
    row = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.max("n").alias("largest"), F.sum("n").alias("total"))
        .first()
    )
    return row["largest"] or 0, row["total"] or 0


def _range_slices(df: DataFrame, columns: Sequence[str], total: int, group_rows: int) -> DataFrame:
    count = max(shuffle_partitions(df.sparkSession), ceil(total / group_rows))
    sliced = (
        df.repartitionByRange(count, *columns)
        .sortWithinPartitions(*columns)
        .withColumn(SLICE, F.spark_partition_id())
    )
    # The slice numbers depend on sampled bounds, so they are fixed before any reuse.
    return cut_lineage(sliced)


def slice_hot(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], group_rows: int | None = None
) -> tuple[DataFrame, bool]:
    """Rows with a slice number, and whether any key spans several slices."""
    limit = group_rows or GROUP_ROWS
    largest, total = group_sizes(df, keys)
    if largest <= limit:
        return df, False
    return _range_slices(df, [*keys, *order], total, limit), True


def _key_text(keys: Sequence[str]) -> Column:
    """The key as one text that is never null, so that plain equality joins it."""
    if len(keys) == 1:
        text = F.concat(F.lit("="), F.col(keys[0]).cast("string"))
    else:
        text = F.to_json(F.struct(*keys))
    return F.coalesce(text, F.lit(""))


_RUNNING: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum,
    "max": F.max,
    "min": F.min,
    "first": lambda c: F.first(c, ignorenulls=True),
    "last": lambda c: F.last(c, ignorenulls=True),
}


def _slice_total(kind: str, value: Column, order: Sequence[str]) -> Column:
    if kind == "first":
        return F.min_by(value, F.when(value.isNotNull(), F.struct(*order)))
    if kind == "last":
        return F.max_by(value, F.when(value.isNotNull(), F.struct(*order)))
    return _RUNNING[kind](value)


def _join_carry(kind: str, local: Column, carry: Column, data_type: T.DataType) -> Column:
    if kind == "sum":
        total = local + carry
        if isinstance(data_type, T.DecimalType) and data_type.precision == 38:
            # Adding decimals of 38 digits rounds the last place away, of 37 digits it does not.
            exact = T.DecimalType(37, data_type.scale)
            total = local.cast(exact) + carry.cast(exact)
        return F.when(local.isNull(), carry).when(carry.isNull(), local).otherwise(total)
    if kind == "max":
        return F.greatest(local, carry)
    if kind == "min":
        return F.least(local, carry)
    return F.coalesce(carry, local) if kind == "first" else F.coalesce(local, carry)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, tuple[str, Column]],
    inclusive: bool = False,
    group_rows: int | None = None,
    sliced: bool | None = None,
) -> DataFrame:
    """Add running aggregates over the earlier rows of each key.

    ``values`` maps an output name to ``(kind, column)`` with kind ``sum``, ``max``,
    ``min``, ``first`` or ``last`` (the last two skip nulls). ``inclusive`` also counts
    the row itself. ``sliced`` tells that the rows already went through ``slice_hot``
    and whether it split them; the slice column is then left in place.
    """
    owned = sliced is None
    rows, hot = slice_hot(df, keys, order, group_rows) if owned else (df, sliced)
    cells = [KEY, SLICE] if hot else list(keys)
    frame = (
        Window.partitionBy(*cells)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    inputs = rows.withColumns({f"_v_{name}": column for name, (_, column) in values.items()})
    if hot:
        inputs = inputs.withColumn(KEY, _key_text(keys))
    local = inputs.withColumns(
        {name: _RUNNING[kind](F.col(f"_v_{name}")).over(frame) for name, (kind, _) in values.items()}
    )
    if hot:
        before = (
            Window.partitionBy(KEY).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        )
        totals = inputs.groupBy(*cells).agg(
            *[
                _slice_total(kind, F.col(f"_v_{name}"), order).alias(f"_t_{name}")
                for name, (kind, _) in values.items()
            ]
        )
        carried = totals.select(
            *cells,
            *[
                _RUNNING[kind](F.col(f"_t_{name}")).over(before).alias(f"_c_{name}")
                for name, (kind, _) in values.items()
            ],
        )
        # Same keys as the window above: the rows are not shuffled again for this join.
        joined = local.alias("l").join(carried.alias("r"), cells, "left")
        local = joined.select(
            *[F.col(f"l.{c}") for c in inputs.columns],
            *[
                _join_carry(kind, F.col(f"l.{name}"), F.col(f"r._c_{name}"), local.schema[name].dataType).alias(name)
                for name, (kind, _) in values.items()
            ],
        )
    out = local.drop(KEY, *[f"_v_{name}" for name in values])
    return out.drop(SLICE) if owned else out


# A step takes the state, the input columns of consecutive rows of one key, and the
# output lists to append to; it returns the new state (JSON-representable).
Step = Callable[[object, list[list], list[list]], object]


def _segments(keys: pa.Array) -> list[int]:
    if len(keys) < 2:
        return [0, len(keys)]
    changed = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1))
    starts = pc.indices_nonzero(changed).to_pylist()
    return [0, *[i + 1 for i in starts], len(keys)]


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


class _Walker:
    """Folds sorted batches key after key.

    ``seeds`` maps a slice to the state its first key enters with (None when rows are
    not sliced). ``ended`` collects the state after the last row of each key.
    """

    def __init__(self, step: Step, init, inputs, n_outputs: int, seeds, marked: bool):
        self.step, self.inputs, self.n_outputs = step, inputs, n_outputs
        self.start, self.seeds, self.marked = json.dumps(init), seeds, marked
        self.key = self.slice_no = self.state = None
        self.ended: list[tuple[str, int, str]] = []

    def _end_key(self) -> None:
        if self.key is not None:
            self.ended.append((self.key, self.slice_no or 0, json.dumps(self.state)))

    def take_ended(self) -> list[tuple[str, int, str]]:
        ended, self.ended = self.ended, []
        return ended

    def finish(self) -> list[tuple[str, int, str]]:
        self._end_key()
        return self.take_ended()

    def fold(self, batch: pa.RecordBatch) -> list[list]:
        keys = _column(batch, KEY)
        columns = [_column(batch, name).to_pylist() for name in self.inputs]
        stored = _column(batch, STORED).to_pylist() if self.marked else None
        slice_no = None if self.seeds is None else _column(batch, SLICE)[0].as_py()
        outputs: list[list] = [[] for _ in range(self.n_outputs)]
        cuts = _segments(keys)
        for low, high in zip(cuts, cuts[1:]):
            key = keys[low].as_py()
            if key != self.key or slice_no != self.slice_no:
                self._end_key()
                entered = self.start
                if slice_no != self.slice_no:
                    entered = self.seeds.get(slice_no, self.start)
                self.key, self.slice_no, self.state = key, slice_no, json.loads(entered)
            if self.marked and stored[low] is not None:
                self.state = json.loads(stored[low])
                for values in outputs:
                    values.append(None)
                low += 1
            if low < high:
                self.state = self.step(self.state, [c[low:high] for c in columns], outputs)
        return outputs


def _emit(walker_args, out_fields, keep):
    """Rows with the outputs of the fold."""

    def run(batches):
        walker = _Walker(*walker_args)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            outputs = walker.fold(batch)
            walker.take_ended()
            added = [pa.array(v, type=f.type) for v, f in zip(outputs, out_fields)]
            yield pa.RecordBatch.from_arrays(
                [*[_column(batch, name) for name in keep], *added],
                names=[*keep, *[f.name for f in out_fields]],
            )

    return run


def _state_rows(ended) -> list[pa.RecordBatch]:
    if not ended:
        return []
    keys, slices, states = zip(*ended)
    return [
        pa.RecordBatch.from_pydict(
            {
                KEY: pa.array(keys, pa.string()),
                SLICE: pa.array(slices, pa.int32()),
                "state": pa.array(states, pa.string()),
            }
        )
    ]


def _emit_states(walker_args):
    """One row per key and slice with the state after its last row there."""

    def run(batches):
        walker = _Walker(*walker_args)
        for batch in batches:
            if batch.num_rows:
                walker.fold(batch)
                yield from _state_rows(walker.take_ended())
        yield from _state_rows(walker.finish())

    return run


def _emit_both(walker_args, out_fields, keep, schema: pa.Schema):
    """Rows with the outputs of the fold, and rows of ``_emit_states`` with nothing else."""

    def full(batch: pa.RecordBatch) -> pa.RecordBatch:
        held = set(batch.schema.names)
        columns = [
            _column(batch, f.name) if f.name in held else pa.nulls(batch.num_rows, f.type) for f in schema
        ]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    def run(batches):
        walker = _Walker(*walker_args)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            outputs = walker.fold(batch)
            added = [pa.array(v, type=f.type) for v, f in zip(outputs, out_fields)]
            yield full(pa.RecordBatch.from_arrays(
                [*[_column(batch, name) for name in keep], *added],
                names=[*keep, *[f.name for f in out_fields]],
            ))
            yield from map(full, _state_rows(walker.take_ended()))
        yield from map(full, _state_rows(walker.finish()))

    return run


def _emit_summary(walker_args):
    """One row per slice: its first and last key and the state after its last row."""

    def run(batches):
        walker = _Walker(*walker_args)
        first = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if first is None:
                first = _column(batch, KEY)[0].as_py()
            walker.fold(batch)
            walker.take_ended()
        if first is not None:
            (last, slice_no, state), *_ = walker.finish()
            yield pa.RecordBatch.from_pydict(
                {
                    SLICE: pa.array([slice_no], pa.int32()),
                    "first_key": [first],
                    "last_key": [last],
                    "state": [state],
                }
            )

    return run


def _settle_seeds(slices: DataFrame, step, init, inputs, n_outputs, marked) -> dict[int, str]:
    """States that enter each slice, found by repeating slices whose input changed.

    Every slice is first folded from the initial state; then each is folded again from
    the final state of the slice before it, until nothing changes. Slice k is certain
    after k rounds at the latest; a fold that forgets its past needs two or three. Only
    one row per slice reaches the driver, so this is bounded by the partition count.
    """
    schema = f"{SLICE} int, first_key string, last_key string, state string"
    slim = slices.select(KEY, SLICE, *([STORED] if marked else []), *inputs)
    start = json.dumps(init)
    seeds: dict[int, str] = {}
    finals: dict[int, tuple[str, str, str]] = {}
    pending: list[int] | None = None
    while pending is None or pending:
        todo = slim if pending is None else slim.filter(F.col(SLICE).isin(pending))
        summary = _emit_summary((step, init, inputs, n_outputs, seeds, marked))
        rows = todo.mapInArrow(summary, schema).collect()
        finals.update({r[SLICE]: (r["first_key"], r["last_key"], r["state"]) for r in rows})
        wanted: dict[int, str] = {}
        previous = None
        for slice_no in sorted(finals):
            first_key, last_key, state = finals[slice_no]
            if previous is not None and previous[0] == first_key:
                wanted[slice_no] = previous[1]
            previous = (last_key, state)
        pending = [s for s, state in wanted.items() if seeds.get(s, start) != state]
        seeds = wanted
    return seeds


def fold_with_states(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    step: Step,
    init,
    inputs: dict[str, Column],
    outputs: list[T.StructField],
    group_rows: int | None = None,
    start: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``fold``, and the state of every key after its last row as (_key, state).

    ``start`` has the same shape and gives the states to go on from; a key that occurs
    only there keeps its state.
    """
    rows, arguments, keep, kept, fields = _prepared(
        df, keys, order, step, init, inputs, outputs, group_rows, start
    )
    out = rows.mapInArrow(_emit(arguments, fields, keep), T.StructType([*kept, *outputs]))
    if MARK in keep:
        out = out.filter(F.col(MARK) == 1).drop(MARK)
    ended = rows.mapInArrow(_emit_states(arguments), f"{KEY} string, {SLICE} int, state string")
    return out, _last_states(ended)


def fold_kept(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    step: Step,
    init,
    inputs: dict[str, Column],
    outputs: list[T.StructField],
    only: Column,
    stays: Sequence[str] | None = None,
    hashes: Sequence[str] = (),
    group_rows: int | None = None,
    start: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``fold_with_states`` for those who need few of the rows, the ones that meet ``only``, and
    of these the columns that ``stays`` names. Rows are shuffled and folded once for both
    results, with the inputs that are ``hashes`` packed; the results come from the third frame,
    which is kept until it is unpersisted."""
    stays = df.columns if stays is None else stays
    rows, arguments, keep, kept, fields = _prepared(
        df, keys, order, step, init, inputs, outputs, group_rows, start, stays, hashes
    )
    states = [T.StructField(KEY, T.StringType()), T.StructField(SLICE, T.IntegerType()), T.StructField("state", T.StringType())]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in [*kept, *outputs, *states]])
    both = rows.mapInArrow(_emit_both(arguments, fields, keep, to_arrow_schema(schema)), schema)
    row = F.col(KEY).isNull() & (F.col(MARK) == 1 if MARK in keep else F.lit(True))
    held = both.filter((row & only) | F.col(KEY).isNotNull()).persist()
    out = held.filter(F.col(KEY).isNull()).select(*stays, *[f.name for f in outputs])
    return out, _last_states(held.filter(F.col(KEY).isNotNull()).select(KEY, SLICE, "state")), held


def _last_states(ended: DataFrame) -> DataFrame:
    return ended.groupBy(KEY).agg(F.max_by("state", SLICE).alias("state"))


def _prepared(
    df, keys, order, step, init, inputs, outputs, group_rows, start, stays=None, hashes=()
) -> tuple:
    """Rows in the order of the fold, arguments of the walker, names and fields of the columns that
    stay (all of ``df``, or those named), and Arrow fields of the outputs. Inputs that are
    ``hashes`` are shuffled packed."""
    limit = group_rows or GROUP_ROWS
    names = [f"_in_{name}" for name in inputs]
    moved = {f"_in_{n}": packed(c) if n in hashes else c for n, c in inputs.items()}
    stays = df.columns if stays is None else list(stays)
    rows = df.withColumns({KEY: _key_text(keys), **moved}).select(
        *dict.fromkeys([*stays, *order, KEY, *moved])
    )
    marked = start is not None
    sort = [KEY, *order]
    if marked:
        # A stored state is one more row, ahead of the others of its key.
        rows = rows.withColumns({STORED: F.lit(None).cast("string"), MARK: F.lit(1)})
        states = start.select(KEY, F.col("state").alias(STORED), F.lit(0).alias(MARK))
        rows = rows.unionByName(states, allowMissingColumns=True)
        sort = [KEY, MARK, *order]
    unpack = {f"_in_{n}": unpacked(f"_in_{n}") for n in hashes}
    largest, total = group_sizes(df, keys)
    seeds = None
    if largest <= limit:
        rows = rows.repartition(KEY).sortWithinPartitions(*sort)
    else:
        rows = _range_slices(rows, sort, total, limit)
        seeds = _settle_seeds(rows.withColumns(unpack), step, init, names, len(outputs), marked)
    arguments = (step, init, names, len(outputs), seeds, marked)
    rows = rows.withColumns(unpack)
    keep = [*stays, *([MARK] if marked else [])]
    kept = [T.StructField(f.name, f.dataType) for f in rows.select(*keep).schema.fields]
    fields = [pa.field(f.name, _ARROW[f.dataType.simpleString()]) for f in outputs]
    return rows, arguments, keep, kept, fields


def fold(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    step: Step,
    init,
    inputs: dict[str, Column],
    outputs: list[T.StructField],
    group_rows: int | None = None,
) -> DataFrame:
    """Add the outputs of a sequential fold over the rows of each key, in order.

    Pass slim rows: everything in ``df`` travels to Python in Arrow batches. Batches are
    streamed with the state carried along, so memory does not grow with the group.
    """
    return fold_with_states(df, keys, order, step, init, inputs, outputs, group_rows)[0]


_ARROW = {
    "boolean": pa.bool_(),
    "int": pa.int32(),
    "bigint": pa.int64(),
    "double": pa.float64(),
    "string": pa.string(),
}
