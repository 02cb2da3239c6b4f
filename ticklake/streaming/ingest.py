"""From a stream of nested ticks to the stored tables.

Tables below one root: ``ticks``, ``transactions``, ``quarantine``, ``invalidations``,
and ``state`` and ``clock``, which hold per batch what the next batch goes on from. Every
folder of a batch is named by its number and replaced as a whole, so a batch that runs
again after a failure leaves the same tables.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ticklake import schemas
from ticklake.operators import parse, quality, reorg
from ticklake.operators.ordered import KEY, fold_kept
from ticklake.sinks import folders
from ticklake.sinks.tables import read_rows, replace_partitions, show_rows, write_rows

# Size and time limits of a batch; a direct stream takes rows as they come.
BATCH_MILLISECONDS = 200
KEPT_STATES = 3

# The number of a row's tick where null has a value too, so that plain equality joins it.
PLACE = "_place"
_NO_TICK = -(2**63)

Clock = Callable[[], datetime]
Accept = Callable[[DataFrame], DataFrame]


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _utc(at: datetime) -> Column:
    return F.lit(f"{at.isoformat()}Z").cast("timestamp")


def batch_time(spark: SparkSession, root: str, batch_id: int, clock: Clock = utc_now) -> datetime:
    """The time a batch was first processed; the same when it is processed again. Times of
    batches that cannot come again are dropped."""
    path = f"{root}/clock/batch_id={batch_id}"
    if not folders.exists(spark, f"{path}/_SUCCESS"):
        row = spark.createDataFrame([(clock().isoformat(),)], "at string")
        row.coalesce(1).write.mode("overwrite").parquet(path)
        _prune(spark, f"{root}/clock", batch_id)
    return datetime.fromisoformat(spark.read.schema("at string").parquet(path).first()["at"])


def _write_batch(rows: DataFrame, path: str, batch_id: int, wide: bool = False) -> None:
    numbered = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    replace_partitions(numbered, path, ["batch_id"], one_partition=wide)


def _load_state(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """States after the newest batch before this one."""
    schema = f"{KEY} string, state string"
    numbers = [int(v["batch_id"]) for v, _ in folders.partitions(spark, path, ["batch_id"])]
    earlier = [n for n in numbers if n < batch_id]
    if not earlier:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/batch_id={max(earlier)}")


def _save_state(states: DataFrame, path: str, batch_id: int) -> None:
    states.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    _prune(states.sparkSession, path, batch_id)


def _prune(spark: SparkSession, path: str, batch_id: int) -> None:
    """Drop what batches long before this one left; only the newest batch can come again."""
    for values, folder in folders.partitions(spark, path, ["batch_id"]):
        if int(values["batch_id"]) <= batch_id - KEPT_STATES:
            folders.delete(spark, folder)


def check_batch(
    ticks: DataFrame, root: str, batch_id: int, now: datetime, strict: bool = False
) -> tuple[DataFrame, Accept, DataFrame, DataFrame, list[DataFrame]]:
    """Ticks without a critical issue of their own, the rows of ticks that are accepted among
    such, quarantined ticks with issues, reorganisation events, and the frames to unpersist
    once these are written.

    In arrival order: a tick with a critical issue of its own is quarantined; of the
    others, one that conflicts with a remembered tick is a replacement and is accepted;
    the rest must keep the sequence of their source. Of several versions of a tick in
    the batch only the last replacement goes on. Warnings do not stop a tick.

    Only slim rows pass the folds, once each, and few are kept of what they give. Whole
    ticks are read again wherever they are needed; issues are written out for those in quarantine.
    """
    spark = ticks.sparkSession
    sound = ticks.filter(~quality.lacks_parts())
    seen, windows, reorgs = fold_kept(
        reorg.comparable(sound), ["source_id"], ["arrival"],
        reorg.window_step(reorg.WINDOW_SIZE), {},
        {name: F.col(name) for name in reorg.WINDOW_INPUTS}, reorg.WINDOW_OUTPUTS,
        F.col("conflict_reason").isNotNull(),
        ["source_id", "arrival", "tick_number"], ["output", "batch_hash", "previous_output"],
        start=_load_state(spark, f"{root}/state/reorg", batch_id),
    )
    events = seen.select("source_id", "arrival", "tick_number", "old_arrival", "conflict_reason")
    slim = quality.slim_ticks(sound, now, strict).join(
        events.select("source_id", "arrival"), ["source_id", "arrival"], "left_anti"
    )
    columns = [F.col(c) for c in ("tick_number", "timestamp", "last_number", "last_time")]
    more = F.concat(
        quality.sequence_issues(*columns),
        quality.time_sequence_issues(F.col("timestamp"), F.col("last_time")),
    )
    state, sequences, jumps = fold_kept(
        slim, ["source_id"], ["arrival"], quality.sequence_step, [0, 0],
        {"number": F.col("tick_number"), "time": F.col("timestamp"), "good": F.col("good")},
        quality.STATE_FIELDS, F.array_size(more) > 0,
        start=_load_state(spark, f"{root}/state/sequence", batch_id),
    )
    broken = state.select("source_id", "arrival", more.alias("more"))
    _save_state(windows, f"{root}/state/reorg", batch_id)
    _save_state(sequences, f"{root}/state/sequence", batch_id)

    key = ["source_id", "arrival"]
    stopped = broken.filter(quality.is_critical("more"))
    moved = _each_hash(ticks, parse.packed)
    lacking = moved.filter(quality.lacks_parts()).join(broken, key, "left")
    held_back = lacking.unionByName(moved.filter(~quality.lacks_parts()).join(stopped, key))
    quarantined = quality.tick_issues(_each_hash(held_back, parse.unpacked), now, strict).withColumn(
        "issues", F.when(F.col("more").isNull(), F.col("issues")).otherwise(F.concat("more", "issues"))
    ).drop("more")
    return sound, _accept(sound, broken, events), quarantined, events, [reorgs, jumps]


def _accept(sound: DataFrame, broken: DataFrame, events: DataFrame) -> Accept:
    """Picks the rows of accepted ticks from rows that have ``PLACE``, source and arrival.

    The rows cross one shuffle, by ``PLACE``, together with slim marks of the ticks that the
    sequence stops and of those that a later replacement in the batch makes stale. A mark sorts
    ahead of the rows that it is about.
    """
    key = ["source_id", "arrival"]
    stops = broken.groupBy(*key).agg(F.bool_and(quality.is_critical("more")).alias("_stopped")).filter("_stopped")
    stopped = _placed(sound).select(PLACE, *key).join(stops, key).distinct()
    replaced = (
        _placed(events.filter("tick_number IS NOT NULL AND source_id IS NOT NULL"))
        .groupBy(PLACE, "source_id").agg(F.max("arrival").alias("_from"))
    )
    marks = stopped.unionByName(replaced, allowMissingColumns=True)
    first = F.col("_row").asc_nulls_first()
    same = Window.partitionBy(PLACE, *key).orderBy(first)
    tick = Window.partitionBy(PLACE, "source_id").orderBy(F.col("arrival").asc_nulls_first(), first)

    def accept(rows: DataFrame) -> DataFrame:
        return (
            rows.withColumn("_row", F.lit(True)).unionByName(marks, allowMissingColumns=True)
            .repartition(PLACE)
            .withColumn("_stopped", F.max("_stopped").over(same.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("_from", F.max("_from").over(tick.rowsBetween(Window.unboundedPreceding, 0)))
            .filter("_row AND _stopped IS NULL AND (_from IS NULL OR arrival >= _from)")
            .drop("_row", "_stopped", "_from")
        )

    return accept


def _each_hash(ticks: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    """Nested ticks with every hash changed, as for a shuffle."""
    proof = F.col("vdf_proof")
    for name in ("input", "output"):
        proof = proof.withField(name, change(F.col("vdf_proof")[name]))
    return ticks.withColumns(
        {
            "vdf_proof": proof,
            "transactions": F.transform("transactions", lambda e: e.withField("tx_hash", change(e["tx_hash"]))),
            **{name: change(F.col(name)) for name in ("transaction_batch_hash", "previous_output")},
        }
    )


def _placed(rows: DataFrame) -> DataFrame:
    """Rows with the number of their tick as ``PLACE``, which is not null."""
    return rows.withColumn(PLACE, F.coalesce("tick_number", F.lit(_NO_TICK)))


def store_batch(
    ticks: DataFrame, root: str, batch_id: int, at: datetime, classify: bool = True,
    accept: Accept | None = None,
) -> None:
    """Write tick and transaction rows of a batch, of accepted ticks if not all are. When one
    tick occurs twice, the later arrival wins. A batch has one time, so the rows are not dealt
    anew by hour."""
    stamp = _utc(at)
    order = ("processed_at", "arrival")
    tick_keys, transaction_keys, dealt = schemas.TICK_KEYS, schemas.TRANSACTION_KEYS, accept is not None
    # The arrival decides within the batch only; it is not a stored column.
    keep: tuple[str, ...] = ("arrival",)
    if dealt:
        keep = ("source_id", "arrival", PLACE)
        tick_keys, transaction_keys = [PLACE], [PLACE, "sequence_number"]
        ticks = _placed(ticks)
    hashes = ["vdf_input", "vdf_output", "transaction_batch_hash", "previous_output"]
    tick_rows = _dealt(
        parse.flatten_ticks(ticks.filter(parse.has_transactions()), keep=keep), hashes, accept
    )
    tick_rows = tick_rows.withColumns(
        {
            **{n: parse.empty_to_null(n) for n in [*hashes, "vdf_proof"]},
            "processed_at": stamp, "version": F.lit(1),
        }
    )
    write_rows(
        tick_rows, f"{root}/ticks", tick_keys, batch_id, order,
        schemas.TICKS.fieldNames(), one_time=True, dealt=dealt,
    )
    kind = parse.payload_class("payload") if classify else F.lit("")
    rows = _dealt(parse.explode_transactions(ticks, keep=keep), ["tx_hash"], accept).withColumns(
        {"processed_at": stamp, "payload_type": kind, "version": F.lit(1)}
    )
    write_rows(
        rows, f"{root}/transactions", transaction_keys, batch_id, (*order, "tx_hash"),
        schemas.TRANSACTIONS.fieldNames(), one_time=True, dealt=dealt,
    )


def _dealt(rows: DataFrame, hashes: list[str], accept: Accept | None) -> DataFrame:
    """The accepted rows; hashes travel packed."""
    if accept is None:
        return rows
    found = accept(rows.withColumns({name: parse.packed(name) for name in hashes}))
    return found.withColumns({name: parse.unpacked(name) for name in hashes})


def ingest_batch(
    ticks: DataFrame,
    root: str,
    batch_id: int,
    validate: bool = False,
    strict: bool = False,
    clock: Clock = utc_now,
    write: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Check (optionally) and store one batch of nested ticks."""
    spark = ticks.sparkSession
    at = batch_time(spark, root, batch_id, clock)
    # The batch is read again for each write: kept for all of them, it would fill memory and disk.
    accept, held = None, []
    try:
        if validate:
            ticks, accept, quarantined, events, held = check_batch(ticks, root, batch_id, at, strict)
            _write_batch(quarantined, f"{root}/quarantine", batch_id, wide=True)
            found = events.withColumn("at", _utc(at))
            _write_batch(found, f"{root}/invalidations", batch_id)
        if write is None:
            store_batch(ticks, root, batch_id, at, accept=accept)
        else:
            write(ticks if accept is None else accept(_placed(ticks)).select(*ticks.columns), batch_id)
    finally:
        for frame in held:
            frame.unpersist()


def ingest(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    validate: bool = False,
    strict: bool = False,
    clock: Clock = utc_now,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    write: Callable[[DataFrame, int], None] | None = None,
    dry_run: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the stream from nested ticks to tables.

    ``transform`` is any DataFrame to DataFrame function applied to the ticks first and
    ``write`` any (DataFrame, batch id) function in place of the table writer.
    ``dry_run`` prints the rows instead of storing them. ``trigger`` are the options of
    Spark's trigger: a processing time flushes by time, the source's rate options by
    size, and ``availableNow`` runs until the input is used up.
    """
    ticks = stream if transform is None else stream.transform(transform)

    def run(batch: DataFrame, batch_id: int) -> None:
        if dry_run:
            show_rows(parse.flatten_ticks(batch))
            show_rows(parse.explode_transactions(batch))
        else:
            ingest_batch(batch, root, batch_id, validate, strict, clock, write)

    options = trigger or {"processingTime": f"{BATCH_MILLISECONDS} milliseconds"}
    return (
        ticks.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**options)
        .start()
    )


def stored_ticks(spark: SparkSession, root: str, since=None, until=None) -> DataFrame:
    """Stored tick rows with invalidated versions marked."""
    return _marked(spark, root, "ticks", schemas.TICKS, since, until)


def stored_transactions(spark: SparkSession, root: str, since=None, until=None) -> DataFrame:
    return _marked(spark, root, "transactions", schemas.TRANSACTIONS, since, until)


def _marked(spark, root, table, schema, since, until) -> DataFrame:
    rows = read_rows(spark, f"{root}/{table}", schema, since, until)
    path = f"{root}/invalidations"
    if not folders.exists(spark, path):
        return rows
    events = spark.read.schema("tick_number bigint, at timestamp").parquet(path)
    return reorg.apply_invalidations(rows, events)
