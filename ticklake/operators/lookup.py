"""Reads of the stored tick and transaction tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake import schemas
from ticklake.functions.payload import decode_bytes, decoded_json
from ticklake.functions.session import cut_lineage
from ticklake.operators.ordered import running
from ticklake.operators.parse import lower_hex, null_to_empty, packed, read_defaults, unpacked
from ticklake.operators.slices import cut

# Defaults and limits of the reads.
RECENT_TRANSACTIONS = 50
RECENT_TICKS = 10
SAMPLE_SIZE = 5
MAX_LIMIT = 1000
FULL_HASH = 64
# Transactions of one tick in one document; also the valid maximum of a tick.
DOCUMENT_ROWS = 10_000


def live(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("version") > 0)


def current(
    rows: DataFrame, keys: Sequence[str], newest: Sequence[str] = ("processed_at",)
) -> DataFrame:
    """The newest row of each key. Spark keeps one row per key and task before the
    shuffle, so a key with very many copies is not gathered in one place."""
    return _one_per_key(rows, keys, [F.desc(c) for c in newest])


def first_per_key(
    rows: DataFrame, keys: Sequence[str], oldest: Sequence[str] = ("arrival",)
) -> DataFrame:
    """The oldest row of each key, reduced in the same way."""
    return _one_per_key(rows, keys, [F.asc(c) for c in oldest])


def _one_per_key(rows: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def current_ticks(ticks: DataFrame) -> DataFrame:
    return current(live(ticks), schemas.TICK_KEYS)


def current_transactions(transactions: DataFrame) -> DataFrame:
    return current(live(transactions), schemas.TRANSACTION_KEYS, ("processed_at", "tx_hash"))


def check_limit(limit: int, offset: int = 0) -> None:
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    if offset < 0:
        raise ValueError("offset must not be negative")


def where_equal(rows: DataFrame, **wanted: object) -> DataFrame:
    """Rows equal on every given column; arguments that are None or empty do not filter."""
    for name, value in wanted.items():
        if value is not None and value != "":
            rows = rows.filter(F.col(name) == F.lit(value))
    return rows


def recent_ticks(ticks: DataFrame, limit: int = RECENT_TICKS) -> DataFrame:
    check_limit(limit)
    columns = [c for c in schemas.TICKS.fieldNames() if c in ticks.columns]
    newest = live(ticks).select(*columns).orderBy(F.desc("processed_at"), F.desc("tick_number"))
    return read_defaults(newest.limit(limit))


def recent_transactions(
    transactions: DataFrame, limit: int = RECENT_TRANSACTIONS
) -> DataFrame:
    check_limit(limit)
    order = ["processed_at", "tick_number", "sequence_number", "tx_hash"]
    return (
        live(transactions)
        .orderBy(*[F.desc(c) for c in order])
        .limit(limit)
        .select("sequence_number", "tx_hash", "tick_number", "tx_id", "timestamp_us")
    )


def page(rows: DataFrame, order: Sequence[Column | str], limit: int, offset: int = 0) -> DataFrame:
    """One page by position; ``order`` must be total."""
    check_limit(limit, offset)
    return rows.orderBy(*order).offset(offset).limit(limit)


def page_after(
    rows: DataFrame, keys: Sequence[str], last: Sequence[object] | None, limit: int
) -> DataFrame:
    """The page following key ``last`` in ascending key order. Unlike an offset, this
    does not read and drop the earlier pages: the key filter reaches the scan."""
    check_limit(limit)
    if last is not None:
        beyond = F.lit(False)
        for i, key in enumerate(keys):
            step = F.col(key) > F.lit(last[i])
            for earlier, value in zip(keys[:i], last[:i]):
                step = (F.col(earlier) == F.lit(value)) & step
            beyond = beyond | step
        rows = rows.filter((F.col(keys[0]) >= F.lit(last[0])) & beyond)
    return rows.orderBy(*keys).limit(limit)


def _shown(field: Callable[[str], Column]) -> list[Column]:
    """Columns of a transaction as readers see it, without the number of its tick."""
    texts = {
        "payload": lower_hex(field("payload")),
        "payload_decoded": decoded_json(decode_bytes(field("payload"))),
        "public_key": lower_hex(field("public_key")),
        "signature": lower_hex(field("signature")),
        "payload_type": null_to_empty(field("payload_type")),
    }
    return [(texts[c] if c in texts else field(c)).alias(c) for c in _SHOWN]


_SHOWN = [
    "sequence_number", "tx_hash", "tx_id", "nonce", "payload", "payload_decoded", "timestamp_us",
    "public_key", "signature", "ingestion_timestamp", "processed_at", "payload_size",
    "payload_type", "version",
]


def shown_transactions(transactions: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Transactions as readers see them: bytes in hexadecimal, the payload also decoded."""
    return transactions.select(*keep, "tick_number", *_shown(F.col))


def _only(rows: DataFrame, numbers: Sequence[int] | None) -> DataFrame:
    return rows if numbers is None else rows.filter(F.col("tick_number").isin(list(numbers)))


_TICK_HASHES = ["vdf_input", "vdf_output", "transaction_batch_hash", "previous_output"]


def _read_ticks(joined: DataFrame) -> DataFrame:
    """Ticks of ``_dealt`` as readers see them."""
    return read_defaults(joined.withColumns({c: unpacked(c) for c in _TICK_HASHES}))


# Stands for the place of a transaction without sequence number, so that plain equality joins it.
_NO_PLACE = -(2**63)


def _dealt(
    ticks: DataFrame, transactions: DataFrame, numbers: Sequence[int] | None, rows_each: int | None
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Current ticks as stored, with hashes ``packed``, one row per cell, current transactions,
    and the columns of a cell.

    A cell is a tick, or ``rows_each`` sequence numbers of one, so that a tick with most of
    the transactions is many cells. Transactions are dealt by cell once, with their payloads
    as stored; picking the current ones, nesting and the join with the ticks all follow in
    the same tasks. Ticks without transactions have one row, with a null ``_cell``.
    """
    # Texts in hexadecimal travel as the bytes they stand for.
    packed_ticks = _only(ticks, numbers).withColumns({c: packed(c) for c in _TICK_HASHES})
    head = current_ticks(packed_ticks)
    rows = live(_only(transactions, numbers))
    cell = ["tick_number"]
    if rows_each is not None:
        cell = ["tick_number", "_cell"]
        place = F.floor(F.col("sequence_number") / F.lit(rows_each))
        rows = rows.withColumn("_cell", F.coalesce(place, F.lit(_NO_PLACE)))
        head = head.join(rows.select(*cell).distinct(), "tick_number", "left")
    texts = ["tx_hash", "public_key", "signature"]
    kinds = dict(rows.dtypes)
    dealt = (
        rows.withColumns({c: packed(c) for c in texts})
        .repartition(*cell)
        .withColumns({c: unpacked(c).cast(kinds[c]) for c in texts})
    )
    return head, current(dealt, [*cell, "sequence_number"], ("processed_at", "tx_hash")), cell


def tick_transactions(
    ticks: DataFrame, transactions: DataFrame, numbers: Sequence[int] | None = None
) -> DataFrame:
    """Each current tick with each of its current transactions, one row per pair; a tick
    without any has one row with null transaction columns."""
    head, rows, cell = _dealt(ticks, transactions, numbers, DOCUMENT_ROWS)
    renamed = shown_transactions(rows, tuple(cell[1:])).select(
        *cell,
        *[
            F.col(c).alias(f"tx_{c}" if c in head.columns else c)
            for c in schemas.TRANSACTIONS.fieldNames() + ["payload_decoded"]
            if c != "tick_number"
        ],
    )
    return _read_ticks(head.join(renamed, cell, "left")).select(
        *[c for c in head.columns if c not in cell[1:]],
        *[c for c in renamed.columns if c not in cell],
    )


def tick_documents(
    ticks: DataFrame,
    transactions: DataFrame,
    numbers: Sequence[int] | None = None,
    document_rows: int | None = DOCUMENT_ROWS,
) -> DataFrame:
    """Current ticks with their current transactions nested in sequence order.

    A tick of more than ``document_rows`` transactions spans several documents, numbered
    by ``part``, so no array grows without bound; with ``None`` each tick is one document.
    A tick without any has an empty list.
    """
    part = F.lit(0).cast("bigint")
    cell_rows = None
    if document_rows is not None:
        part = F.floor(F.col("sequence_number") / F.lit(document_rows))
        cell_rows = document_rows * max(1, DOCUMENT_ROWS // document_rows)  # whole documents
    head, rows, cell = _dealt(ticks, transactions, numbers, cell_rows)
    # Nested as stored: the texts that readers see are several times as large.
    stored = [c for c in _SHOWN if c != "payload_decoded"]
    nested = rows.groupBy(*cell, part.alias("part")).agg(
        F.array_sort(F.collect_list(F.struct(*stored))).alias("_stored")
    )
    none = F.col("_stored").isNull()
    shown = F.transform("_stored", lambda row: F.struct(*_shown(row.getField)))
    return _read_ticks(head.join(nested, cell, "left")).select(
        *[c for c in head.columns if c not in cell[1:]],
        F.when(none, F.lit(0).cast("bigint")).otherwise(F.col("part")).alias("part"),
        F.coalesce(shown, F.array()).alias("transactions"),
    )


def find_transaction(transactions: DataFrame, tx_hash: str) -> DataFrame:
    """The newest live transaction with this hash, or with this prefix when it is shorter
    than a full hash. The text is taken literally."""
    wanted = F.col("tx_hash") == tx_hash
    if len(tx_hash) < FULL_HASH:
        wanted = F.col("tx_hash").startswith(tx_hash)
    newest = live(transactions).filter(wanted).orderBy(*_newest()).limit(1)
    return shown_transactions(newest)


def _newest() -> list[Column]:
    return [F.desc(c) for c in ("processed_at", "tick_number", "sequence_number", "tx_hash")]


def find_transactions(
    transactions: DataFrame, wanted: DataFrame, slices: int | None = None
) -> DataFrame:
    """``find_transaction`` for a table of hashes and prefixes (column ``wanted``).

    Rows meet the hashes in one shuffle by hash, which travels as its bytes, and the newest is
    taken there. What a prefix finds is the newest row of its hash too, so for prefixes only
    that hash is looked for (``_newest_per_prefix``), among slim rows; no row is repeated by
    length of prefix.
    """
    rows = live(transactions)
    texts = wanted.select("wanted").filter("wanted IS NOT NULL")
    whole = texts.filter(F.length("wanted") >= FULL_HASH).select(packed("wanted").alias("tx_hash"))
    # Read several times; what they are made from may be as large as the transactions.
    prefixes = cut_lineage(texts.filter(F.length("wanted") < FULL_HASH).distinct())
    longest = prefixes.agg(F.max(F.length("wanted"))).first()[0]
    met = rows.withColumn("tx_hash", packed("tx_hash")).join(
        whole.distinct().withColumn("_whole", F.lit(True)), "tx_hash", "left"
    )
    asked, is_met = F.array().cast("array<string>"), F.col("_whole")
    if longest is not None:
        best = _newest_per_prefix(rows, prefixes, longest, slices)
        by_prefix = best.groupBy(packed("best.tx_hash").alias("tx_hash")).agg(
            F.collect_list("wanted").alias("_asked")
        )
        met = met.join(by_prefix, "tx_hash", "left")
        asked, is_met = F.coalesce("_asked", asked), is_met | F.col("_asked").isNotNull()
    newest = current(met.filter(is_met), ["tx_hash"], _RANK[:-1])
    found = newest.withColumn("tx_hash", unpacked("tx_hash")).withColumn(
        "wanted", F.explode(F.array_compact(F.array_append(asked, F.when(F.col("_whole"), F.col("tx_hash")))))
    )
    return shown_transactions(found, keep=("wanted",))


_RANK = ["processed_at", "tick_number", "sequence_number", "tx_hash"]


def _rank() -> Column:
    return F.struct(*_RANK)


def _newest_per_prefix(
    rows: DataFrame, prefixes: DataFrame, longest: int, slices: int | None
) -> DataFrame:
    """The newest rank (column ``best``) per prefix that a live row has.

    Hashes count by as many characters as the longest prefix has: tasks keep the newest of each
    such beginning, so that short prefixes leave few rows to sort.

    Of the prefixes that sort up to a hash the last one, or prefixes of it, are all that the
    hash can have. So prefixes with the list of those that they begin with and hashes are
    sorted together, the last list is carried on to the hashes, and a hash counts for the
    longest that fits; what a prefix finds then counts for those around it too.
    """
    inner = prefixes.select("wanted", F.explode(F.sequence(F.lit(0), F.length("wanted"))).alias("size"))
    nests = (
        inner.select(F.col("wanted").alias("text"), F.expr("left(wanted, size)").alias("wanted"))
        .join(prefixes, "wanted", "left_semi")
        .groupBy("text")
        .agg(F.array_sort(F.collect_list("wanted")).alias("nest"))
    )
    begun = F.left("tx_hash", F.lit(longest)).alias("text")
    hashes = rows.filter("tx_hash IS NOT NULL").groupBy(begun).agg(F.max(_rank()).alias("best"))
    mixed = nests.unionByName(hashes, allowMissingColumns=True).withColumn("all", F.lit(0))
    order = ["text", "best"]  # a prefix, which has no rank, comes before equal hashes
    cells = cut(mixed, ["all"], order, slices)
    met = running(cells, ["all"], order, {"open": ("last", F.col("nest"))}, sliced=True)
    fits = F.filter("open", lambda p: F.col("text").startswith(p))
    deepest = (
        met.filter("best IS NOT NULL")
        .select(F.get(fits, F.size(fits) - 1).alias("text"), "best")
        .filter("text IS NOT NULL")
        .groupBy("text")
        .agg(F.max("best").alias("best"))
    )
    return (
        deepest.join(nests, "text")
        .select(F.explode("nest").alias("wanted"), "best")
        .groupBy("wanted")
        .agg(F.max("best").alias("best"))
    )


def last_tick(ticks: DataFrame) -> DataFrame:
    """The highest live tick number stored, 0 when there is none."""
    return live(ticks).agg(F.coalesce(F.max("tick_number"), F.lit(0)).alias("last_tick"))


def chain_totals(ticks: DataFrame, transactions: DataFrame) -> DataFrame:
    """Chain height and number of live transactions, in one row."""
    height = live(ticks).agg(F.max("tick_number").alias("chain_height"))
    total = live(transactions).agg(F.count(F.lit(1)).alias("total_transactions"))
    return height.unionByName(total, allowMissingColumns=True).agg(
        F.coalesce(F.max("chain_height"), F.lit(0)).alias("chain_height"),
        F.coalesce(F.max("total_transactions"), F.lit(0)).alias("total_transactions"),
    )


def hash_sample(transactions: DataFrame, size: int = SAMPLE_SIZE) -> DataFrame:
    """Hash and tick number, as text, of the newest live transactions. A repeated hash
    keeps one entry: the oldest of the sample, which is written last."""
    newest = live(transactions).orderBy(*_newest()).limit(size)
    order = ["processed_at", "tick_number", "sequence_number"]
    kept = newest.groupBy("tx_hash").agg(F.min_by("tick_number", F.struct(*order)).alias("n"))
    return kept.select("tx_hash", F.col("n").cast("string").alias("tick_number"))


def chain_state(
    ticks: DataFrame, transactions: DataFrame, tick_limit: int = RECENT_TICKS
) -> DataFrame:
    """Height, total, recent ticks and the hash sample as one document."""
    recent = recent_ticks(ticks, tick_limit)
    newest_first = F.struct(
        (-F.unix_micros(F.col("processed_at").cast("timestamp"))).alias("a"),
        (-F.col("tick_number")).alias("b"),
        F.struct(*recent.columns).alias("tick"),
    )
    nested = recent.agg(F.array_sort(F.collect_list(newest_first))["tick"].alias("recent_ticks"))
    sample = hash_sample(transactions).agg(
        F.map_from_entries(F.collect_list(F.struct("tx_hash", "tick_number"))).alias(
            "tx_to_tick_sample"
        )
    )
    parts = chain_totals(ticks, transactions)
    for part in (nested, sample):
        parts = parts.unionByName(part, allowMissingColumns=True)
    return parts.agg(
        F.max("chain_height").cast("string").alias("chain_height"),
        F.max("total_transactions").cast("string").alias("total_transactions"),
        F.first("recent_ticks", ignorenulls=True).alias("recent_ticks"),
        F.first("tx_to_tick_sample", ignorenulls=True).alias("tx_to_tick_sample"),
    )
