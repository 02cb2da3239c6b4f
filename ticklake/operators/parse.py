"""From nested ticks to tick and transaction rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake import schemas

# Labels of the block-style projection.
CHAIN_ID = "mainnet"
NETWORK = "qubic"


def lower_hex(data: Column | str) -> Column:
    return F.lower(F.hex(data))


def packed(text: Column | str) -> Column:
    """A text, or the bytes of one, in fewer bytes for a shuffle: lower-case hexadecimal as what
    it stands for. The first byte tells which, so different texts stay different."""
    text = F.col(text) if isinstance(text, str) else text
    stands = text.cast("string").rlike(r"\A([0-9a-f]{2})+\z")
    return F.when(stands, F.concat(F.lit(b"\x01"), F.unhex(text.cast("string")))).otherwise(
        F.concat(F.lit(b"\x00"), text.cast("binary"))
    )


def unpacked(data: Column | str) -> Column:
    """The bytes or text that ``packed`` was given, as text."""
    data = F.col(data) if isinstance(data, str) else data
    rest = F.substring(data, 2, 2**31 - 1)
    return F.when(F.substring(data, 1, 1) == F.lit(b"\x01"), lower_hex(rest)).otherwise(rest.cast("string"))


def payload_size(payload: Column | str) -> Column:
    return F.coalesce(F.octet_length(payload), F.lit(0)).cast("int")


def payload_class(payload: Column | str) -> Column:
    """The size classes and their limits in bytes."""
    size = payload_size(payload)
    return (
        F.when(size == 0, "empty")
        .when(size < 32, "small")
        .when(size < 256, "medium")
        .when(size < 1024, "large")
        .otherwise("xlarge")
    )


def micros_to_time(micros: Column | str) -> Column:
    return F.timestamp_micros(micros)


def empty_to_null(text: Column | str) -> Column:
    return F.nullif(F.col(text) if isinstance(text, str) else text, F.lit(""))


def null_to_empty(text: Column | str) -> Column:
    return F.coalesce(text, F.lit(""))


def transaction_hash(
    given: Column, tx_id: Column, nonce: Column, timestamp: Column, payload: Column
) -> Column:
    """The given hash, or the digest of id, nonce, time and payload when there is none."""
    text = F.concat_ws(
        "_",
        null_to_empty(tx_id),
        F.coalesce(nonce, F.lit(0)).cast("string"),
        F.coalesce(timestamp, F.lit(0)).cast("string"),
        null_to_empty(lower_hex(payload)),
    )
    return F.when(null_to_empty(given) != "", given).otherwise(F.sha2(text, 256))


def flatten_ticks(ticks: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per tick. An absent proof gives empty fields; ``tx_count`` counts every
    entry, also those that carry no transaction."""
    return ticks.select(
        *keep,
        "tick_number",
        F.col("timestamp").alias("timestamp_us"),
        null_to_empty("vdf_proof.input").alias("vdf_input"),
        null_to_empty("vdf_proof.output").alias("vdf_output"),
        null_to_empty("vdf_proof.proof").alias("vdf_proof"),
        F.coalesce("vdf_proof.iterations", F.lit(0)).alias("vdf_iterations"),
        null_to_empty("transaction_batch_hash").alias("transaction_batch_hash"),
        null_to_empty("previous_output").alias("previous_output"),
        F.coalesce(F.array_size("transactions"), F.lit(0)).alias("tx_count"),
    )


def explode_transactions(ticks: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per ordered transaction, without entries that carry none."""
    entry, body = F.col("entry"), F.col("entry.transaction")
    return (
        ticks.select(*keep, "tick_number", F.explode("transactions").alias("entry"))
        .filter(body.isNotNull())
        .select(
            *keep,
            "tick_number",
            entry["sequence_number"].alias("sequence_number"),
            transaction_hash(
                entry["tx_hash"], body["tx_id"], body["nonce"], body["timestamp"], body["payload"]
            ).alias("tx_hash"),
            body["tx_id"].alias("tx_id"),
            body["nonce"].alias("nonce"),
            body["payload"].alias("payload"),
            body["timestamp"].alias("timestamp_us"),
            body["public_key"].alias("public_key"),
            body["signature"].alias("signature"),
            entry["ingestion_timestamp"].alias("ingestion_timestamp"),
            payload_size(body["payload"]).alias("payload_size"),
        )
    )


def has_transactions(transactions: Column | str = "transactions") -> Column:
    """Whether any entry carries a transaction; ticks without one are not stored."""
    return F.coalesce(
        F.exists(transactions, lambda entry: entry["transaction"].isNotNull()), F.lit(False)
    )


def tick_rows(ticks: DataFrame, processed_at: Column) -> DataFrame:
    """Rows of the ticks table: empty ticks dropped, empty strings stored as null."""
    flat = flatten_ticks(ticks.filter(has_transactions()))
    texts = ["vdf_input", "vdf_output", "vdf_proof", "transaction_batch_hash", "previous_output"]
    return flat.withColumns(
        {
            **{name: empty_to_null(name) for name in texts},
            "processed_at": processed_at,
            "version": F.lit(1),
        }
    ).select(*schemas.TICKS.fieldNames())


def transaction_rows(
    ticks: DataFrame, processed_at: Column, classify: bool = True
) -> DataFrame:
    """Rows of the transactions table; ``classify=False`` leaves the payload type empty."""
    kind = payload_class("payload") if classify else F.lit("")
    return (
        explode_transactions(ticks)
        .withColumns({"processed_at": processed_at, "payload_type": kind, "version": F.lit(1)})
        .select(*schemas.TRANSACTIONS.fieldNames())
    )


def block_rows(ticks: DataFrame) -> DataFrame:
    """Ticks under block names: height is the tick number, sizes are not computed."""
    return ticks.select(
        "tick_number",
        F.col("tick_number").alias("height"),
        F.col("transaction_batch_hash").alias("block_hash"),
        F.col("previous_output").alias("parent_hash"),
        F.coalesce(F.array_size("transactions"), F.lit(0)).alias("tx_count"),
        F.lit(0).cast("bigint").alias("payload_size_bytes"),
        F.lit(0).cast("bigint").alias("size_bytes"),
        F.col("timestamp"),
        F.lit("").alias("proposer_id"),
        F.lit("").alias("proposer_key"),
        F.lit(CHAIN_ID).alias("chain_id"),
        F.lit(NETWORK).alias("network"),
        F.lit(1).alias("version"),
    )


def read_defaults(ticks: DataFrame) -> DataFrame:
    """Stored ticks as readers see them: null texts become empty, null counts zero."""
    texts = ["vdf_input", "vdf_output", "vdf_proof", "transaction_batch_hash", "previous_output"]
    return ticks.withColumns(
        {
            **{name: null_to_empty(name) for name in texts},
            "vdf_iterations": F.coalesce("vdf_iterations", F.lit(0)),
        }
    )


def type_submissions(submissions: DataFrame) -> DataFrame:
    """Submitted texts as transaction columns, with ``reason`` set on bad rows.

    The signature is hexadecimal, the key is kept as the bytes of its text and the
    timestamp is a decimal string. A required field that is missing, empty or zero is a
    reason as well.
    """
    missing = F.lit(False)
    for name in ["tx_id", "signature", "public_key", "timestamp"]:
        missing = missing | (null_to_empty(name) == "")
    missing = missing | F.col("payload").isNull() | (F.coalesce("nonce", F.lit(0)) == 0)
    hexadecimal = F.col("signature").rlike(r"\A([0-9a-fA-F]{2})*\z")
    number = F.when(
        F.col("timestamp").rlike(r"\A[0-9]+\z"), F.col("timestamp").try_cast("bigint")
    )
    reason = (
        F.when(missing, "missing required field")
        .when(~hexadecimal, "invalid signature hex")
        .when(number.isNull(), "invalid timestamp")
    )
    return submissions.select(
        "idx",
        "tx_id",
        "payload",
        F.when(hexadecimal, F.unhex("signature")).alias("signature"),
        F.encode("public_key", "UTF-8").alias("public_key"),
        "nonce",
        number.alias("timestamp"),
        reason.alias("reason"),
    )


def split_submissions(submissions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted transactions, and rejected rows as (idx, reason)."""
    typed = type_submissions(submissions)
    good = typed.filter(F.col("reason").isNull()).drop("reason")
    return good, typed.filter(F.col("reason").isNotNull()).select("idx", "reason")
