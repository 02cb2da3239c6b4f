"""Explicit schemas of the nested stream and the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TEXT, _LONG, _INT, _BYTES = T.StringType(), T.LongType(), T.IntegerType(), T.BinaryType()
_TIME = T.TimestampType()

TRANSACTION = _struct(
    tx_id=_TEXT, payload=_BYTES, signature=_BYTES, public_key=_BYTES, nonce=_LONG, timestamp=_LONG
)
ORDERED_TRANSACTION = _struct(
    transaction=TRANSACTION, sequence_number=_LONG, tx_hash=_TEXT, ingestion_timestamp=_LONG
)
PROOF = _struct(input=_TEXT, output=_TEXT, proof=_TEXT, iterations=_LONG)

# One message of the tick stream. source_id and arrival say where and when it came in.
TICK = _struct(
    source_id=_TEXT,
    arrival=_LONG,
    tick_number=_LONG,
    vdf_proof=PROOF,
    transactions=T.ArrayType(ORDERED_TRANSACTION),
    transaction_batch_hash=_TEXT,
    timestamp=_LONG,
    previous_output=_TEXT,
)

TICKS = _struct(
    tick_number=_LONG,
    timestamp_us=_LONG,
    vdf_input=_TEXT,
    vdf_output=_TEXT,
    vdf_proof=_TEXT,
    vdf_iterations=_LONG,
    transaction_batch_hash=_TEXT,
    previous_output=_TEXT,
    tx_count=_INT,
    processed_at=_TIME,
    version=_INT,
)
TICK_KEYS = ["tick_number"]

TRANSACTIONS = _struct(
    tick_number=_LONG,
    sequence_number=_LONG,
    tx_hash=_TEXT,
    tx_id=_TEXT,
    nonce=_LONG,
    payload=_BYTES,
    timestamp_us=_LONG,
    public_key=_BYTES,
    signature=_BYTES,
    ingestion_timestamp=_LONG,
    processed_at=_TIME,
    payload_size=_INT,
    payload_type=_TEXT,
    version=_INT,
)
TRANSACTION_KEYS = ["tick_number", "sequence_number"]

MARKET_PRICES = _struct(market_id=_TEXT, ts=_TIME, price=T.DecimalType(18, 8))
PRICE_KEYS = ["market_id", "ts"]

# A market snapshot; the timestamp is in seconds.
SNAPSHOT_MARKETS = T.ArrayType(
    _struct(
        uuid=_TEXT,
        kind=_TEXT,
        perp_state=_struct(mark_price=T.DoubleType(), mark_price_timestamp=_LONG),
    )
)

ISSUE = _struct(field=_TEXT, value=_TEXT, rule=_TEXT, message=_TEXT)
