"""Stored tables kept in shape: incremental rollups, dirty buckets, compaction, retention."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ticklake import schemas
from ticklake.functions.session import scratch_path
from ticklake.operators import rollups
from ticklake.plans import adapters as a
from ticklake.plans import chain_plans
from ticklake.sinks import dirty, signers, tables, upkeep

DAY = datetime(2024, 1, 1)


def _from_changes(rollup):
    """A rollup of live transactions, from the changes of three batches: the second also
    comes twice, the third takes back what was invalidated in all of them."""

    def query(spark, sf_dir):
        path = scratch_path(spark, rollup.name)
        rows = a.transactions_squeezed(spark, sf_dir)
        for batch_id in (0, 1, 1, 2):
            signers.store_changes(
                rollup, path, batch_id,
                added=rows.filter(F.col("sequence_number") % 3 == batch_id),
                removed=rows.filter("version = -1") if batch_id == 2 else None,
            )
        return signers.read_counts(spark, path, rollup)

    return query


def _dirty_runs(spark, sf_dir):
    """An hourly rollup of which only the dirty hours before noon were computed, in three
    runs: one scheduled, two by range. Returns its folder and its log."""
    path, log = scratch_path(spark, "transactions_hourly"), scratch_path(spark, "dirty")
    rows, rollup = a.transactions_squeezed(spark, sf_dir), rollups.TRANSACTIONS_HOURLY
    dirty.mark(rows, rollup, log, 1)
    dirty.run_due(rows, rollup, path, log, DAY + timedelta(hours=12))
    dirty.mark(rows.filter("sequence_number = 5"), rollup, log, 2)
    for until in (6, 12):
        dirty.run_between(rows, rollup, path, log, DAY, DAY + timedelta(hours=until))
    return path, log


def _refreshed_dirty(spark, sf_dir):
    return upkeep.read_rollup(spark, _dirty_runs(spark, sf_dir)[0])


def _dirty_left(spark, sf_dir):
    found = dirty.dirty(spark, rollups.TRANSACTIONS_HOURLY, _dirty_runs(spark, sf_dir)[1])
    return found.select("bucket")


def _stored(spark, sf_dir):
    """Hourly prices in three batches, of which the later ones repeat times of the first."""
    path = scratch_path(spark, "prices")
    rows = a.observed_prices(spark, sf_dir).select(
        "market_id", F.date_trunc("hour", "poll_time").cast("timestamp_ntz").alias("ts"), "price", "arrival"
    )
    for batch_id, parts in enumerate([(0, 1), (1, 2), (0, 2)]):
        tables.write_prices(rows.filter((F.col("arrival") % 3).isin(*parts)), path, batch_id)
    return path


def _prices(spark, path):
    stored = tables.read_prices(spark, path, "timestamp_ntz")
    return stored.select("market_id", "ts", F.col("price").cast("double").alias("price"))


def _compacted_prices(spark, sf_dir):
    path = _stored(spark, sf_dir)
    kinds = "market_id string, ts timestamp_ntz, price decimal(18,8)"
    upkeep.compact(
        spark, path, kinds, DAY + timedelta(days=24), upkeep.COMPACT_AFTER["market_prices"], ["market_id", "ts"],
        hourly=False,
    )
    return _prices(spark, path)


def _retained_prices(spark, sf_dir):
    path = _stored(spark, sf_dir)
    upkeep.drop_older_than(spark, path, DAY + timedelta(days=30), days=10, dry_run=False)
    return _prices(spark, path)


def _compacted_transactions(spark, sf_dir):
    """Two versions of many keys in each hour; compaction keeps the newest of an hour."""
    path = scratch_path(spark, "transactions")
    rows = a.transactions_squeezed(spark, sf_dir).withColumns({
        "tick_number": F.floor(F.col("sequence_number") / 10), "sequence_number": F.col("sequence_number") % 5,
        "processed_at": F.col("processed_at").cast("timestamp"),
    })
    for batch_id in (0, 1):
        part = rows.filter(F.col("nonce") % 2 == batch_id)
        tables.write_rows(part, path, schemas.TRANSACTION_KEYS, batch_id, ("processed_at", "tx_hash"))
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.TRANSACTIONS.fields)
    upkeep.compact(
        spark, path, ddl, DAY + timedelta(hours=20), upkeep.COMPACT_AFTER["transactions"], schemas.TRANSACTION_KEYS,
        keys=schemas.TRANSACTION_KEYS,
    )
    kept = tables.read_current(tables.read_rows(spark, path, schemas.TRANSACTIONS), schemas.TRANSACTION_KEYS)
    return kept.select("tick_number", "sequence_number", "tx_hash", F.col("processed_at").cast("timestamp_ntz").alias("processed_at"))


QUERIES = {
    "signers_hourly_from_changes": _from_changes(rollups.TRANSACTIONS_HOURLY),
    "signers_summary_from_changes": _from_changes(rollups.TICK_TX_SUMMARY),
    "refreshed_dirty": _refreshed_dirty,
    "dirty_left": _dirty_left,
    "compacted_prices": _compacted_prices,
    "retained_prices": _retained_prices,
    "compacted_transactions": _compacted_transactions,
}

_LIVE = f"""WITH {a.TRANSACTIONS_SQUEEZED.replace("transactions AS (", "every AS (", 1)},
transactions AS (SELECT * FROM every WHERE version <> -1)"""

# The first arrival of a batch stays within it, and the first batch that has a time.
_PRICES = f"""WITH {a.OBSERVED_PRICES}, batched AS (
  SELECT market_id, date_trunc('hour', poll_time) AS ts, price, arrival,
    CASE WHEN arrival % 3 < 2 THEN 0 ELSE 1 END AS batch FROM observed)
SELECT market_id, ts, arg_min(price, batch * 1000000000000 + arrival) AS price FROM batched
{{where}} GROUP BY 1, 2"""

SQL = {
    "signers_hourly_from_changes": f"{_LIVE} {chain_plans.HOURLY_TRANSACTIONS} GROUP BY 1, 2",
    "signers_summary_from_changes": f"{_LIVE} {chain_plans.TICK_SUMMARY} GROUP BY 1, 2",
    "refreshed_dirty": f"""WITH {a.TRANSACTIONS_SQUEEZED} {chain_plans.HOURLY_TRANSACTIONS}
WHERE processed_at < TIMESTAMP '2024-01-01 12:00:00' GROUP BY 1, 2""",
    "dirty_left": f"""WITH {a.TRANSACTIONS_SQUEEZED}
SELECT DISTINCT date_trunc('hour', processed_at) AS bucket FROM transactions
WHERE processed_at >= TIMESTAMP '2024-01-01 12:00:00'""",
    "compacted_prices": _PRICES.format(where=""),
    "retained_prices": _PRICES.format(where="WHERE ts >= TIMESTAMP '2024-01-21 00:00:00'"),
    "compacted_transactions": f"""WITH {a.TRANSACTIONS_SQUEEZED}, keyed AS (
  SELECT sequence_number // 10 AS tick_number, sequence_number % 5 AS sequence_number, tx_hash, processed_at,
    nonce % 2 AS batch FROM transactions)
SELECT tick_number, sequence_number,
  arg_max(tx_hash, (processed_at, batch, tx_hash)) AS tx_hash, max(processed_at) AS processed_at
FROM keyed GROUP BY 1, 2""",
}
