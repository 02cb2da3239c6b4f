"""Validation and reorganisation checks over nested ticks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ticklake.functions.session import cut_lineage
from ticklake.operators.ordered import running
from ticklake.operators import quality as q
from ticklake.operators import reorg
from ticklake.plans import adapters as a

NOW = datetime(2024, 1, 1, 0, 1)
_NOW_US = 1704067260000000

# Broken rules in SQL: k is the order, g and i the place in the order of checks.
_TICK_ISSUES = f"""
  SELECT k, 1 AS g, 0 AS i, 0 AS j, 'timestamp' AS field, '0' AS value, 'not_zero' AS rule,
    'timestamp cannot be zero' AS message FROM raw WHERE ts_us = 0
  UNION ALL SELECT k, 1, 0, 1, 'timestamp', CAST(ts_us AS VARCHAR), 'future_limit',
    'timestamp ' || ts_us || ' is too far in the future' FROM raw
    WHERE ts_us > {_NOW_US} + 300000000
  UNION ALL SELECT k, 1, 0, 2, 'timestamp', CAST(ts_us AS VARCHAR), 'past_limit',
    'timestamp ' || ts_us || ' is too far in the past' FROM raw
    WHERE ts_us <> 0 AND ts_us < {_NOW_US} - 86400000000
  UNION ALL SELECT k, 2, 0, 0, 'vdf_proof', '', 'not_null', 'VDF proof is required' FROM raw
    WHERE NOT proven
  UNION ALL SELECT k, 2, 0, 1, 'vdf_input', '', 'not_empty', 'vdf_input cannot be empty' FROM raw
    WHERE proven AND p_input = ''
  UNION ALL SELECT k, 2, 0, 2, 'vdf_input', p_input, 'hex_format',
    'vdf_input must be a 64-character hexadecimal string (received length: ' || length(p_input)
    || ')' FROM raw WHERE proven AND p_input <> '' AND NOT regexp_full_match(p_input, '[a-fA-F0-9]{{64}}')
  UNION ALL SELECT k, 2, 0, 3, 'vdf_proof.proof', '', 'not_empty', 'VDF proof data cannot be empty'
    FROM raw WHERE proven AND p_proof = ''
  UNION ALL SELECT k, 2, 0, 4, 'vdf_proof.iterations', '0', 'positive',
    'VDF iterations must be positive' FROM raw WHERE proven AND p_iterations = 0
  UNION ALL SELECT k, 2, 0, 5, 'vdf_proof.iterations', CAST(p_iterations AS VARCHAR),
    'reasonable_limit', 'VDF iterations seem unreasonably high' FROM raw
    WHERE proven AND p_iterations > 1000000"""
_STRICT_ISSUES = """
  UNION ALL SELECT k, 3, 0, 1, 'vdf_output', p_output, 'hex_format',
    'vdf_output must be a valid hexadecimal string (received length: ' || length(p_output) || ')'
    FROM raw WHERE proven AND NOT regexp_full_match(p_output, '[a-fA-F0-9]+')
  UNION ALL SELECT k, 3, 0, 2, 'previous_output', '', 'not_empty',
    'previous_output cannot be empty' FROM raw WHERE previous = ''"""
_ENTRY_ISSUES = """
  UNION ALL SELECT k, 4, i, 1, name, '', 'not_null', 'transaction cannot be nil' FROM named
    WHERE gone
  UNION ALL SELECT k, 4, i, 0, name || '.sequence_number', CAST(seq AS VARCHAR), 'unique',
    'duplicate sequence number in tick' FROM (SELECT *, row_number() OVER (
      PARTITION BY k, seq ORDER BY i) AS nth FROM named WHERE NOT gone) WHERE nth > 1
  UNION ALL SELECT k, 4, i, 2, name || '.tx_hash', '', 'not_empty',
    name || '.tx_hash cannot be empty' FROM named WHERE NOT gone AND tx_hash = ''
  UNION ALL SELECT k, 4, i, 3, name || '.tx_hash', tx_hash, 'hex_format', name
    || '.tx_hash must be a 64-character hexadecimal string (received length: ' || length(tx_hash)
    || ')' FROM named WHERE NOT gone AND tx_hash = 'bad_hash'
  UNION ALL SELECT k, 4, i, 4, name || '.transaction', '', 'not_null',
    'transaction data cannot be nil' FROM named WHERE NOT gone AND hollow
  UNION ALL SELECT k, 4, i, 5, name || '.tx_id', '', 'not_empty', 'transaction ID cannot be empty'
    FROM filled WHERE tx_id = ''
  UNION ALL SELECT k, 4, i, 6, name || '.payload', '', 'not_empty',
    'transaction payload cannot be empty' FROM filled WHERE body = ''
  UNION ALL SELECT k, 4, i, 7, name || '.signature', left(lower(hex(encode(sig))), 20) || '...',
    'signature_format', 'signature must be a valid hex string' FROM filled
    WHERE length(sig) NOT IN (0, 64)
  UNION ALL SELECT k, 4, i, 8, name || '.public_key', left(lower(hex(encode(pub))), 20) || '...',
    'public_key_format', 'public key must be a valid hex string' FROM filled
    WHERE length(pub) NOT IN (0, 32)
  UNION ALL SELECT k, 4, i, 9, name || '.timestamp', '', 'positive',
    'transaction timestamp must be positive' FROM filled WHERE tx_time = 0"""


def _issues_with(strict: bool = False, recursive: bool = False) -> str:
    return f"""WITH {'RECURSIVE ' if recursive else ''}{a.NESTED},
named AS (SELECT *, 'transactions[' || i || ']' AS name FROM entries),
filled AS (SELECT * FROM named WHERE NOT gone AND NOT hollow),
issues AS ({_TICK_ISSUES}{_STRICT_ISSUES if strict else ''}{_ENTRY_ISSUES})"""


_LISTED = """listed AS (
  SELECT k AS arrival, CAST(row_number() OVER (PARTITION BY k ORDER BY g, i, j) - 1 AS INTEGER)
    AS place, field, value, rule, message FROM {source})"""

# The last valid number and time before each tick, one tick per source and round.
_WALK = """good AS (
  SELECT source_id, arrival, tick_number AS number, ts_us AS time,
    k NOT IN (SELECT k FROM issues) AS good,
    row_number() OVER (PARTITION BY source_id ORDER BY arrival) AS rn FROM raw),
walk AS (
  SELECT source_id, arrival, number, time, good, rn, CAST(0 AS BIGINT) AS last_number,
    CAST(0 AS BIGINT) AS last_time, good AS accepted FROM good WHERE rn = 1
  UNION ALL
  SELECT source_id, arrival, number, time, good, rn, last_number, last_time,
    good AND (last_number = 0 OR (number > last_number AND number - last_number <= 1000))
      AND (time = 0 OR last_time = 0 OR time >= last_time)
  FROM (SELECT g.*, CASE WHEN w.accepted THEN w.number ELSE w.last_number END AS last_number,
      CASE WHEN w.accepted THEN w.time ELSE w.last_time END AS last_time
    FROM walk w JOIN good g ON g.source_id = w.source_id AND g.rn = w.rn + 1))"""
_SEQUENCE_ISSUES = """sequence_issues AS (
  SELECT arrival AS k, 0 AS g, 0 AS i, 0 AS j, 'tick_number' AS field,
    CAST(number AS VARCHAR) AS value, 'sequence' AS rule, 'tick number ' || number
    || ' is not greater than previous tick ' || last_number AS message
  FROM state WHERE last_number > 0 AND number <= last_number
  UNION ALL SELECT arrival, 0, 0, 1, 'tick_number', CAST(number AS VARCHAR), 'jump_limit',
    'tick number jump of ' || CASE WHEN number < last_number
      THEN 18446744073709551616::HUGEINT + number - last_number ELSE number - last_number END
    || ' exceeds maximum allowed 1000'
  FROM state WHERE last_number > 0 AND (number < last_number OR number - last_number > 1000)
  UNION ALL SELECT arrival, 1, 0, 3, 'timestamp', CAST(time AS VARCHAR), 'sequence',
    'timestamp goes backwards: ' || time || ' < ' || last_time
  FROM state WHERE time <> 0 AND last_time > 0 AND time < last_time)"""


def _exploded(checked):
    return q.issue_rows(checked.select("arrival", "issues")).select(
        "arrival", "place", "field", "value", "rule", "message"
    )


def _nested(spark, sf_dir):
    return a.nested_ticks(spark, sf_dir)


def _tick_issues(strict):
    return lambda spark, sf_dir: _exploded(q.tick_issues(_nested(spark, sf_dir), NOW, strict))


def _state(spark, sf_dir):
    return q.sequence_state(q.slim_ticks(_nested(spark, sf_dir), NOW))


def _highest_before(spark, sf_dir):
    """The highest number and time of the earlier ticks, valid or not."""
    highest = {"last_number": ("max", F.col("tick_number")), "last_time": ("max", F.col("timestamp"))}
    rows = running(q.slim_ticks(_nested(spark, sf_dir), NOW), ["source_id"], ["arrival"], highest)
    return rows.fillna(0, [*highest]).select("source_id", "arrival", *highest)


def _severity(spark, sf_dir):
    checked = q.validate(_nested(spark, sf_dir), NOW)
    # Checked once and stored, as each of the three parts reads them.
    stored = cut_lineage(checked.select("arrival", "tick_number", "is_valid", "issues"))
    parts = q.split_by_severity(stored)
    labelled = [
        part.select("arrival", "tick_number", "is_valid", F.lit(name).alias("severity"))
        for name, part in zip(("clean", "warned", "quarantined"), parts)
    ]
    return labelled[0].unionByName(labelled[1]).unionByName(labelled[2])


def _row_predicates(spark, sf_dir):
    flat = a.ticks_chain(spark, sf_dir).withColumn(
        "transaction_batch_hash",
        F.when(F.col("tick_number") % 9 == 0, None).otherwise(F.col("transaction_batch_hash")),
    )
    return flat.select(
        "tick_number",
        q.tick_row_is_valid().alias("valid"),
        q.is_parseable().alias("parseable"),
    )


def _transaction_predicates(spark, sf_dir):
    rows = a.transactions_chain(spark, sf_dir).withColumn(
        "signature", F.when(F.col("nonce") % 5 == 0, F.lit(b"")).otherwise(F.col("signature"))
    )
    return rows.select(
        "tick_number", "sequence_number", "tx_hash", q.transaction_row_is_valid().alias("valid")
    )


QUERIES = {
    "tick_issues": _tick_issues(False),
    "tick_issues_strict": _tick_issues(True),
    "sequence_state_exact": lambda s, d: _state(s, d).drop("good"),
    "sequence_state_lag": _highest_before,
    "validated_issues": lambda s, d: _exploded(q.validate(_nested(s, d), NOW)),
    "validation_severity": _severity,
    "validation_stats": lambda s, d: q.validation_stats(_state(s, d)).withColumn(
        "last_validated_time", F.col("last_validated_time").cast("timestamp_ntz")
    ),
    "tick_row_predicates": _row_predicates,
    "transaction_row_predicates": _transaction_predicates,
    "reorg_events": lambda s, d: reorg.reorg_events(a.tick_copies(s, d)),
    "reorg_events_windowed": lambda s, d: reorg.windowed_events(a.tick_copies(s, d), 128),
    "reorg_stats": lambda s, d: reorg.reorg_stats(reorg.windowed(a.tick_copies(s, d), 128), 128),
}

_VALIDATED = f"""{_issues_with(recursive=True)}, {_WALK}, state AS (SELECT * FROM walk),
{_SEQUENCE_ISSUES},
all_issues AS (SELECT * FROM issues UNION ALL SELECT * FROM sequence_issues)"""

# Copies that conflict with the remembered version, one copy per tick and round.
_REORG = f"""WITH RECURSIVE {a.COPIES},
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source_id, tick_number ORDER BY arrival) AS rn
  FROM copies),
walk AS (
  SELECT source_id, tick_number, arrival, rn, arrival AS base_arrival, output AS base_output,
    batch_hash AS base_batch, previous_output AS base_previous, tx_count AS base_count,
    CAST(NULL AS BIGINT) AS old_arrival, '' AS conflict_reason
  FROM numbered WHERE rn = 1
  UNION ALL
  SELECT source_id, tick_number, arrival, rn,
    CASE WHEN reason = '' THEN arrival ELSE base_arrival END,
    CASE WHEN reason = '' THEN output ELSE base_output END,
    CASE WHEN reason = '' THEN batch_hash ELSE base_batch END,
    CASE WHEN reason = '' THEN previous_output ELSE base_previous END,
    CASE WHEN reason = '' THEN tx_count ELSE base_count END, base_arrival, reason
  FROM (SELECT n.*, w.base_arrival, w.base_output, w.base_batch, w.base_previous, w.base_count,
      concat_ws(', ', CASE WHEN n.output <> w.base_output THEN 'VDF output mismatch' END,
        CASE WHEN n.batch_hash <> w.base_batch THEN 'transaction batch hash mismatch' END,
        CASE WHEN n.previous_output <> w.base_previous THEN 'previous output mismatch' END,
        CASE WHEN n.tx_count <> w.base_count THEN 'transaction count mismatch ('
          || w.base_count || ' vs ' || n.tx_count || ')' END) AS reason
    FROM walk w JOIN numbered n ON n.source_id = w.source_id AND n.tick_number = w.tick_number
      AND n.rn = w.rn + 1))
SELECT source_id, tick_number, arrival, old_arrival, conflict_reason FROM walk
WHERE conflict_reason <> ''"""

# The same with a memory of recent numbers, one copy per source and round. A round holds the
# remembered (number, arrival) pairs only; what they say is looked up by arrival.
_WINDOWED = f"""WITH RECURSIVE {a.COPIES},
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY arrival) AS rn FROM copies),
walk AS (
  SELECT source_id, CAST(0 AS BIGINT) AS rn, CAST([] AS STRUCT(n BIGINT, copy BIGINT)[]) AS seen,
    CAST(NULL AS BIGINT) AS tick_number, CAST(NULL AS BIGINT) AS arrival,
    CAST(NULL AS BIGINT) AS old_arrival, '' AS conflict_reason
  FROM (SELECT DISTINCT source_id FROM copies)
  UNION ALL
  SELECT source_id, rn, CASE WHEN reason <> '' THEN seen
      WHEN len(stored) > 128 THEN list_filter(stored, lambda x: x.n >= greatest(tick_number - 127, 0))
      ELSE stored END,
    tick_number, arrival, CASE WHEN reason <> '' THEN old_arrival END, reason
  FROM (SELECT l.*, list_append(list_filter(l.seen, lambda x: x.n <> l.tick_number),
      {{'n': l.tick_number, 'copy': l.arrival}}) AS stored,
      concat_ws(', ', CASE WHEN l.output <> o.output THEN 'VDF output mismatch' END,
        CASE WHEN l.batch_hash <> o.batch_hash THEN 'transaction batch hash mismatch' END,
        CASE WHEN l.previous_output <> o.previous_output THEN 'previous output mismatch' END,
        CASE WHEN l.tx_count <> o.tx_count THEN 'transaction count mismatch ('
          || o.tx_count || ' vs ' || l.tx_count || ')' END) AS reason
    FROM (SELECT n.*, w.seen, list_filter(w.seen, lambda x: x.n = n.tick_number)[1]['copy'] AS old_arrival
      FROM walk w JOIN numbered n ON n.source_id = w.source_id AND n.rn = w.rn + 1) l
    LEFT JOIN numbered o ON o.source_id = l.source_id AND o.arrival = l.old_arrival))"""
_WINDOWED_EVENTS = f"""{_WINDOWED}
SELECT source_id, tick_number, arrival, old_arrival, conflict_reason FROM walk
WHERE conflict_reason <> ''"""

SQL = {
    "tick_issues": f"{_issues_with()}, {_LISTED.format(source='issues')} SELECT * FROM listed",
    "tick_issues_strict": f"""{_issues_with(strict=True)}, {_LISTED.format(source='issues')}
SELECT * FROM listed""",
    "sequence_state_exact": f"""{_issues_with(recursive=True)}, {_WALK}
SELECT source_id, arrival, number AS tick_number, time AS timestamp, last_number, last_time,
  accepted FROM walk""",
    "sequence_state_lag": f"""WITH {a.NESTED}
SELECT source_id, arrival, coalesce(max(tick_number) OVER w, 0) AS last_number,
  coalesce(max(ts_us) OVER w, 0) AS last_time FROM raw
WINDOW w AS (PARTITION BY source_id ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING
  AND 1 PRECEDING)""",
    "validated_issues": f"""{_VALIDATED}, {_LISTED.format(source='all_issues')}
SELECT * FROM listed""",
    "validation_severity": f"""{_VALIDATED},
graded AS (SELECT k, bool_or(rule IN ('not_null', 'sequence', 'critical_hash_mismatch')) AS critical
  FROM all_issues GROUP BY k)
SELECT r.arrival, r.tick_number, g.k IS NULL AS is_valid,
  CASE WHEN g.k IS NULL THEN 'clean' WHEN critical THEN 'quarantined' ELSE 'warned' END AS severity
FROM raw r LEFT JOIN graded g USING (k)""",
    "validation_stats": f"""{_issues_with(recursive=True)}, {_WALK}
SELECT source_id,
  coalesce(arg_max(number, arrival) FILTER (accepted), 0) AS last_validated_tick,
  make_timestamp(coalesce(arg_max(time, arrival) FILTER (accepted), 0)) AS last_validated_time,
  count(*) FILTER (last_number > 0 AND (number < last_number OR number - last_number > 1000))
    AS sequence_gaps
FROM walk GROUP BY source_id""",
    "tick_row_predicates": f"""WITH {a.TICKS_CHAIN}
SELECT tick_number, tick_number > 0 AND timestamp_us > 0 AND tick_number % 9 <> 0 AS valid,
  tick_number <> 0 AS parseable FROM ticks""",
    "transaction_row_predicates": f"""WITH {a.TRANSACTIONS_CHAIN}
SELECT tick_number, sequence_number, tx_hash, tick_number > 0 AND nonce % 5 <> 0 AS valid
FROM transactions""",
    "reorg_events": _REORG,
    "reorg_events_windowed": _WINDOWED_EVENTS,
    "reorg_stats": f"""{_WINDOWED}
SELECT source_id, 128 AS window_size, CAST(arg_max(len(seen), rn) AS INTEGER) AS current_window,
  count(*) FILTER (conflict_reason <> '') AS conflicts_found FROM walk GROUP BY source_id""",
}
