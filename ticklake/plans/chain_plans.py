"""Parsing, reads and rollups over ticks and transactions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticklake.functions.payload import decode_bytes, decode_hex, decoded_json
from ticklake.functions.text import sanitize, sanitize_json, sanitize_url_param
from ticklake.operators import lookup, parse, reorg, rollups
from ticklake.plans import adapters as a

QUERIES: dict = {}
SQL: dict = {}


def _register(name: str, sql: str | None):
    def keep(query):
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query

    return keep


_CHAIN = f"WITH {a.TICKS_CHAIN}, {a.TRANSACTIONS_CHAIN}"
_DENSE = f"WITH {a.TICKS_DENSE}, {a.TRANSACTIONS_DENSE}"

# --- parsing ------------------------------------------------------------------------


@_register(
    "flatten_ticks",
    f"""WITH {a.NESTED}
SELECT source_id, arrival, tick_number, ts_us AS timestamp_us,
  CASE WHEN proven THEN p_input ELSE '' END AS vdf_input,
  CASE WHEN proven THEN p_output ELSE '' END AS vdf_output,
  CASE WHEN proven THEN p_proof ELSE '' END AS vdf_proof,
  CASE WHEN proven THEN p_iterations ELSE 0 END AS vdf_iterations,
  batch AS transaction_batch_hash, previous AS previous_output, n AS tx_count FROM raw""",
)
def _flatten(spark, sf_dir):
    return parse.flatten_ticks(a.nested_ticks(spark, sf_dir), keep=("source_id", "arrival"))


_EXPLODED = f"""WITH {a.NESTED},
flat AS (
  SELECT arrival, tick_number, seq AS sequence_number,
    CASE WHEN tx_hash <> '' THEN tx_hash ELSE sha256(concat_ws('_', tx_id, nonce, tx_time,
      lower(hex(encode(body))))) END AS tx_hash,
    tx_id, nonce, lower(hex(encode(body))) AS payload, tx_time AS timestamp_us,
    lower(hex(encode(pub))) AS public_key, lower(hex(encode(sig))) AS signature,
    ingested AS ingestion_timestamp,
    CAST(octet_length(encode(body)) AS INTEGER) AS payload_size
  FROM entries WHERE NOT gone AND NOT hollow)"""


@_register("explode_transactions", f"{_EXPLODED} SELECT * FROM flat")
def _explode(spark, sf_dir):
    rows = parse.explode_transactions(a.nested_ticks(spark, sf_dir), keep=("arrival",))
    return rows.withColumns(
        {c: parse.lower_hex(c) for c in ("payload", "public_key", "signature")}
    )


@_register(
    "stored_tick_rows",
    f"""WITH {a.NESTED}
SELECT tick_number, ts_us AS timestamp_us,
  nullif(CASE WHEN proven THEN p_input ELSE '' END, '') AS vdf_input,
  nullif(CASE WHEN proven THEN p_output ELSE '' END, '') AS vdf_output,
  nullif(CASE WHEN proven THEN p_proof ELSE '' END, '') AS vdf_proof,
  CASE WHEN proven THEN p_iterations ELSE 0 END AS vdf_iterations,
  nullif(batch, '') AS transaction_batch_hash, nullif(previous, '') AS previous_output,
  n AS tx_count, make_timestamp(ts_us) AS processed_at, 1 AS version
FROM raw WHERE k IN (SELECT k FROM entries WHERE NOT gone AND NOT hollow)""",
)
def _tick_rows(spark, sf_dir):
    at = parse.micros_to_time("timestamp_us").cast("timestamp_ntz")
    return parse.tick_rows(a.nested_ticks(spark, sf_dir), at)


@_register(
    "stored_transaction_classes",
    f"""{_EXPLODED}
SELECT tick_number, sequence_number, tx_hash, payload_size,
  CASE WHEN payload_size = 0 THEN 'empty' WHEN payload_size < 32 THEN 'small'
    WHEN payload_size < 256 THEN 'medium' WHEN payload_size < 1024 THEN 'large'
    ELSE 'xlarge' END AS payload_type,
  make_timestamp(ingestion_timestamp) AS processed_at FROM flat""",
)
def _transaction_rows(spark, sf_dir):
    at = parse.micros_to_time("ingestion_timestamp").cast("timestamp_ntz")
    return parse.transaction_rows(a.nested_ticks(spark, sf_dir), at).select(
        "tick_number", "sequence_number", "tx_hash", "payload_size", "payload_type", "processed_at"
    )


@_register(
    "payload_classes",
    f"""{_CHAIN}
SELECT CASE WHEN payload_size = 0 THEN 'empty' WHEN payload_size < 32 THEN 'small'
    WHEN payload_size < 256 THEN 'medium' WHEN payload_size < 1024 THEN 'large'
    ELSE 'xlarge' END AS payload_class, count(*) AS n,
  CAST(sum(octet_length(payload)) AS BIGINT) AS bytes FROM transactions GROUP BY 1""",
)
def _payload_classes(spark, sf_dir):
    rows = a.transactions_chain(spark, sf_dir)
    return rows.groupBy(parse.payload_class("payload").alias("payload_class")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(parse.payload_size("payload")).alias("bytes")
    )


@_register(
    "block_rows",
    f"""WITH {a.NESTED}
SELECT tick_number, tick_number AS height, batch AS block_hash, previous AS parent_hash,
  n AS tx_count, CAST(0 AS BIGINT) AS payload_size_bytes, CAST(0 AS BIGINT) AS size_bytes,
  ts_us AS timestamp, '' AS proposer_id, '' AS proposer_key, 'mainnet' AS chain_id,
  'qubic' AS network, 1 AS version FROM raw""",
)
def _blocks(spark, sf_dir):
    return parse.block_rows(a.nested_ticks(spark, sf_dir))


@_register(
    "human_times",
    f"""{_CHAIN} SELECT tx_hash, make_timestamp(timestamp_us) AS human_time,
  make_timestamp(ingestion_timestamp) AS ingestion_time FROM transactions""",
)
def _times(spark, sf_dir):
    return a.transactions_chain(spark, sf_dir).select(
        "tx_hash",
        parse.micros_to_time("timestamp_us").cast("timestamp_ntz").alias("human_time"),
        parse.micros_to_time("ingestion_timestamp").cast("timestamp_ntz").alias("ingestion_time"),
    )


_DECODED = """decoded AS (
  SELECT event_id, body, CASE WHEN body = '' THEN NULL
    WHEN starts_with(body, 'FRM_v1.0:') AND json_valid(body[10:]) THEN 'protocol'
    WHEN starts_with(body, 'FRM_v1.0:') THEN 'protocol_error'
    WHEN json_valid(body) THEN 'json' ELSE 'text' END AS kind FROM payloads)
SELECT event_id, kind, CASE kind
  WHEN 'protocol' THEN '{"data":' || CAST(json(body[10:]) AS VARCHAR) || ',"protocol":"FRM_v1.0"}'
  WHEN 'protocol_error' THEN '{"error":"invalid JSON in payload","protocol":"FRM_v1.0","raw_json":'
    || CAST(to_json(body[10:]) AS VARCHAR) || '}'
  WHEN 'json' THEN CAST(json(body) AS VARCHAR)
  WHEN 'text' THEN '{"data":' || CAST(to_json(body) AS VARCHAR) || ',"type":"text"}' END AS document
FROM decoded"""


@_register("payload_decode", f"WITH {a.PAYLOADS}, {_DECODED}")
def _decode(spark, sf_dir):
    decoded = decode_bytes(F.encode("body", "UTF-8"))
    return a.payloads(spark, sf_dir).select(
        "event_id", decoded["kind"].alias("kind"), decoded_json(decoded).alias("document")
    )


@_register(
    "payload_decode_hex",
    f"""WITH {a.PAYLOADS}, hexed AS (
  SELECT event_id, CASE WHEN event_id % 8 = 2 THEN body ELSE lower(hex(encode(body))) END AS raw,
    body, event_id % 8 AS k FROM payloads)
SELECT event_id, CASE WHEN k = 2 THEN 'invalid_hex' WHEN k = 0 THEN NULL
    WHEN k = 1 THEN 'protocol' WHEN k = 5 THEN 'text' ELSE 'json' END AS kind,
  CASE WHEN k = 2 THEN 'invalid hex encoding' END AS error,
  CASE WHEN k = 2 THEN raw WHEN k = 5 THEN body END AS raw FROM hexed""",
)
def _decode_hex(spark, sf_dir):
    given = F.when(F.col("event_id") % 8 == 2, F.col("body")).otherwise(
        parse.lower_hex(F.encode("body", "UTF-8"))
    )
    decoded = decode_hex(given)
    return a.payloads(spark, sf_dir).select(
        "event_id", *[decoded[c].alias(c) for c in ("kind", "error", "raw")]
    )


_SUBMITTED = f"""WITH {a.SUBMISSIONS}, typed AS (
  SELECT *, CASE WHEN tx_id = '' OR nonce = 0 THEN 'missing required field'
    WHEN NOT regexp_full_match(signature, '([0-9a-fA-F]{{2}})*') THEN 'invalid signature hex'
    WHEN NOT regexp_full_match(timestamp, '[0-9]+') OR TRY_CAST(timestamp AS BIGINT) IS NULL
      THEN 'invalid timestamp' END AS reason FROM submissions)"""


@_register(
    "submissions_accepted",
    f"""{_SUBMITTED}
SELECT idx, tx_id, lower(hex(payload)) AS payload, lower(signature) AS signature,
  lower(hex(encode(public_key))) AS public_key, nonce, CAST(timestamp AS BIGINT) AS timestamp
FROM typed WHERE reason IS NULL""",
)
def _accepted(spark, sf_dir):
    good, _ = parse.split_submissions(a.submissions(spark, sf_dir))
    return good.withColumns(
        {c: parse.lower_hex(c) for c in ("payload", "signature", "public_key")}
    )


@_register(
    "submissions_rejected",
    f"{_SUBMITTED} SELECT idx, reason FROM typed WHERE reason IS NOT NULL",
)
def _rejected(spark, sf_dir):
    return parse.split_submissions(a.submissions(spark, sf_dir))[1]


def _sanitized_sql(column: str) -> str:
    spaces = (
        "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' '||chr(133)||chr(160)||chr(5760)||chr(8192)"
        "||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)"
        "||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)"
    )
    out = f"trim({column}, {spaces})"
    for plain, escaped in [("&", "&amp;"), ("''", "&#39;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&#34;")]:
        out = f"replace({out}, '{plain}', '{escaped}')"
    patterns = [
        "(?i)(union|select|insert|update|delete|drop|create|alter|exec|execute|script|javascript"
        "|onload|onerror|onclick)",
        r"(?i)(<script|<iframe|javascript:|on\w+=)",
        r"\.\.[\\/]|\.\.\\|%2e%2e|%252e%252e",
        r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x{9F}]",
    ]
    for pattern in patterns:
        out = f"regexp_replace({out}, '{pattern}', '', 'g')"
    return out


@_register(
    "text_sanitized_documents",
    f"SELECT doc_id, {_sanitized_sql('text')} AS text FROM documents",
)
def _sanitized(spark, sf_dir):
    documents = a.spread(a.read(spark, sf_dir, "documents"))
    return documents.select("doc_id", sanitize(F.col("text"), max_bytes=None).alias("text"))


@_register(
    "text_sanitized_pages",
    f"""SELECT page_id, replace({_sanitized_sql('url')}, '%00', '') AS url,
  replace(replace({_sanitized_sql('html')}, '</script>', ''), '<script>', '') AS html
FROM pages""",
)
def _sanitized_pages(spark, sf_dir):
    return a.spread(a.read(spark, sf_dir, "pages")).select(
        "page_id",
        sanitize_url_param(F.col("url"), max_bytes=None).alias("url"),
        sanitize_json(F.col("html"), max_bytes=None).alias("html"),
    )


# --- reads --------------------------------------------------------------------------

_CURRENT_TICKS = """current_ticks AS (
  SELECT * FROM ticks WHERE version > 0
  QUALIFY row_number() OVER (PARTITION BY tick_number ORDER BY processed_at DESC) = 1)"""
_CURRENT_TRANSACTIONS = """current_transactions AS (
  SELECT * FROM transactions WHERE version > 0
  QUALIFY row_number() OVER (PARTITION BY tick_number, sequence_number
    ORDER BY processed_at DESC, tx_hash DESC) = 1)"""
_READ_TICK = """tick_number, timestamp_us, coalesce(vdf_input, '') AS vdf_input,
  coalesce(vdf_output, '') AS vdf_output, coalesce(vdf_proof, '') AS vdf_proof,
  coalesce(vdf_iterations, 0) AS vdf_iterations,
  coalesce(transaction_batch_hash, '') AS transaction_batch_hash,
  coalesce(previous_output, '') AS previous_output, tx_count, processed_at, version"""


@_register(
    "current_transactions",
    f"""{_CHAIN}, {_CURRENT_TRANSACTIONS}
SELECT tick_number, sequence_number, tx_hash, processed_at, payload_size
FROM current_transactions""",
)
def _current(spark, sf_dir):
    return lookup.current_transactions(a.transactions_chain(spark, sf_dir)).select(
        "tick_number", "sequence_number", "tx_hash", "processed_at", "payload_size"
    )


@_register(
    "latest_tick_rows",
    f"""{_CHAIN}, stored AS (
  SELECT tick_number // 2 AS tick_number, transaction_batch_hash, processed_at, tx_count, version
  FROM ticks)
SELECT tick_number, transaction_batch_hash, processed_at, tx_count FROM stored WHERE version > 0
QUALIFY row_number() OVER (PARTITION BY tick_number
  ORDER BY processed_at DESC, transaction_batch_hash DESC) = 1""",
)
def _latest(spark, sf_dir):
    stored = a.ticks_chain(spark, sf_dir).withColumn("tick_number", F.floor(F.col("tick_number") / 2))
    newest = lookup.current(
        lookup.live(stored), ["tick_number"], ["processed_at", "transaction_batch_hash"]
    )
    return newest.select("tick_number", "transaction_batch_hash", "processed_at", "tx_count")


@_register(
    "recent_ticks",
    f"""{_CHAIN} SELECT {_READ_TICK} FROM ticks t WHERE t.version > 0
ORDER BY t.processed_at DESC, t.tick_number DESC LIMIT 100""",
)
def _recent_ticks(spark, sf_dir):
    return lookup.recent_ticks(a.ticks_chain(spark, sf_dir), 100)


@_register(
    "recent_transactions",
    f"""{_CHAIN} SELECT sequence_number, tx_hash, tick_number, tx_id, timestamp_us
FROM transactions WHERE version > 0
ORDER BY processed_at DESC, tick_number DESC, sequence_number DESC, tx_hash DESC LIMIT 50""",
)
def _recent_transactions(spark, sf_dir):
    return lookup.recent_transactions(a.transactions_chain(spark, sf_dir))


@_register(
    "tick_with_transactions",
    f"""{_CHAIN}, {_CURRENT_TICKS}, {_CURRENT_TRANSACTIONS},
shown AS (
  SELECT *, CASE WHEN octet_length(payload) = 0 THEN NULL
    ELSE '{{"data":"' || decode(payload) || '","type":"text"}}' END AS payload_decoded
  FROM current_transactions)
SELECT t.tick_number, coalesce(t.vdf_proof, '') AS vdf_proof, t.tx_count, t.processed_at,
  s.sequence_number, s.tx_hash, s.payload_decoded, lower(hex(s.public_key)) AS public_key,
  s.processed_at AS tx_processed_at,
  CASE WHEN s.tx_hash IS NOT NULL THEN coalesce(s.payload_type, '') END AS payload_type
FROM current_ticks t LEFT JOIN shown s USING (tick_number)""",
)
def _tick_with_transactions(spark, sf_dir):
    rows = lookup.tick_transactions(
        a.ticks_chain(spark, sf_dir), a.transactions_chain(spark, sf_dir)
    )
    return rows.select(
        "tick_number", "vdf_proof", "tx_count", "processed_at", "sequence_number", "tx_hash",
        "payload_decoded", "public_key", "tx_processed_at", "payload_type",
    )


@_register(
    "tick_documents_whole",
    f"""{_CHAIN}, {_CURRENT_TICKS}, {_CURRENT_TRANSACTIONS}
SELECT t.tick_number, count(c.tick_number) AS n
FROM current_ticks t LEFT JOIN current_transactions c USING (tick_number) GROUP BY 1""",
)
def _whole_documents(spark, sf_dir):
    documents = lookup.tick_documents(
        a.ticks_chain(spark, sf_dir), a.transactions_chain(spark, sf_dir), document_rows=None
    )
    return documents.select("tick_number", F.size("transactions").cast("long").alias("n"))


@_register(
    "tick_documents",
    f"""{_CHAIN}, {_CURRENT_TICKS}, {_CURRENT_TRANSACTIONS}
SELECT t.tick_number, t.transaction_batch_hash, c.sequence_number // 3 AS part,
  count(*) AS n, string_agg(c.sequence_number || ':' || c.tx_hash || ':' || c.payload_size, ','
    ORDER BY c.sequence_number) AS listed
FROM current_ticks t JOIN current_transactions c USING (tick_number) GROUP BY ALL
UNION ALL
SELECT tick_number, transaction_batch_hash, 0, 0, '' FROM current_ticks
WHERE tick_number NOT IN (SELECT tick_number FROM current_transactions)""",
)
def _documents(spark, sf_dir):
    # Three transactions to a document, so that ticks of several parts occur.
    nested = lookup.tick_documents(
        a.ticks_chain(spark, sf_dir), a.transactions_chain(spark, sf_dir), document_rows=3
    )
    line = F.transform(
        "transactions",
        lambda t: F.concat_ws(":", t["sequence_number"], t["tx_hash"], t["payload_size"]),
    )
    return nested.select(
        "tick_number",
        "transaction_batch_hash",
        "part",
        F.size("transactions").cast("bigint").alias("n"),
        F.array_join(line, ",").alias("listed"),
    )


def _wanted(spark, sf_dir):
    """Short prefixes from the orders, and the full hash of every transaction."""
    digest = a.sha(F.col("o_orderkey").cast("string"))
    short = a.read(spark, sf_dir, "orders").select(
        F.left(digest, (F.col("o_orderkey") % 3 + 2).cast("int")).alias("wanted")
    )
    return short.union(a.transactions_chain(spark, sf_dir).select("tx_hash"))


@_register(
    "find_transactions",
    f"""{_CHAIN}, wanted AS (
  SELECT DISTINCT left(sha256(CAST(o_orderkey AS VARCHAR)), CAST(o_orderkey % 3 + 2 AS INTEGER))
    AS wanted FROM orders
  UNION SELECT tx_hash FROM transactions),
cased AS (SELECT *, unnest([left(tx_hash, 2), left(tx_hash, 3), left(tx_hash, 4), tx_hash]) AS wanted
  FROM transactions WHERE version > 0)
SELECT wanted, tx_hash, tick_number, sequence_number, payload_size
FROM cased SEMI JOIN wanted USING (wanted)
QUALIFY row_number() OVER (PARTITION BY wanted ORDER BY processed_at DESC, tick_number DESC,
  sequence_number DESC, tx_hash DESC) = 1""",
)
def _find(spark, sf_dir):
    found = lookup.find_transactions(a.transactions_chain(spark, sf_dir), _wanted(spark, sf_dir))
    return found.select("wanted", "tx_hash", "tick_number", "sequence_number", "payload_size")


@_register(
    "find_transaction_by_prefix",
    f"""{_CHAIN} SELECT tx_hash, tick_number, sequence_number, tx_id, lower(hex(payload)) AS payload
FROM transactions WHERE version > 0 AND starts_with(tx_hash, 'a1')
ORDER BY processed_at DESC, tick_number DESC, sequence_number DESC, tx_hash DESC LIMIT 1""",
)
def _find_one(spark, sf_dir):
    found = lookup.find_transaction(a.transactions_chain(spark, sf_dir), "a1")
    return found.select("tx_hash", "tick_number", "sequence_number", "tx_id", "payload")


@_register(
    "ticks_page",
    f"{_CHAIN} SELECT tick_number, processed_at FROM ticks ORDER BY tick_number LIMIT 500 OFFSET 300",
)
def _page(spark, sf_dir):
    ticks = a.ticks_chain(spark, sf_dir).select("tick_number", "processed_at")
    return lookup.page(ticks, ["tick_number"], limit=500, offset=300)


@_register(
    "transactions_page_after_key",
    f"""{_CHAIN} SELECT tick_number, sequence_number, tx_hash FROM transactions
WHERE (tick_number, sequence_number, tx_hash) > (400, 3, '8')
ORDER BY tick_number, sequence_number, tx_hash LIMIT 1000""",
)
def _page_after(spark, sf_dir):
    keys = ["tick_number", "sequence_number", "tx_hash"]
    rows = a.transactions_chain(spark, sf_dir).select(*keys)
    return lookup.page_after(rows, keys, (400, 3, "8"), limit=1000)


@_register(
    "rows_of_owner_and_market",
    f"""{_DENSE} SELECT sequence_number, nonce AS owner, payload_type AS market_id, payload_size
FROM transactions WHERE nonce = 8 AND payload_type = 'click'""",
)
def _where_equal(spark, sf_dir):
    rows = a.transactions_dense(spark, sf_dir).select(
        "sequence_number",
        F.col("nonce").alias("owner"),
        F.col("payload_type").alias("market_id"),
        "payload_size",
    )
    return lookup.where_equal(rows, owner=8, market_id="click")


@_register(
    "last_tick", f"{_CHAIN} SELECT coalesce(max(tick_number), 0) AS last_tick FROM ticks WHERE version > 0"
)
def _last_tick(spark, sf_dir):
    return lookup.last_tick(a.ticks_chain(spark, sf_dir))


_TOTALS = """totals AS (SELECT
  coalesce((SELECT max(tick_number) FROM ticks WHERE version > 0), 0) AS chain_height,
  coalesce((SELECT count(*) FROM transactions WHERE version > 0), 0) AS total_transactions)"""


@_register("chain_totals", f"{_CHAIN}, {_TOTALS} SELECT * FROM totals")
def _totals(spark, sf_dir):
    return lookup.chain_totals(a.ticks_chain(spark, sf_dir), a.transactions_chain(spark, sf_dir))


_SAMPLE = """newest AS (
  SELECT tx_hash, tick_number FROM transactions WHERE version > 0
  ORDER BY processed_at DESC, tick_number DESC, sequence_number DESC, tx_hash DESC LIMIT 5)"""


@_register(
    "hash_sample",
    f"{_CHAIN}, {_SAMPLE} SELECT tx_hash, CAST(tick_number AS VARCHAR) AS tick_number FROM newest",
)
def _hash_sample(spark, sf_dir):
    return lookup.hash_sample(a.transactions_chain(spark, sf_dir))


@_register(
    "chain_state",
    f"""{_CHAIN}, {_TOTALS}, {_SAMPLE}
SELECT CAST(chain_height AS VARCHAR) AS chain_height,
  CAST(total_transactions AS VARCHAR) AS total_transactions,
  (SELECT string_agg(tick_number, ',' ORDER BY processed_at DESC, tick_number DESC) FROM (
    SELECT * FROM ticks WHERE version > 0 ORDER BY processed_at DESC, tick_number DESC LIMIT 10))
    AS recent_ticks,
  (SELECT string_agg(tx_hash || '=' || tick_number, ',' ORDER BY tx_hash) FROM newest)
    AS tx_to_tick_sample
FROM totals""",
)
def _chain_state(spark, sf_dir):
    state = lookup.chain_state(a.ticks_chain(spark, sf_dir), a.transactions_chain(spark, sf_dir))
    entries = F.array_sort(
        F.transform(F.map_entries("tx_to_tick_sample"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    )
    return state.select(
        "chain_height",
        "total_transactions",
        F.array_join(F.col("recent_ticks.tick_number").cast("array<string>"), ",").alias(
            "recent_ticks"
        ),
        F.array_join(entries, ",").alias("tx_to_tick_sample"),
    )


# --- rollups ------------------------------------------------------------------------

_HOURLY_TICKS = """SELECT date_trunc('hour', processed_at) AS hour, count(*) AS tick_count,
  avg(tx_count) AS avg_tx_per_tick, min(tick_number) AS min_tick_number,
  max(tick_number) AS max_tick_number,
  count(CASE WHEN vdf_iterations > 0 THEN 1 END) AS ticks_with_vdf FROM ticks"""
HOURLY_TRANSACTIONS = """SELECT date_trunc('hour', processed_at) AS hour, payload_type,
  count(*) AS tx_count, avg(payload_size) AS avg_payload_size,
  CAST(sum(payload_size) AS BIGINT) AS total_payload_bytes,
  count(DISTINCT public_key) AS unique_signers, min(tick_number) AS min_tick_number,
  max(tick_number) AS max_tick_number FROM transactions"""
TICK_SUMMARY = """SELECT time_bucket(INTERVAL 300 SECOND, processed_at, TIMESTAMP '1970-01-01')
    AS bucket, tick_number, count(*) AS tx_count, count(DISTINCT public_key) AS unique_signers,
  avg(payload_size) AS avg_payload_size, CAST(sum(payload_size) AS BIGINT) AS total_payload_bytes
FROM transactions"""
_SQUEEZED = f"WITH {a.TRANSACTIONS_SQUEEZED}"
SQUEEZED_SQL = f"{_SQUEEZED} {HOURLY_TRANSACTIONS} GROUP BY 1, 2"
ROLLUP_SQL = {
    "ticks_hourly": f"{_DENSE} {_HOURLY_TICKS} GROUP BY 1",
    "transactions_hourly": f"{_DENSE} {HOURLY_TRANSACTIONS} GROUP BY 1, 2",
    "tick_tx_summary": f"{_DENSE} {TICK_SUMMARY} GROUP BY 1, 2",
}

_register("rollup_ticks_hourly", ROLLUP_SQL["ticks_hourly"])(
    lambda spark, sf_dir: rollups.ticks_hourly(a.ticks_dense(spark, sf_dir))
)
_register("rollup_transactions_hourly", ROLLUP_SQL["transactions_hourly"])(
    lambda spark, sf_dir: rollups.transactions_hourly(a.transactions_dense(spark, sf_dir))
)
_register(
    "rollup_transactions_hourly_live",
    f"{_DENSE} {HOURLY_TRANSACTIONS} WHERE version > 0 GROUP BY 1, 2",
)(
    lambda spark, sf_dir: rollups.transactions_hourly(
        a.transactions_dense(spark, sf_dir), live_only=True
    )
)
_register("rollup_tick_tx_summary", ROLLUP_SQL["tick_tx_summary"])(
    lambda spark, sf_dir: rollups.tick_tx_summary(a.transactions_dense(spark, sf_dir))
)

# --- invalidation -------------------------------------------------------------------


@_register(
    "invalidated_transactions",
    f"""{_CHAIN}, {a.INVALIDATIONS},
last AS (SELECT tick_number, max(moment) AS moment FROM invalidations GROUP BY 1)
SELECT t.tick_number, t.sequence_number, t.tx_hash,
  CASE WHEN t.processed_at < l.moment THEN -1 ELSE t.version END AS version
FROM transactions t LEFT JOIN last l USING (tick_number)""",
)
def _invalidated(spark, sf_dir):
    rows = a.transactions_chain(spark, sf_dir).select(
        "tick_number", "sequence_number", "tx_hash", "version", "processed_at"
    )
    return reorg.apply_invalidations(rows, a.invalidations(spark, sf_dir)).drop("processed_at")
