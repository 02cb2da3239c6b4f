"""Domain tables derived from the shared test tables, once for Spark and once as SQL.

Every adapter is a plain projection (or a combinable aggregation) of a whole table, so
its cost grows with that table and nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(table: DataFrame) -> DataFrame:
    """A table read in fewer parts than there are cores, spread over the cores: the test
    tables are one file each, and costly row-wise work on them would run in one task. Larger
    tables, also in one file, and streams are left as they are."""
    if table.isStreaming:
        return table
    cores = table.sparkSession.sparkContext.defaultParallelism
    if len(table.inputFiles()) >= cores or table.rdd.getNumPartitions() >= cores:
        return table
    return table.repartition(cores)


def micros(ts: str) -> Column:
    """Microseconds since the epoch of a timestamp without time zone."""
    return F.unix_micros(F.col(ts).cast("timestamp"))


def sha(*parts: Column | str) -> Column:
    return F.sha2(F.concat(*parts), 256)


# --- events -------------------------------------------------------------------------

MARKET_PRICES = """market_prices AS (
  SELECT event_type AS market_id, ts, CAST(value AS DECIMAL(18,8)) AS price FROM events)"""


def market_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        F.col("event_type").alias("market_id"),
        "ts",
        F.col("value").cast("decimal(18,8)").alias("price"),
    )


OBSERVED_PRICES = """observed AS (
  SELECT event_type AS market_id, ts AS poll_time, floor(value / 10) AS price,
    event_id AS arrival FROM events)"""


def observed_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coarse prices, so that runs of equal prices and zeros occur."""
    return read(spark, sf_dir, "events").select(
        F.col("event_type").alias("market_id"),
        F.col("ts").alias("poll_time"),
        F.floor(F.col("value") / 10).cast("double").alias("price"),
        F.col("event_id").alias("arrival"),
    )


POLLS = """polls AS (
  SELECT event_id AS arrival, ts AS poll_time, user_id AS n, value,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE 1704067200 + event_id END AS engine FROM events)"""


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots as JSON text: a perpetual, a spot market and one without a price."""
    engine = F.when(F.col("event_id") % 3 == 0, F.lit("null")).otherwise(
        (F.lit(1704067200) + F.col("event_id")).cast("string")
    )
    body = F.concat(
        F.lit('[{"uuid":"m'), F.col("user_id").cast("string"),
        F.lit('","kind":"perp","perp_state":{"mark_price":'), F.col("value").cast("string"),
        F.lit(',"mark_price_timestamp":'), engine,
        F.lit('}},{"uuid":"s1","kind":"spot"},{"uuid":"e'), F.col("user_id").cast("string"),
        F.lit('","kind":"perp","perp_state":{"mark_price":null}},'),
        F.lit('{"uuid":"n1","kind":"perp","perp_state":null}]'),
    )
    broken = F.when(F.col("event_id") % 50 == 7, F.lit("<html>")).otherwise(body)
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("arrival"), F.col("ts").alias("poll_time"), broken.alias("body")
    )


TRANSACTIONS_DENSE = """transactions AS (
  SELECT epoch_us(ts) // 60000000 AS tick_number, event_id AS sequence_number,
    sha256('tx_' || event_id) AS tx_hash, 'id_' || event_id AS tx_id, user_id AS nonce,
    encode(props) AS payload, epoch_us(ts) AS timestamp_us,
    encode(CAST(user_id AS VARCHAR)) AS public_key, encode(sha256('sig_' || event_id)) AS signature,
    epoch_us(ts) + 5 AS ingestion_timestamp, ts AS processed_at,
    CAST(octet_length(encode(props)) AS INTEGER) AS payload_size, event_type AS payload_type,
    CASE WHEN event_id % 17 = 0 THEN -1 ELSE 1 END AS version FROM events)"""


def transactions_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    text = event.cast("string")
    return read(spark, sf_dir, "events").select(
        F.floor(micros("ts") / 60000000).alias("tick_number"),
        event.alias("sequence_number"),
        sha(F.lit("tx_"), text).alias("tx_hash"),
        F.concat(F.lit("id_"), text).alias("tx_id"),
        F.col("user_id").alias("nonce"),
        F.encode("props", "UTF-8").alias("payload"),
        micros("ts").alias("timestamp_us"),
        F.encode(F.col("user_id").cast("string"), "UTF-8").alias("public_key"),
        F.encode(sha(F.lit("sig_"), text), "UTF-8").alias("signature"),
        (micros("ts") + 5).alias("ingestion_timestamp"),
        F.col("ts").alias("processed_at"),
        F.octet_length("props").alias("payload_size"),
        F.col("event_type").alias("payload_type"),
        F.when(event % 17 == 0, -1).otherwise(1).alias("version"),
    )


# The same with processed_at drawn together to 30 hours, for tables with hourly folders.
TRANSACTIONS_SQUEEZED = TRANSACTIONS_DENSE.replace(
    "ts AS processed_at",
    "make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 24) AS processed_at",
)


def transactions_squeezed(spark: SparkSession, sf_dir: str) -> DataFrame:
    origin = F.lit(1704067200000000)
    squeezed = F.timestamp_micros(origin + F.floor((micros("processed_at") - origin) / 24))
    return transactions_dense(spark, sf_dir).withColumn(
        "processed_at", squeezed.cast("timestamp_ntz")
    )


TICKS_DENSE = """ticks AS (
  SELECT epoch_us(ts) // 60000000 AS tick_number, max(epoch_us(ts)) AS timestamp_us,
    CAST(count(*) AS INTEGER) AS tx_count, max(ts) AS processed_at, 1 AS version,
    CAST(CASE WHEN (epoch_us(ts) // 60000000) % 7 = 0 THEN 0 ELSE 1000 END AS BIGINT)
      AS vdf_iterations
  FROM events GROUP BY epoch_us(ts) // 60000000)"""


def ticks_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.floor(micros("ts") / 60000000)
    return (
        read(spark, sf_dir, "events")
        .groupBy(number.alias("tick_number"))
        .agg(
            F.max(micros("ts")).alias("timestamp_us"),
            F.count(F.lit(1)).cast("int").alias("tx_count"),
            F.max("ts").alias("processed_at"),
        )
        .withColumns(
            {
                "version": F.lit(1),
                "vdf_iterations": F.when(F.col("tick_number") % 7 == 0, 0)
                .otherwise(1000)
                .cast("bigint"),
            }
        )
    )


POLL_LOG = """poll_log AS (
  SELECT 's' || (user_id % 7) AS source_id, ts, event_type IN ('view', 'signup') AS ok,
    CASE event_id % 4 WHEN 0 THEN 'HTTP_REQUEST_FAILED after 3s' WHEN 1 THEN 'JSON_DECODE_ERROR'
      WHEN 2 THEN '2 database insert errors occurred' ELSE 'other' END AS error,
    event_id AS arrival, event_type AS market_id FROM events)"""


def poll_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_id") % 4
    return read(spark, sf_dir, "events").select(
        F.concat(F.lit("s"), (F.col("user_id") % 7).cast("string")).alias("source_id"),
        "ts",
        F.col("event_type").isin("view", "signup").alias("ok"),
        F.when(kind == 0, "HTTP_REQUEST_FAILED after 3s")
        .when(kind == 1, "JSON_DECODE_ERROR")
        .when(kind == 2, "2 database insert errors occurred")
        .otherwise("other")
        .alias("error"),
        F.col("event_id").alias("arrival"),
        F.col("event_type").alias("market_id"),
    )


FLUSH_LOG = """flush_log AS (
  SELECT 'q' || user_id AS query_id, event_id AS seq,
    CAST(floor(value * 100) AS BIGINT) AS duration_ms FROM events)"""


def flush_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        F.concat(F.lit("q"), F.col("user_id").cast("string")).alias("query_id"),
        F.col("event_id").alias("seq"),
        F.floor(F.col("value") * 100).alias("duration_ms"),
    )


FLUSH_REAL = """flush_log AS (
  SELECT 'q' || user_id AS query_id, event_id AS seq, value / 7 AS duration_ms FROM events)"""


def flush_real(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations that no short decimal can write."""
    return read(spark, sf_dir, "events").select(
        F.concat(F.lit("q"), F.col("user_id").cast("string")).alias("query_id"),
        F.col("event_id").alias("seq"),
        (F.col("value") / 7).alias("duration_ms"),
    )


DEAD_LETTER = """dead_letter AS (
  SELECT event_id AS id, CAST(event_id % 5 AS INTEGER) AS retry_count, ts AS first_attempt,
    ts AS last_attempt FROM events)"""


def dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        (F.col("event_id") % 5).cast("int").alias("retry_count"),
        F.col("ts").alias("first_attempt"),
        F.col("ts").alias("last_attempt"),
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events keyed by user, for the token bucket."""
    return read(spark, sf_dir, "events").select(F.col("user_id").alias("key"), "ts", "event_id")


# --- orders and lineitem ------------------------------------------------------------

TICKS_CHAIN = """ticks AS (
  SELECT o_orderkey + 1 AS tick_number, epoch_us(o_orderdate) AS timestamp_us,
    sha256('in_' || o_orderkey) AS vdf_input, sha256('out_' || o_orderkey) AS vdf_output,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'proof_' || o_orderkey END AS vdf_proof,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(1000 AS BIGINT) END AS vdf_iterations,
    sha256('batch_' || o_orderkey) AS transaction_batch_hash,
    sha256('out_' || (o_orderkey - 1)) AS previous_output,
    CAST(o_orderkey % 6 AS INTEGER) AS tx_count, o_orderdate AS processed_at,
    CASE WHEN o_orderkey % 17 = 0 THEN -1 ELSE 1 END AS version FROM orders)"""


def ticks_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    text = key.cast("string")
    proven = key % 5 != 0
    return read(spark, sf_dir, "orders").select(
        (key + 1).alias("tick_number"),
        micros("o_orderdate").alias("timestamp_us"),
        sha(F.lit("in_"), text).alias("vdf_input"),
        sha(F.lit("out_"), text).alias("vdf_output"),
        F.when(proven, F.concat(F.lit("proof_"), text)).alias("vdf_proof"),
        F.when(proven, F.lit(1000).cast("bigint")).alias("vdf_iterations"),
        sha(F.lit("batch_"), text).alias("transaction_batch_hash"),
        sha(F.lit("out_"), (key - 1).cast("string")).alias("previous_output"),
        (key % 6).cast("int").alias("tx_count"),
        F.col("o_orderdate").alias("processed_at"),
        F.when(key % 17 == 0, -1).otherwise(1).alias("version"),
    )


TRANSACTIONS_CHAIN = """transactions AS (
  SELECT l_orderkey + 1 AS tick_number, CAST(l_linenumber AS BIGINT) AS sequence_number,
    sha256(concat_ws('_', l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CAST(floor(l_extendedprice * 100) AS BIGINT))) AS tx_hash,
    'id_' || l_orderkey || '_' || l_linenumber AS tx_id, l_partkey AS nonce,
    CASE WHEN l_discount = 0 THEN encode('') ELSE
      encode(repeat('x', CAST(l_quantity AS INTEGER) * 25)) END AS payload,
    epoch_us(l_shipdate) AS timestamp_us, encode(sha256('key_' || l_suppkey)) AS public_key,
    encode(sha256('sig_' || l_partkey)) AS signature,
    epoch_us(l_shipdate) + 5 AS ingestion_timestamp, l_shipdate AS processed_at,
    CASE WHEN l_discount = 0 THEN 0 ELSE CAST(l_quantity AS INTEGER) * 25 END AS payload_size,
    CAST(NULL AS VARCHAR) AS payload_type,
    CASE WHEN l_partkey % 17 = 0 THEN -1 ELSE 1 END AS version FROM lineitem)"""


def transactions_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with repeated (tick, sequence number) keys, as lineitem has them."""
    size = F.when(F.col("l_discount") == 0, 0).otherwise(F.col("l_quantity").cast("int") * 25)
    texts = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    price = F.floor(F.col("l_extendedprice") * 100).cast("string")
    return spread(read(spark, sf_dir, "lineitem")).select(
        (F.col("l_orderkey") + 1).alias("tick_number"),
        F.col("l_linenumber").cast("bigint").alias("sequence_number"),
        F.sha2(F.concat_ws("_", *texts, price), 256).alias("tx_hash"),
        F.concat(F.lit("id_"), texts[0], F.lit("_"), texts[1]).alias("tx_id"),
        F.col("l_partkey").alias("nonce"),
        F.encode(F.repeat(F.lit("x"), size), "UTF-8").alias("payload"),
        micros("l_shipdate").alias("timestamp_us"),
        F.encode(sha(F.lit("key_"), texts[3]), "UTF-8").alias("public_key"),
        F.encode(sha(F.lit("sig_"), texts[2]), "UTF-8").alias("signature"),
        (micros("l_shipdate") + 5).alias("ingestion_timestamp"),
        F.col("l_shipdate").alias("processed_at"),
        size.alias("payload_size"),
        F.lit(None).cast("string").alias("payload_type"),
        F.when(F.col("l_partkey") % 17 == 0, -1).otherwise(1).alias("version"),
    )


# Nested ticks: one per order, with (key mod 6) entries made from the order's own row.
# All rules of the checks are broken somewhere. ``entries`` is the exploded form in SQL.
NESTED = """raw AS (
  SELECT o_orderkey AS k, 's' || (o_custkey % 10) AS source_id, o_orderkey AS arrival,
    CASE WHEN o_orderkey % 97 = 0 THEN o_orderkey + 5000
      WHEN o_orderkey % 71 = 0 THEN greatest(o_orderkey - 300, 0)
      ELSE o_orderkey + 1 END AS tick_number,
    o_orderkey % 17 <> 0 AS proven,
    CASE WHEN o_orderkey % 37 = 0 THEN '' WHEN o_orderkey % 41 = 0 THEN 'zz'
      ELSE sha256('in_' || o_orderkey) END AS p_input,
    CASE WHEN o_orderkey % 83 = 0 THEN 'not hex' ELSE sha256('out_' || o_orderkey) END AS p_output,
    CASE WHEN o_orderkey % 43 = 0 THEN '' ELSE 'proof_' || o_orderkey END AS p_proof,
    CAST(CASE WHEN o_orderkey % 47 = 0 THEN 0 WHEN o_orderkey % 53 = 0 THEN 2000000
      ELSE 1000 END AS BIGINT) AS p_iterations,
    CASE WHEN o_orderkey % 61 = 0 THEN '' ELSE sha256('batch_' || o_orderkey) END AS batch,
    CASE WHEN o_orderkey % 59 = 0 THEN 0 ELSE 1704067200000000 + o_orderkey * 1000
      + CASE WHEN o_orderkey % 67 = 0 THEN 172800000000 WHEN o_orderkey % 73 = 0
        THEN -172800000000 ELSE 0 END END AS ts_us,
    CASE WHEN o_orderkey % 79 = 0 THEN '' ELSE sha256('out_' || (o_orderkey - 1)) END AS previous,
    CAST(o_orderkey % 6 AS INTEGER) AS n FROM orders),
entries AS (
  SELECT k, source_id, arrival, tick_number, CAST(i AS INTEGER) AS i, (k + i) % 31 = 0 AS gone,
    (k + i) % 23 = 0 AS hollow,
    CAST(CASE WHEN k % 11 = 0 AND i = 2 THEN 1 ELSE i + 1 END AS BIGINT) AS seq,
    CASE WHEN (k + i) % 7 = 0 THEN '' WHEN (k + i) % 13 = 0 THEN 'bad_hash'
      ELSE sha256('h_' || k || '_' || i) END AS tx_hash,
    CASE WHEN (k + i) % 19 = 0 THEN '' ELSE 'tx_' || k || '_' || i END AS tx_id,
    repeat('p', CAST((k + i) % 40 AS INTEGER)) AS body,
    repeat('s', CASE WHEN (k + i) % 29 = 0 THEN 10 WHEN (k + i) % 5 = 0 THEN 0 ELSE 64 END) AS sig,
    repeat('k', CASE WHEN (k + i) % 37 = 0 THEN 5 ELSE 32 END) AS pub,
    k AS nonce, CASE WHEN (k + i) % 27 = 0 THEN 0 ELSE 1704067200000000 + k END AS tx_time,
    1704067200000005 + k AS ingested
  FROM (SELECT *, unnest(range(n)) AS i FROM raw))"""


def nested_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    text = k.cast("string")

    def mod(number: int) -> Column:
        return k % number == 0

    def entry(i: Column) -> Column:
        at = k + i
        place = F.concat(text, F.lit("_"), i.cast("string"))
        body = F.struct(
            F.when(at % 19 == 0, "").otherwise(F.concat(F.lit("tx_"), place)).alias("tx_id"),
            F.encode(F.repeat(F.lit("p"), (at % 40).cast("int")), "UTF-8").alias("payload"),
            F.encode(
                F.repeat(F.lit("s"), F.when(at % 29 == 0, 10).when(at % 5 == 0, 0).otherwise(64)),
                "UTF-8",
            ).alias("signature"),
            F.encode(F.repeat(F.lit("k"), F.when(at % 37 == 0, 5).otherwise(32)), "UTF-8").alias(
                "public_key"
            ),
            k.alias("nonce"),
            F.when(at % 27 == 0, F.lit(0)).otherwise(k + 1704067200000000).alias("timestamp"),
        )
        return F.when(
            at % 31 != 0,
            F.struct(
                F.when(at % 23 != 0, body).alias("transaction"),
                F.when(mod(11) & (i == 2), F.lit(1)).otherwise(i + 1).cast("bigint").alias(
                    "sequence_number"
                ),
                F.when(at % 7 == 0, "")
                .when(at % 13 == 0, "bad_hash")
                .otherwise(sha(F.lit("h_"), place))
                .alias("tx_hash"),
                (k + 1704067200000005).alias("ingestion_timestamp"),
            ),
        )

    places = F.filter(F.sequence(F.lit(0), F.lit(5)), lambda i: i < k % 6)
    proof = F.struct(
        F.when(mod(37), "").when(mod(41), "zz").otherwise(sha(F.lit("in_"), text)).alias("input"),
        F.when(mod(83), "not hex").otherwise(sha(F.lit("out_"), text)).alias("output"),
        F.when(mod(43), "").otherwise(F.concat(F.lit("proof_"), text)).alias("proof"),
        F.when(mod(47), 0).when(mod(53), 2000000).otherwise(1000).cast("bigint").alias("iterations"),
    )
    shift = F.when(mod(67), 172800000000).when(mod(73), -172800000000).otherwise(0)
    return spread(read(spark, sf_dir, "orders")).select(
        F.concat(F.lit("s"), (F.col("o_custkey") % 10).cast("string")).alias("source_id"),
        k.alias("arrival"),
        F.when(mod(97), k + 5000)
        .when(mod(71), F.greatest(k - 300, F.lit(0)))
        .otherwise(k + 1)
        .alias("tick_number"),
        F.when(~mod(17), proof).alias("vdf_proof"),
        F.transform(places, entry).alias("transactions"),
        F.when(mod(61), "").otherwise(sha(F.lit("batch_"), text)).alias("transaction_batch_hash"),
        F.when(mod(59), 0)
        .otherwise(F.lit(1704067200000000) + k * 1000 + shift)
        .alias("timestamp"),
        F.when(mod(79), "")
        .otherwise(sha(F.lit("out_"), (k - 1).cast("string")))
        .alias("previous_output"),
    )


COPIES = """copies AS (
  SELECT 's' || (o_custkey % 10) AS source_id, o_orderkey + c * 1000000000000 AS arrival,
    o_orderkey + 1 AS tick_number,
    CASE WHEN o_orderkey % 7 = 0 AND c IN (0, 2) THEN NULL
      ELSE sha256('out_' || o_orderkey || CASE WHEN c IN (1, 3) AND o_orderkey % 13 = 0
        THEN '_x' ELSE '' END) END AS output,
    sha256('batch_' || o_orderkey || CASE WHEN c = 2 AND o_orderkey % 26 = 0 THEN '_x' ELSE '' END)
      AS batch_hash,
    sha256('out_' || (o_orderkey - 1) || CASE WHEN c = 1 AND o_orderkey % 39 = 0 THEN '_x'
      ELSE '' END) AS previous_output,
    CAST(o_orderkey % 6 + CASE WHEN c = 3 AND o_orderkey % 52 = 0 THEN 1 ELSE 0 END AS INTEGER)
      AS tx_count
  FROM orders, (SELECT unnest(range(4)) AS c)
  WHERE c = 0 OR o_orderkey % 13 = 0 OR o_orderkey % 10 = c)"""


def tick_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comparable tick rows, some sent again up to three times, equal or not."""
    k, c = F.col("o_orderkey"), F.col("c")
    text = k.cast("string")

    def marked(condition: Column) -> Column:
        return F.when(condition, "_x").otherwise("")

    sent = F.filter(
        F.sequence(F.lit(0), F.lit(3)), lambda c: (c == 0) | (k % 13 == 0) | (k % 10 == c)
    )
    return (
        read(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", F.explode(sent).alias("c"))
        .select(
            F.concat(F.lit("s"), (F.col("o_custkey") % 10).cast("string")).alias("source_id"),
            (k + c * F.lit(1000000000000)).alias("arrival"),
            (k + 1).alias("tick_number"),
            F.when(
                ~((k % 7 == 0) & c.isin(0, 2)),
                sha(F.lit("out_"), text, marked(c.isin(1, 3) & (k % 13 == 0))),
            ).alias("output"),
            sha(F.lit("batch_"), text, marked((c == 2) & (k % 26 == 0))).alias("batch_hash"),
            sha(F.lit("out_"), (k - 1).cast("string"), marked((c == 1) & (k % 39 == 0))).alias(
                "previous_output"
            ),
            (k % 6 + F.when((c == 3) & (k % 52 == 0), 1).otherwise(0)).cast("int").alias("tx_count"),
        )
    )


INVALIDATIONS = """invalidations AS (
  SELECT o_orderkey + 1 AS tick_number, o_orderdate + INTERVAL 60 DAY AS moment
  FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT o_orderkey + 1, o_orderdate + INTERVAL 30 DAY FROM orders WHERE o_orderkey % 2 = 0)"""


def invalidations(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    key, day = F.col("o_orderkey"), F.col("o_orderdate")

    def events(every: int, days: int) -> DataFrame:
        return orders.filter(key % every == 0).select(
            (key + 1).alias("tick_number"), (day + F.expr(f"INTERVAL {days} DAYS")).alias("at")
        )

    return events(3, 60).unionByName(events(2, 30))


PROGRESS = """progress AS (
  SELECT 'c' || (o_custkey % 20) AS source_id, o_orderkey AS arrival,
    (o_orderkey * 7919) % 100003 AS tick_number, o_orderdate AS updated_at FROM orders)"""


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        F.concat(F.lit("c"), (F.col("o_custkey") % 20).cast("string")).alias("source_id"),
        F.col("o_orderkey").alias("arrival"),
        ((F.col("o_orderkey") * 7919) % 100003).alias("tick_number"),
        F.col("o_orderdate").alias("updated_at"),
    )


SUBMISSIONS = """submissions AS (
  SELECT o_orderkey AS idx, CASE WHEN o_orderkey % 31 = 0 THEN '' ELSE 'tx' || o_orderkey END AS tx_id,
    encode('p' || o_orderkey) AS payload,
    CASE WHEN o_orderkey % 7 = 0 THEN 'xyz' WHEN o_orderkey % 11 = 0 THEN 'abc'
      ELSE sha256('sig_' || o_orderkey) END AS signature,
    'Key' || o_custkey AS public_key, o_orderkey % 29 AS nonce,
    CASE WHEN o_orderkey % 13 = 0 THEN '12x' WHEN o_orderkey % 17 = 0 THEN '-5'
      WHEN o_orderkey % 19 = 0 THEN '18446744073709551615'
      ELSE CAST(1704067200000000 + o_orderkey AS VARCHAR) END AS timestamp FROM orders)"""


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    text = key.cast("string")
    return read(spark, sf_dir, "orders").select(
        key.alias("idx"),
        F.when(key % 31 == 0, "").otherwise(F.concat(F.lit("tx"), text)).alias("tx_id"),
        F.encode(F.concat(F.lit("p"), text), "UTF-8").alias("payload"),
        F.when(key % 7 == 0, "xyz")
        .when(key % 11 == 0, "abc")
        .otherwise(sha(F.lit("sig_"), text))
        .alias("signature"),
        F.concat(F.lit("Key"), F.col("o_custkey").cast("string")).alias("public_key"),
        (key % 29).alias("nonce"),
        F.when(key % 13 == 0, "12x")
        .when(key % 17 == 0, "-5")
        .when(key % 19 == 0, "18446744073709551615")
        .otherwise((F.lit(1704067200000000) + key).cast("string"))
        .alias("timestamp"),
    )


# Payload bytes of every kind the decoder knows, from the event properties.
PAYLOADS = """payloads AS (
  SELECT event_id, CASE event_id % 8 WHEN 0 THEN '' WHEN 1 THEN 'FRM_v1.0:' || props
    WHEN 2 THEN 'FRM_v1.0:{broken' WHEN 3 THEN props WHEN 4 THEN CAST(event_id AS VARCHAR)
    WHEN 5 THEN 'plain ' || event_type WHEN 6 THEN '"' || event_type || '"' ELSE '[1, 2, ' || user_id || ']' END
    AS body FROM events)"""


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_id") % 8
    body = (
        F.when(kind == 0, "")
        .when(kind == 1, F.concat(F.lit("FRM_v1.0:"), "props"))
        .when(kind == 2, "FRM_v1.0:{broken")
        .when(kind == 3, F.col("props"))
        .when(kind == 4, F.col("event_id").cast("string"))
        .when(kind == 5, F.concat(F.lit("plain "), "event_type"))
        .when(kind == 6, F.concat(F.lit('"'), "event_type", F.lit('"')))
        .otherwise(F.concat(F.lit("[1, 2, "), F.col("user_id").cast("string"), F.lit("]")))
    )
    return spread(read(spark, sf_dir, "events")).select("event_id", body.alias("body"))
