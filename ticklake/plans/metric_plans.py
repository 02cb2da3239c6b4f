"""Health, progress, flush and rate measures."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ticklake.operators import metrics as m
from ticklake.plans import adapters as a

NOW = datetime(2024, 1, 15, 12, 0)


def _health(spark, sf_dir):
    log = a.poll_log(spark, sf_dir)
    return m.poll_health(m.error_runs(log), log.select("source_id", "market_id"))


def _runs(spark, sf_dir):
    log = a.poll_log(spark, sf_dir).select("source_id", "ts", "ok", "error", "arrival")
    return m.error_runs(log, ("ts", "arrival")).drop("error")


QUERIES = {
    "poll_health": _health,
    "error_categories": lambda s, d: a.poll_log(s, d)
    .filter(~F.col("ok"))
    .groupBy("source_id", m.error_category(F.col("error")).alias("category"))
    .agg(F.count(F.lit(1)).alias("errors")),
    "error_runs": _runs,
    "progress_history": lambda s, d: m.progress_history(a.progress(s, d)),
    "progress_stats": lambda s, d: m.progress_stats(m.progress_history(a.progress(s, d))),
    "flush_means": lambda s, d: m.flush_means(a.flush_log(s, d)),
    "flush_ema": lambda s, d: m.flush_ema(a.flush_log(s, d)),
    "flush_means_real": lambda s, d: m.flush_means(a.flush_real(s, d)),
    "flush_ema_real": lambda s, d: m.flush_ema(a.flush_real(s, d)),
    "retry_split": lambda s, d: m.retry_decision(a.dead_letter(s, d), NOW, max_age=m.MAX_AGE * 2000),
    "rate_limited": lambda s, d: m.admit(a.visits(s, d), 1 / 3600, 2),
}

_RUNS = f"""WITH {a.POLL_LOG},
placed AS (SELECT *, row_number() OVER w AS place FROM poll_log
  WINDOW w AS (PARTITION BY source_id ORDER BY ts, arrival)),
runs AS (SELECT *, place - coalesce(max(CASE WHEN ok THEN place END) OVER (PARTITION BY source_id
  ORDER BY place ROWS UNBOUNDED PRECEDING), 0) AS run FROM placed)"""

_HISTORY = f"""WITH {a.PROGRESS}, compared AS (SELECT *, coalesce(max(tick_number) OVER (
    PARTITION BY source_id ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS before FROM progress),
history AS (SELECT source_id, arrival, tick_number, updated_at FROM compared
  WHERE tick_number > before)"""

SQL = {
    "poll_health": f"""{_RUNS}
SELECT source_id, count(DISTINCT market_id) AS markets, count(*) FILTER (ok) AS success,
  count(*) FILTER (NOT ok) AS errors,
  count(*) FILTER (ok) / count(*) * 100.0 AS success_rate,
  arg_max(run, place) AS consecutive_errors FROM runs GROUP BY source_id""",
    "error_categories": f"""WITH {a.POLL_LOG}
SELECT source_id, CASE WHEN contains(error, 'HTTP_REQUEST_FAILED') THEN 'NETWORK'
    WHEN contains(error, 'database insert errors') THEN 'DATABASE'
    WHEN contains(error, 'JSON_DECODE_ERROR') THEN 'PARSING' ELSE 'UNKNOWN' END AS category,
  count(*) AS errors FROM poll_log WHERE NOT ok GROUP BY 1, 2""",
    "error_runs": f"""{_RUNS}
SELECT source_id, ts, ok, arrival, run, CASE run WHEN 3 THEN 'WARNING' WHEN 5 THEN 'WARNING'
  WHEN 10 THEN 'ALERT' WHEN 20 THEN 'CRITICAL' END AS alert FROM runs""",
    "progress_history": f"{_HISTORY} SELECT * FROM history",
    "progress_stats": f"""{_HISTORY}
SELECT source_id, max(tick_number) AS last_tick_number, count(*) AS total_checkpoints,
  arg_min(tick_number, arrival) AS oldest_tick,
  arg_min(updated_at, arrival) AS oldest_checkpoint_time,
  arg_max(tick_number, arrival) AS newest_tick,
  arg_max(updated_at, arrival) AS newest_checkpoint_time FROM history GROUP BY source_id""",
    "flush_means": f"""WITH {a.FLUSH_LOG}
SELECT query_id, seq, duration_ms, count(*) OVER w AS flush_count,
  CAST(sum(duration_ms) OVER w AS DOUBLE) / count(*) OVER w AS average_ms FROM flush_log
WINDOW w AS (PARTITION BY query_id ORDER BY seq ROWS UNBOUNDED PRECEDING)""",
    "flush_ema": f"""WITH RECURSIVE {a.FLUSH_LOG},
numbered AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY seq) AS rn FROM flush_log),
walk AS (
  SELECT query_id, seq, duration_ms, rn, CAST(duration_ms AS DOUBLE) AS ema_ms FROM numbered
  WHERE rn = 1
  UNION ALL
  SELECT n.query_id, n.seq, n.duration_ms, n.rn,
    0.9::DOUBLE * w.ema_ms + 0.1::DOUBLE * CAST(n.duration_ms AS DOUBLE)
  FROM walk w JOIN numbered n ON n.query_id = w.query_id AND n.rn = w.rn + 1)
SELECT query_id, seq, duration_ms, ema_ms FROM walk""",
    "flush_means_real": f"""WITH {a.FLUSH_REAL}
SELECT query_id, seq, duration_ms, count(*) OVER w AS flush_count,
  CAST(sum(CAST(duration_ms AS DECIMAL(28,9))) OVER w AS DOUBLE) / count(*) OVER w AS average_ms
FROM flush_log WINDOW w AS (PARTITION BY query_id ORDER BY seq ROWS UNBOUNDED PRECEDING)""",
    "flush_ema_real": f"""WITH RECURSIVE {a.FLUSH_REAL},
numbered AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY seq) AS rn FROM flush_log),
walk AS (
  SELECT query_id, seq, duration_ms, rn, CAST(duration_ms AS DOUBLE) AS ema_ms FROM numbered
  WHERE rn = 1
  UNION ALL
  SELECT n.query_id, n.seq, n.duration_ms, n.rn,
    0.9::DOUBLE * w.ema_ms + 0.1::DOUBLE * CAST(n.duration_ms AS DOUBLE)
  FROM walk w JOIN numbered n ON n.query_id = w.query_id AND n.rn = w.rn + 1)
SELECT query_id, seq, duration_ms, ema_ms FROM walk""",
    "retry_split": f"""WITH {a.DEAD_LETTER}, judged AS (
  SELECT *, CASE WHEN retry_count >= 3 THEN 'attempts'
    WHEN TIMESTAMP '{NOW}' - first_attempt > INTERVAL 10000 MINUTE THEN 'age' END AS dropped
  FROM dead_letter)
SELECT id, CASE WHEN dropped IS NULL THEN retry_count + 1 ELSE retry_count END AS retry_count,
  first_attempt, CASE WHEN dropped IS NULL THEN TIMESTAMP '{NOW}' ELSE last_attempt END
  AS last_attempt, dropped FROM judged""",
    "rate_limited": """WITH RECURSIVE numbered AS (
  SELECT user_id AS key, ts, event_id, epoch_us(ts) AS us, row_number() OVER (
    PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
walk AS (
  SELECT key, ts, event_id, us, rn, CAST(1 AS DOUBLE) AS tokens, true AS admitted FROM numbered
  WHERE rn = 1
  UNION ALL
  SELECT key, ts, event_id, us, rn, CASE WHEN filled >= 1 THEN filled - 1 ELSE filled END,
    filled >= 1
  FROM (SELECT n.*, least(w.tokens + CAST(n.us - w.us AS DOUBLE) / 1000000
      * (1::DOUBLE / 3600), 2) AS filled
    FROM walk w JOIN numbered n ON n.key = w.key AND n.rn = w.rn + 1))
SELECT key, ts, event_id, admitted FROM walk""",
}
