"""Queries over progress, lag, streaming time and delivery checks
(W1, W4, W6-W8, A1-A3)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.audit import dedup_by, duplicate_summary, missing_and_unexpected
from ..operators.decode import decode, decode_logs, explode_logs, sequence_number
from ..plans.positions import bounded, resolve_positions
from ..sources.fixtures import events_index, events_log_store, table
from ..streaming.progress import consumer_lag, merge_commit, progress_time, source_timestamps
from .base import with_events
from .reads import (CHECKPOINT_SQL, CONSUMER_GROUP, T_ASOF_SQL, T_STOP, T_STOP_SQL, _first_at,
                    checkpoint_table)
from .registry import register

STOP_SQL = _first_at(f"cursor_time >= {T_STOP_SQL}", "st")
# the read before a restart: earliest up to the stop time; the read after it:
# from the committed position (else earliest) to the end
READ1_SQL = """
pos1 AS (SELECT s.logstore, s.shard, s.begin_seq AS start_seq, coalesce(t.s, s.end_seq) AS stop_seq
         FROM shards s LEFT JOIN st t USING (logstore, shard))"""
READ2_SQL = """
pos2 AS (SELECT s.logstore, s.shard, coalesce(c.s, s.begin_seq) AS start_seq, s.end_seq AS stop_seq
         FROM shards s LEFT JOIN cp c USING (logstore, shard))"""
COMMITTED_SQL = """
posc AS (SELECT s.logstore, s.shard, coalesce(c.s, s.begin_seq) AS start_seq, coalesce(t.s, s.end_seq) AS stop_seq
         FROM shards s LEFT JOIN cp c USING (logstore, shard) LEFT JOIN st t USING (logstore, shard)),
rd AS (SELECT g.logstore, g.shard, max(g.seq) + 1 AS s FROM groups g JOIN posc p USING (logstore, shard)
       WHERE g.seq >= p.start_seq AND g.seq < p.stop_seq GROUP BY g.logstore, g.shard),
committed AS (SELECT logstore, shard, max(s) AS s
              FROM (SELECT logstore, shard, s FROM cp UNION ALL SELECT logstore, shard, s FROM rd)
              GROUP BY logstore, shard)"""
COMMIT_AT = "2024-01-20 00:00:00"


def committed(spark, sf_dir):
    """The consumer group after reading from its checkpoint (else earliest)
    up to the stop time and committing."""
    g = events_log_store(spark, sf_dir)
    store = events_index(spark, sf_dir)
    cp = checkpoint_table(store)
    pos = resolve_positions(g, "checkpoint", stop_time=T_STOP, checkpoints=cp,
                            consumer_group=CONSUMER_GROUP, fallback="earliest", store=store)
    return g, merge_commit(cp, bounded(g, pos), CONSUMER_GROUP, updated_at=COMMIT_AT)


@register("commit_progress", with_events(f"""
SELECT '{CONSUMER_GROUP}' AS consumer_group, logstore, shard, CAST(s AS BIGINT) AS seq,
       to_base64(encode(CAST(s AS VARCHAR))) AS cursor
FROM committed""", CHECKPOINT_SQL, STOP_SQL, COMMITTED_SQL))
def commit_progress(spark, sf_dir):
    _, merged = committed(spark, sf_dir)
    return merged.select("consumer_group", "logstore", "shard", "seq", "cursor")


@register("consumer_progress", with_events(f"""
SELECT '{CONSUMER_GROUP}' AS consumer_group, c.logstore, c.shard, CAST(c.s AS BIGINT) AS next_seq,
       g.cursor_time AS progress_time
FROM committed c LEFT JOIN groups g ON g.logstore = c.logstore AND g.shard = c.shard AND g.seq = c.s - 1""",
    CHECKPOINT_SQL, STOP_SQL, COMMITTED_SQL))
def consumer_progress(spark, sf_dir):
    g, merged = committed(spark, sf_dir)
    return progress_time(merged, g, events_index(spark, sf_dir))


def _diff_s(a: str, b: str) -> str:
    return f"CAST(trunc((epoch_us({b}) - epoch_us({a})) / 1000000.0) AS BIGINT)"


@register("consumer_lag", with_events(f"""
SELECT '{CONSUMER_GROUP}' AS consumer_group, c.logstore, c.shard, CAST(c.s AS BIGINT) AS next_seq,
       g.cursor_time AS progress_time, CAST(s.end_seq - c.s AS BIGINT) AS groups_behind,
       {_diff_s('g.cursor_time', 'e.end_time')} AS write_lag_s,
       {_diff_s('g.cursor_time', T_ASOF_SQL)} AS fetch_lag_s
FROM committed c
LEFT JOIN groups g ON g.logstore = c.logstore AND g.shard = c.shard AND g.seq = c.s - 1
LEFT JOIN shards s ON s.logstore = c.logstore AND s.shard = c.shard
LEFT JOIN (SELECT logstore, shard, max(cursor_time) AS end_time FROM groups GROUP BY ALL) e
  ON e.logstore = c.logstore AND e.shard = c.shard""", CHECKPOINT_SQL, STOP_SQL, COMMITTED_SQL))
def consumer_lag_q(spark, sf_dir):
    g, merged = committed(spark, sf_dir)
    return consumer_lag(merged, g, now="2024-01-23 00:00:00", store=events_index(spark, sf_dir))


@register("source_timestamp", with_events("""
SELECT g.logstore, g.shard, g.seq, g.cursor_time, CAST(f.t AS BIGINT) * 1000 AS legacy_ts_ms
FROM groups g JOIN (SELECT logstore, shard, seq, arg_min(time, idx) AS t FROM logs GROUP BY ALL) f
  USING (logstore, shard, seq)"""))
def source_timestamp(spark, sf_dir):
    return source_timestamps(events_log_store(spark, sf_dir))


WINDOW_US = 6 * 3600 * 1000000


@register("log_rate_tumbling", with_events(f"""
SELECT logstore, make_timestamp((epoch_us(ts) // {WINDOW_US}) * {WINDOW_US}) AS window_start,
       CAST(count(*) AS BIGINT) AS n_logs, CAST(count(DISTINCT user_id) AS BIGINT) AS n_users
FROM logs GROUP BY ALL"""))
def log_rate_tumbling(spark, sf_dir):
    """Six-hour tumbling windows on the logs' own time per log store."""
    d = decode(events_log_store(spark, sf_dir), "user_id bigint, __time__ timestamp_ntz", keep=("logstore",))
    return (d.groupBy("logstore", F.window("__time__", "6 hours"))
             .agg(F.count(F.lit(1)).alias("n_logs"), F.countDistinct("user_id").alias("n_users"))
             .select("logstore", F.col("window.start").alias("window_start"), "n_logs", "n_users"))


# ---------------------------------------------------------------- A1-A3
def _reads(spark, sf_dir):
    """Two reads of the same stores: before a restart (earliest to the stop
    time) and after it (from the consumer group's checkpoint to the end)."""
    g = events_log_store(spark, sf_dir)
    store = events_index(spark, sf_dir)
    first = bounded(g, resolve_positions(g, "earliest", stop_time=T_STOP, store=store))
    second = bounded(g, resolve_positions(g, "checkpoint", checkpoints=checkpoint_table(store),
                                          consumer_group=CONSUMER_GROUP, fallback="earliest", store=store))
    return g, first, second


def _delivered(groups):
    lg = explode_logs(groups)
    return decode_logs(lg.withColumn("seq_no", sequence_number()), "event_id bigint", keep=("logstore", "seq_no"))


READ_LOGS_SQL = """
r1 AS (SELECT l.logstore, l.event_id, CAST(l.shard AS VARCHAR) || '|' || l.cursor || '|' || CAST(l.idx AS VARCHAR) AS seq_no
       FROM logs l JOIN pos1 p USING (logstore, shard) WHERE l.seq >= p.start_seq AND l.seq < p.stop_seq),
r2 AS (SELECT l.logstore, l.event_id, CAST(l.shard AS VARCHAR) || '|' || l.cursor || '|' || CAST(l.idx AS VARCHAR) AS seq_no
       FROM logs l JOIN pos2 p USING (logstore, shard) WHERE l.seq >= p.start_seq AND l.seq < p.stop_seq),
both_reads AS (SELECT * FROM r1 UNION ALL SELECT * FROM r2)"""


@register("delivery_missing", with_events("""
SELECT 'missing' AS kind, CAST(event_id AS BIGINT) AS event_id FROM events
WHERE event_id NOT IN (SELECT event_id FROM r1)""", STOP_SQL, CHECKPOINT_SQL, READ1_SQL, READ2_SQL, READ_LOGS_SQL))
def delivery_missing(spark, sf_dir):
    """A1: ids of ``events`` the read that stopped early did not deliver."""
    _, first, _ = _reads(spark, sf_dir)
    expected = table(spark, sf_dir, "events").select("event_id")
    return missing_and_unexpected(expected, _delivered(first).select("event_id"), "event_id")


@register("delivery_duplicates", with_events("""
SELECT logstore, CAST(count(*) AS BIGINT) AS reads, CAST(count(DISTINCT event_id) AS BIGINT) AS distinct_ids,
       CAST(count(*) - count(DISTINCT event_id) AS BIGINT) AS duplicates
FROM both_reads GROUP BY logstore""", STOP_SQL, CHECKPOINT_SQL, READ1_SQL, READ2_SQL, READ_LOGS_SQL))
def delivery_duplicates(spark, sf_dir):
    """A2: reads, distinct ids and duplicates per log store over a restart
    that replays from the committed position."""
    _, first, second = _reads(spark, sf_dir)
    both = _delivered(first).unionByName(_delivered(second))
    return duplicate_summary(both, "event_id", by=("logstore",))


@register("dedup_sequence", with_events("""
SELECT logstore, CAST(count(DISTINCT seq_no) AS BIGINT) AS n_logs, CAST(count(*) AS BIGINT) AS n_read
FROM both_reads GROUP BY logstore""", STOP_SQL, CHECKPOINT_SQL, READ1_SQL, READ2_SQL, READ_LOGS_SQL))
def dedup_sequence(spark, sf_dir):
    """A3: one row per sequence number after the replay."""
    _, first, second = _reads(spark, sf_dir)
    both = _delivered(first).unionByName(_delivered(second))
    read = both.groupBy("logstore").agg(F.count(F.lit(1)).alias("n_read"))
    kept = dedup_by(both, "seq_no").groupBy("logstore").agg(F.count(F.lit(1)).alias("n_logs"))
    return kept.join(read, "logstore")
