"""Queries over reads: log store selection, positions, assignment, SQL views
(R1-R16, T1, T4)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.decode import decode
from ..plans.assign import balanced_tasks, modulo_task, writable_rank_tasks
from ..plans.positions import bounded, finished_shards, materialized, resolve_positions, shard_index
from ..sources.fixtures import events_index, events_log_store, events_shards, table
from ..sources.logstore import select_logstores
from ..sources.manifest import FileIndex
from ..sql import register_log_table, sink_records
from .base import with_events
from .registry import register

# Fixed query parameters (epoch seconds) and their SQL literals.
T_START, T_START_SQL = 1704499200, "TIMESTAMP '2024-01-06 00:00:00'"
T_STOP, T_STOP_SQL = 1705708800, "TIMESTAMP '2024-01-20 00:00:00'"
T_ASOF, T_ASOF_SQL = 1705968000, "TIMESTAMP '2024-01-23 00:00:00'"
CONSUMER_GROUP = "cg-events"


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_log_store(spark, sf_dir)


def read_summary(pos: DataFrame, read: DataFrame) -> DataFrame:
    """Per shard: where the read starts (and stops) and what it returns."""
    got = read.groupBy("logstore", "shard").agg(
        F.count(F.lit(1)).alias("n_groups"), F.sum(F.size("logs")).cast("long").alias("n_logs"))
    return (pos.join(got, ["logstore", "shard"], "left")
               .select("logstore", "shard", "start_seq", "stop_seq",
                       F.coalesce("n_groups", F.lit(0)).cast("long").alias("n_groups"),
                       F.coalesce("n_logs", F.lit(0)).cast("long").alias("n_logs")))


SUMMARY_SQL = """
SELECT p.logstore, p.shard, CAST(p.start_seq AS BIGINT) AS start_seq, CAST(p.stop_seq AS BIGINT) AS stop_seq,
       CAST(count(g.seq) AS BIGINT) AS n_groups, CAST(coalesce(sum(g.n_logs), 0) AS BIGINT) AS n_logs
FROM pos p LEFT JOIN groups g
  ON g.logstore = p.logstore AND g.shard = p.shard AND g.seq >= p.start_seq
 AND (p.stop_seq IS NULL OR g.seq < p.stop_seq)
GROUP BY p.logstore, p.shard, p.start_seq, p.stop_seq"""


def _first_at(cond: str, name: str) -> str:
    return (f"{name} AS (SELECT logstore, shard, min(seq) AS s FROM groups WHERE {cond} "
            f"GROUP BY logstore, shard)")


# ---------------------------------------------------------------- R1 R3 R4
SCAN_SCHEMA = "event_id bigint, user_id bigint, value double, __shard__ int, __topic__ string"


@register("scan_logs", with_events("""
SELECT CAST(event_id AS BIGINT) AS event_id, CAST(user_id AS BIGINT) AS user_id, value,
       shard AS __shard__, topic AS __topic__
FROM logs WHERE logstore = 'events-click'"""))
def scan_logs(spark, sf_dir):
    g = select_logstores(groups(spark, sf_dir), "events-click")
    return decode(g, SCAN_SCHEMA)


@register("scan_logstore_list", with_events("""
SELECT logstore, shard, CAST(count(*) AS BIGINT) AS n_logs, CAST(count(DISTINCT seq) AS BIGINT) AS n_groups
FROM logs WHERE logstore IN ('events-click', 'events-view')
GROUP BY logstore, shard"""))
def scan_logstore_list(spark, sf_dir):
    g = select_logstores(groups(spark, sf_dir), ["events-click", "events-view"])
    return (decode(g, "event_id bigint", keep=("logstore", "shard", "seq"))
            .groupBy("logstore", "shard")
            .agg(F.count(F.lit(1)).alias("n_logs"), F.countDistinct("seq").alias("n_groups")))


@register("scan_logstore_pattern", with_events("""
SELECT logstore, 'events-(click|view)' AS pattern, CAST(count(*) AS BIGINT) AS n_groups
FROM groups WHERE logstore IN ('events-click', 'events-view') GROUP BY logstore
UNION ALL
SELECT logstore, 'events-.*e.*' AS pattern, CAST(count(*) AS BIGINT) AS n_groups
FROM groups WHERE regexp_full_match(logstore, 'events-.*e.*') GROUP BY logstore"""))
def scan_logstore_pattern(spark, sf_dir):
    g = groups(spark, sf_dir)
    # 'click' alone would match no name: the pattern must cover the whole name
    out = None
    for pattern in ("events-(click|view)", "events-.*e.*", "click"):
        part = (select_logstores(g, pattern=pattern).groupBy("logstore")
                .agg(F.count(F.lit(1)).alias("n_groups"))
                .select("logstore", F.lit(pattern).alias("pattern"), "n_groups"))
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------- R5-R9
@register("start_earliest", with_events(SUMMARY_SQL, """
pos AS (SELECT logstore, shard, begin_seq AS start_seq, CAST(NULL AS BIGINT) AS stop_seq FROM shards)"""))
def start_earliest(spark, sf_dir):
    g = groups(spark, sf_dir)
    pos = resolve_positions(g, "begin_cursor", store=events_index(spark, sf_dir))
    pos, fits = materialized(pos)
    return read_summary(pos, bounded(g, pos, fits))


@register("start_latest_asof", with_events(SUMMARY_SQL, _first_at(f"cursor_time > {T_ASOF_SQL}", "lat"), """
pos AS (SELECT s.logstore, s.shard, coalesce(l.s, s.end_seq) AS start_seq, CAST(NULL AS BIGINT) AS stop_seq
        FROM shards s LEFT JOIN lat l USING (logstore, shard))"""))
def start_latest_asof(spark, sf_dir):
    g = groups(spark, sf_dir)
    pos = resolve_positions(g, "LATEST", as_of=T_ASOF, store=events_index(spark, sf_dir))
    pos, fits = materialized(pos)
    return read_summary(pos, bounded(g, pos, fits))


@register("start_timestamp", with_events(SUMMARY_SQL, _first_at(f"cursor_time >= {T_START_SQL}", "at_t"), """
pos AS (SELECT s.logstore, s.shard, coalesce(a.s, s.end_seq) AS start_seq, CAST(NULL AS BIGINT) AS stop_seq
        FROM shards s LEFT JOIN at_t a USING (logstore, shard))"""))
def start_timestamp(spark, sf_dir):
    g = groups(spark, sf_dir)
    pos = resolve_positions(g, str(T_START), store=events_index(spark, sf_dir))
    pos, fits = materialized(pos)
    return read_summary(pos, bounded(g, pos, fits))


def checkpoint_table(source: DataFrame | FileIndex) -> DataFrame:
    """A consumer group's committed positions, derived from the data: shards
    0 and 1 of every store committed half way (the other shards have none)."""
    idx = (shard_index(source) if isinstance(source, DataFrame) else source.shards()).where(F.col("shard") < 2)
    seq = F.call_function("div", F.col("begin_seq") + F.col("end_seq"), F.lit(2))
    return idx.select(F.lit(CONSUMER_GROUP).alias("consumer_group"), "logstore", "shard",
                      F.base64(seq.cast("string").cast("binary")).alias("cursor"),
                      F.lit(None).cast("long").alias("seq"),
                      F.lit(None).cast("timestamp_ntz").alias("updated_at"))


CHECKPOINT_SQL = """
cp AS (SELECT logstore, shard, (begin_seq + end_seq) // 2 AS s FROM shards WHERE shard < 2)"""


@register("start_checkpoint_fallback", with_events(
    SUMMARY_SQL, CHECKPOINT_SQL, _first_at(f"cursor_time >= {T_START_SQL}", "at_t"), """
pos AS (SELECT s.logstore, s.shard, coalesce(c.s, a.s, s.end_seq) AS start_seq, CAST(NULL AS BIGINT) AS stop_seq
        FROM shards s LEFT JOIN cp c USING (logstore, shard) LEFT JOIN at_t a USING (logstore, shard))"""))
def start_checkpoint_fallback(spark, sf_dir):
    g = groups(spark, sf_dir)
    store = events_index(spark, sf_dir)
    pos = resolve_positions(g, "consumer_from_checkpoint", checkpoints=checkpoint_table(store),
                            consumer_group=CONSUMER_GROUP, fallback=T_START, store=store)
    pos, fits = materialized(pos)
    return read_summary(pos, bounded(g, pos, fits))


@register("scan_stop_time", with_events(SUMMARY_SQL, _first_at(f"cursor_time >= {T_STOP_SQL}", "st"), """
pos AS (SELECT s.logstore, s.shard, s.begin_seq AS start_seq, coalesce(t.s, s.end_seq) AS stop_seq
        FROM shards s LEFT JOIN st t USING (logstore, shard))"""))
def scan_stop_time(spark, sf_dir):
    g = groups(spark, sf_dir)
    pos = resolve_positions(g, "earliest", stop_time=str(T_STOP), store=events_index(spark, sf_dir))
    pos, fits = materialized(pos)
    return read_summary(pos, bounded(g, pos, fits))


# ---------------------------------------------------------------- R12
def progress_table(store: FileIndex) -> DataFrame:
    """Next position per shard of a consumer, derived from the data: shards
    1 and 3 read to their end, shards 0 and 2 one group short."""
    idx = store.shards()
    nxt = F.when(F.col("shard") % 2 == 1, F.col("end_seq")).otherwise(F.col("end_seq") - 1)
    return idx.select("logstore", "shard", nxt.alias("next_seq"))


@register("finished_shards", with_events("""
SELECT s.logstore, s.shard, s.status, CAST(s.end_seq AS BIGINT) AS end_seq,
       CAST(CASE WHEN s.shard % 2 = 1 THEN s.end_seq ELSE s.end_seq - 1 END AS BIGINT) AS next_seq,
       s.status = 'readonly' AND (CASE WHEN s.shard % 2 = 1 THEN s.end_seq ELSE s.end_seq - 1 END) >= s.end_seq
         AS finished
FROM shards s"""))
def finished_shards_q(spark, sf_dir):
    return finished_shards(events_shards(spark, sf_dir), progress_table(events_index(spark, sf_dir)))


# ---------------------------------------------------------------- R14-R16
READERS = 3


@register("shard_bucket_modulo", with_events(f"""
SELECT logstore, shard, CAST(((shard % {READERS}) + {READERS}) % {READERS} AS INTEGER) AS task FROM shards"""))
def shard_bucket_modulo(spark, sf_dir):
    s = events_shards(spark, sf_dir)
    return s.select("logstore", "shard", modulo_task("shard", READERS).alias("task"))


@register("shard_bucket_balanced", with_events(f"""
SELECT logstore, shard,
       CAST((row_number() OVER (ORDER BY logstore, shard) - 1)
            // ((count(*) OVER () + {READERS} - 1) // {READERS}) AS INTEGER) AS task
FROM shards"""))
def shard_bucket_balanced(spark, sf_dir):
    s = events_shards(spark, sf_dir)
    return balanced_tasks(s, READERS).select("logstore", "shard", "task")


@register("shard_bucket_writable_rank", with_events(f"""
SELECT logstore, shard,
       CAST(CASE WHEN status = 'readonly' THEN shard % {READERS}
            ELSE (row_number() OVER (PARTITION BY logstore ORDER BY shard) - 1) % {READERS} END AS INTEGER) AS task
FROM shards"""))
def shard_bucket_writable_rank(spark, sf_dir):
    s = events_shards(spark, sf_dir)
    return writable_rank_tasks(s, READERS).select("logstore", "shard", "task")


# ---------------------------------------------------------------- T1 T4
VIEW_SCHEMA = ("event_id bigint, value double, ok boolean, attempt int, "
               "__topic__ string, __source__ string, __time__ timestamp_ntz")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log table declared by options and queried with SQL: per log store
    and topic, logs, distinct sources, retries and the value statistics."""
    register_log_table(spark, "events_log", VIEW_SCHEMA,
                       {"connector": "log", "logstore": "events-.*", "logstore.pattern": "true",
                        "scan.startup.mode": "earliest"},
                       groups=groups(spark, sf_dir), keep=("logstore",))
    return spark.sql("""
        SELECT logstore, __topic__ AS topic, count(*) AS n_logs,
               count(DISTINCT __source__) AS n_sources,
               sum(CASE WHEN attempt > 1 THEN 1 ELSE 0 END) AS retried,
               sum(CASE WHEN ok THEN 1 ELSE 0 END) AS n_ok,
               round(avg(value), 6) AS avg_value, max(value) AS max_value,
               min(__time__) AS first_time
        FROM events_log GROUP BY logstore, __topic__""")


@register("sql_over_log_view", with_events("""
SELECT logstore, topic, CAST(count(*) AS BIGINT) AS n_logs, CAST(count(DISTINCT source) AS BIGINT) AS n_sources,
       CAST(sum(CASE WHEN CAST(c_attempt AS INTEGER) > 1 THEN 1 ELSE 0 END) AS BIGINT) AS retried,
       CAST(sum(CASE WHEN lower(c_ok) = 'true' THEN 1 ELSE 0 END) AS BIGINT) AS n_ok,
       round(avg(value), 6) AS avg_value, max(value) AS max_value, min(ts) AS first_time
FROM logs GROUP BY logstore, topic"""))
def sql_over_log_view(spark, sf_dir):
    return flagship(spark, sf_dir)


@register("sink_rows_insert_only", """
SELECT CASE WHEN o_orderstatus = 'F' THEN 'orders-done' ELSE 'orders-open' END AS logstore,
       CAST(count(*) AS BIGINT) AS n_records, CAST(sum(6) AS BIGINT) AS n_contents
FROM orders GROUP BY 1""")
def sink_rows_insert_only(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "*", F.when(F.col("o_orderstatus") == "F", F.lit("orders-done")).alias("__logstore__"),
        F.lit("INSERT").alias("_change_type"))
    rec = sink_records(rows, {"logstore": "orders-open", "sink.topic": "orders"}, now_seconds=T_START)
    return rec.groupBy("logstore").agg(F.count(F.lit(1)).alias("n_records"),
                                       F.sum(F.size("contents")).cast("long").alias("n_contents"))


# ---------------------------------------------------------------- SQL over a log view
def _events_view(spark: SparkSession, sf_dir: str, name: str = "events_view") -> None:
    register_log_table(spark, name, "event_id bigint, user_id bigint, value double, __topic__ string",
                       {"logstore": "events-.*", "logstore.pattern": "true"},
                       groups=groups(spark, sf_dir), keep=("logstore",))


@register("view_enrichment_join", with_events("""
SELECT c.c_mktsegment AS segment, CAST(count(*) AS BIGINT) AS n_logs, round(sum(l.value), 4) AS total_value,
       CAST(count(DISTINCT l.user_id) AS BIGINT) AS n_users
FROM logs l JOIN customer c ON l.user_id = c.c_custkey
GROUP BY c.c_mktsegment"""))
def view_enrichment_join(spark, sf_dir):
    """Decoded logs joined with a dimension table (customer) in Spark SQL."""
    _events_view(spark, sf_dir)
    table(spark, sf_dir, "customer").createOrReplaceTempView("customer_dim")
    return spark.sql("""
        SELECT c.c_mktsegment AS segment, count(*) AS n_logs, round(sum(l.value), 4) AS total_value,
               count(DISTINCT l.user_id) AS n_users
        FROM events_view l JOIN customer_dim c ON l.user_id = c.c_custkey
        GROUP BY c.c_mktsegment""")


@register("view_topk_window", with_events("""
SELECT logstore, rk, CAST(event_id AS BIGINT) AS event_id, value FROM (
  SELECT logstore, event_id, value,
         CAST(row_number() OVER (PARTITION BY logstore ORDER BY value DESC, event_id) AS INTEGER) AS rk
  FROM logs) WHERE rk <= 3"""))
def view_topk_window(spark, sf_dir):
    """Top 3 values per log store (the limit is the report)."""
    _events_view(spark, sf_dir)
    return spark.sql("""
        SELECT logstore, rk, event_id, value FROM (
          SELECT logstore, event_id, value,
                 row_number() OVER (PARTITION BY logstore ORDER BY value DESC, event_id) AS rk
          FROM events_view) WHERE rk <= 3""")


@register("view_rollup", with_events("""
SELECT logstore, topic, CAST(count(*) AS BIGINT) AS n_logs, round(sum(value), 4) AS total_value
FROM logs GROUP BY ROLLUP (logstore, topic)"""))
def view_rollup(spark, sf_dir):
    """Subtotals per log store and topic, per log store, and in total."""
    _events_view(spark, sf_dir)
    return spark.sql("""
        SELECT logstore, __topic__ AS topic, count(*) AS n_logs, round(sum(value), 4) AS total_value
        FROM events_view GROUP BY ROLLUP (logstore, __topic__)""")
