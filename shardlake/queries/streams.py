"""Queries over streams (R2, R7, R9-R11, R13, W2, W4, W5, K15, K16): each runs
its stream with ``availableNow`` over the derived log stores and returns what
it has delivered or committed."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.decode import decode, log_to_json
from ..session import ensure_checkpoint_dir
from ..sources.fixtures import events_log_root, events_log_store, events_shards
from ..sources.logstore import write_log_store
from ..sources.positions_source import end_when_finished, stream_groups
from ..sources.using import register_format
from ..plans.positions import seconds_ntz
from ..sql import insert_sql, register_log_table, stream_log_table
from ..streaming.dedup import dedup_positions, interval_state
from ..streaming.progress import current_positions
from ..streaming.stream import ProgressCommitter, batch_sink, finish, read_commits, stream_decoded, with_event_time
from .base import with_events
from .reads import T_ASOF, T_ASOF_SQL, T_START, T_START_SQL, T_STOP, T_STOP_SQL
from .registry import register

ROW = "event_id bigint, logstore string, shard int, seq long"


def _scratch(spark: SparkSession) -> str:
    """A new folder on the shared storage for one run."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/shardlake-streams/{uuid.uuid4().hex}"


def _deliver(spark: SparkSession, stream: DataFrame, folder: str, committer: ProgressCommitter | None = None) -> None:
    q = (stream.writeStream.foreachBatch(batch_sink(f"{folder}/out", committer=committer))
         .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start())
    finish(q, committer)


def _delivered(spark: SparkSession, folder: str, schema: str = ROW) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{folder}/out").select(*[c.split()[0] for c in schema.split(", ")])


DELIVERED_SQL = """
SELECT CAST(l.event_id AS BIGINT) AS event_id, l.logstore, l.shard, CAST(l.seq AS BIGINT) AS seq
FROM logs l JOIN groups g ON l.logstore = g.logstore AND l.shard = g.shard AND l.seq = g.seq"""


@register("stream_scan", with_events(DELIVERED_SQL))
def stream_scan(spark, sf_dir):
    """All groups, a few files for each trigger."""
    folder = _scratch(spark)
    options = {"project": events_log_root(spark, sf_dir), "logstore": "events-.*", "logstore.pattern": "true", "max.number.per.fetch": "8"}
    _deliver(spark, stream_log_table(spark, "event_id bigint", options, keep=("logstore", "shard", "seq")), folder)
    return _delivered(spark, folder)


@register("stream_stop_time", with_events(
    f"{DELIVERED_SQL} WHERE g.cursor_time >= {T_START_SQL} AND g.cursor_time < {T_STOP_SQL}"))
def stream_stop_time(spark, sf_dir):
    """From a start time up to a stop time."""
    folder = _scratch(spark)
    options = {"project": events_log_root(spark, sf_dir), "logstore": "events-.*", "logstore.pattern": "true",
               "scan.startup.mode": str(T_START), "stop.time": str(T_STOP)}
    _deliver(spark, stream_log_table(spark, "event_id bigint", options, keep=("logstore", "shard", "seq")), folder)
    return _delivered(spark, folder)


@register("stream_restart_latest", with_events(
    f"{DELIVERED_SQL} WHERE g.cursor_time >= {T_ASOF_SQL} OR l.logstore = 'events-error'"))
def stream_restart_latest(spark, sf_dir):
    """A stream that starts from the end, is stopped, and starts
    again after more groups, and a whole new log store, were written."""
    folder, groups = _scratch(spark), events_log_store(spark, sf_dir)
    root = f"{folder}/store"
    early = (F.col("cursor_time") < seconds_ntz(T_ASOF)) & (F.col("logstore") != "events-error")
    write_log_store(groups.where(early), root)

    def run() -> None:
        options = {"project": root, "logstore": "events-.*", "logstore.pattern": "true", "scan.startup.mode": "latest"}
        _deliver(spark, stream_log_table(spark, "event_id bigint", options, keep=("logstore", "shard", "seq"),
                                         state=f"{folder}/positions"), folder)

    run()
    write_log_store(groups.where(~early), root)
    run()
    return _delivered(spark, folder)


@register("commit_out_of_order", with_events("""
SELECT logstore, shard, CAST(0 AS BIGINT) AS late_only, CAST(least(max(seq) + 1, 2) AS BIGINT) AS with_gap,
       CAST(max(seq) + 1 AS BIGINT) AS all_read
FROM groups GROUP BY logstore, shard"""))
def commit_out_of_order(spark, sf_dir):
    """Positions after the groups from 3 on, then 0 and 1, then 2 were
    read and committed; a shard nothing was committed for is at 0."""
    folder, groups = f"{_scratch(spark)}/commits", events_log_store(spark, sf_dir)
    committer, out = ProgressCommitter(folder, "cg"), events_shards(spark, sf_dir).select("logstore", "shard")
    for b, (name, part) in enumerate((("late_only", "seq >= 3"), ("with_gap", "seq < 2"), ("all_read", "seq = 2"))):
        committer.commit(groups.where(part), b)
        at = current_positions(read_commits(spark, folder), "cg").select("logstore", "shard", F.col("seq").alias(name))
        # the table grows with the next commit: keep what it says now
        at.coalesce(1).write.parquet(f"{folder}-{name}")
        at = spark.read.schema(at.schema).parquet(f"{folder}-{name}")
        out = out.join(at, ["logstore", "shard"], "left").withColumn(name, F.coalesce(name, F.lit(0)).cast("long"))
    return out


@register("commit_after_crash", with_events("""
SELECT logstore, shard, (max(seq) + 3) // 3 AS before_crash, (max(seq) + 3) // 3 AS while_down, max(seq) + 1 AS recovered
FROM groups GROUP BY logstore, shard"""))
def commit_after_crash(spark, sf_dir):
    """Periodic commits of three reads (thirds of each shard).  The first
    is committed, the second held back when the process is lost, the third is
    read by a new one, which commits all."""
    folder, groups = f"{_scratch(spark)}/commits", events_log_store(spark, sf_dir)
    shards = events_shards(spark, sf_dir).select("logstore", "shard", F.expr("(end_seq + 2) div 3").alias("third"))
    cut = groups.select("logstore", "shard", "seq").join(F.broadcast(shards), ["logstore", "shard"])  # a row per shard

    def positions(name):
        at = current_positions(read_commits(spark, folder), "cg").select("logstore", "shard", F.col("seq").alias(name))
        at.coalesce(1).write.parquet(f"{folder}-{name}")
        return spark.read.schema(at.schema).parquet(f"{folder}-{name}")

    lost = ProgressCommitter(folder, "cg", mode="PERIODIC", interval_ms=3_600_000)
    lost.commit(cut.where("seq < third"), 0)
    out = positions("before_crash")
    lost.commit(cut.where("seq >= third AND seq < 2 * third"), 1)
    del lost
    out = out.join(positions("while_down"), ["logstore", "shard"])
    ProgressCommitter(folder, "cg", mode="PERIODIC", interval_ms=3_600_000).commit(cut.where("seq >= 2 * third"), 2)
    return out.join(positions("recovered"), ["logstore", "shard"])


def _positions_read(spark: SparkSession, options: dict, folder: str) -> None:
    """Run a continuous stream of groups until it ends by itself; each batch
    is stored with its number.  The number of batches grows with the store, so
    only a stream that stands still is given up."""
    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

    logs = decode(stream_groups(spark, options), "event_id bigint", keep=("logstore", "shard", "seq"))
    q = (logs.writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/checkpoint")
         .trigger(processingTime="0 seconds").start())
    try:
        if not end_when_finished(q, options, idle=600):
            raise TimeoutError("the stream stands still")
    finally:
        q.stop()


@register("stream_stops_itself", with_events(
    f"{DELIVERED_SQL} WHERE g.cursor_time >= {T_START_SQL} AND g.cursor_time < {T_STOP_SQL}"))
def stream_stops_itself(spark, sf_dir):
    """A continuous stream (no ``availableNow``) from a start time
    that stops by itself when every shard has come to the stop time."""
    folder = _scratch(spark)
    options = {"project": events_log_root(spark, sf_dir), "logstore": "events-.*", "logstore.pattern": "true",
               "scan.startup.mode": str(T_START), "stop.time": str(T_STOP), "max.number.per.fetch": "1000"}
    _positions_read(spark, options, folder)
    return _delivered(spark, folder)


GROUPS_A_BATCH = 40
#: Later than every event, and past: shards are read to their ends.
T_END = 1750000000


@register("stream_group_cap", with_events(f"""
SELECT CAST(seq // {GROUPS_A_BATCH} AS BIGINT) AS batch, logstore, shard, CAST(count(*) AS BIGINT) AS n_groups
FROM groups GROUP BY ALL"""))
def stream_group_cap(spark, sf_dir):
    """At most so many groups of each shard in a batch."""
    folder = _scratch(spark)
    options = {"project": events_log_root(spark, sf_dir), "logstore": "events-.*", "logstore.pattern": "true",
               "stop.time": str(T_END), "max.number.per.fetch": str(GROUPS_A_BATCH)}
    _positions_read(spark, options, folder)
    out = spark.read.schema(f"{ROW}, batch long").parquet(f"{folder}/out")
    return out.groupBy("batch", "logstore", "shard").agg(F.countDistinct("seq").alias("n_groups"))


@register("stream_commit", with_events("""
SELECT logstore, shard, CAST(max(seq) + 1 AS BIGINT) AS seq FROM groups GROUP BY logstore, shard"""))
def stream_commit(spark, sf_dir):
    """A copying stream with periodic commits, flushed at its end."""
    folder = _scratch(spark)
    committer = ProgressCommitter(f"{folder}/commits", "cg", mode="PERIODIC", interval_ms=3_600_000)
    stream = stream_decoded(spark, events_log_root(spark, sf_dir), "event_id bigint", max_files_per_trigger=8)
    _deliver(spark, stream, folder, committer)
    return current_positions(read_commits(spark, f"{folder}/commits"), "cg").select("logstore", "shard", "seq")


@register("stream_text_lines", with_events("""
SELECT logstore, CAST(count(*) AS BIGINT) AS n_lines FROM logs GROUP BY logstore"""))
def stream_text_lines(spark, sf_dir):
    """Every log as a line of JSON in text files."""
    folder = _scratch(spark)
    s = stream_decoded(spark, events_log_root(spark, sf_dir), "event_id bigint", keep=("logstore", "contents"))
    lines = s.select("logstore", log_to_json().alias("value"))
    q = (lines.writeStream.foreachBatch(batch_sink(f"{folder}/out", fmt="text", partition_by=("logstore",)))
         .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start())
    finish(q)
    text = spark.read.text(f"{folder}/out")
    return text.where(F.get_json_object("value", "$.event_id").isNotNull()).groupBy("logstore").agg(F.count("*").alias("n_lines"))


@register("stream_event_time", with_events("""
SELECT logstore, date_trunc('day', to_timestamp(time)::TIMESTAMP) AS day, CAST(count(*) AS BIGINT) AS n_logs
FROM logs GROUP BY 1, 2"""))
def stream_event_time(spark, sf_dir):
    """Logs for each day of event time, on a stream with a watermark wide
    enough for every file order."""
    folder = _scratch(spark)
    s = stream_decoded(spark, events_log_root(spark, sf_dir), "__time__ timestamp_ntz", keep=("logstore",), max_files_per_trigger=8)
    days = (with_event_time(s, delay="36500 days").groupBy("logstore", F.window("event_time", "1 day"))
            .agg(F.count("*").alias("n_logs")).select("logstore", F.col("window.start").alias("day"), "n_logs"))

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out")

    finish(days.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{folder}/checkpoint")
           .trigger(availableNow=True).start())
    return spark.read.parquet(f"{folder}/out").withColumn("day", F.col("day").cast("timestamp_ntz"))


@register("sql_insert_select", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderstatus, CAST(o_custkey AS BIGINT) AS o_custkey,
       o_orderstatus AS __topic__, 'orders' AS __source__ FROM orders""")
def sql_insert_select(spark, sf_dir):
    """INSERT INTO a log table by SQL, in two statements, then SELECT
    the rows back from its view by value."""
    root = f"{_scratch(spark)}/store"
    spark.read.parquet(f"{sf_dir}/orders.parquet").createOrReplaceTempView("_orders_to_insert")
    sink = {"project": root, "logstore": "orders", "sink.shards": "4", "sink.source": "orders"}
    for part in (0, 1):
        insert_sql(spark, f"""SELECT o_orderkey, o_orderstatus, o_custkey, o_orderstatus AS __topic__,
                              md5(CAST(o_orderkey AS STRING)) AS __hash_key__
                              FROM _orders_to_insert WHERE o_orderkey % 2 = {part}""", sink, now_seconds=1700000000,
                   write_time=f"2024-01-0{part + 1} 00:00:00")
    schema = "o_orderkey bigint, o_orderstatus string, o_custkey bigint, __topic__ string, __source__ string"
    name = f"orders_log_{uuid.uuid4().hex}"
    register_log_table(spark, name, schema, {"project": root, "logstore": "orders"})
    return spark.sql(f"SELECT * FROM {name}")


@register("sql_using_view", with_events(f"""
SELECT CAST(l.event_id AS BIGINT) AS event_id, l.event_id % 3 <> 1 AS ok, CAST(l.ts AS DATE) AS day,
       CASE WHEN l.event_id % 2 = 0 THEN date_trunc('second', l.ts) ELSE date_trunc('milliseconds', l.ts) END AS at,
       CAST(l.c_attempt AS INT) AS attempt, l.props, l.topic AS __topic__, 'copied' AS __source__
FROM logs l JOIN groups g ON l.logstore = g.logstore AND l.shard = g.shard AND l.seq = g.seq
WHERE g.cursor_time >= {T_START_SQL} AND g.cursor_time < {T_STOP_SQL}"""))
def sql_using_view(spark, sf_dir):
    """T1, T2, T4 by SQL text only: a source and a sink declared with USING,
    INSERT INTO the sink the source's rows, SELECT them back."""
    register_format(spark)
    source, sink = (f"{name}_{uuid.uuid4().hex}" for name in ("using_source", "using_sink"))
    columns = "event_id BIGINT, ok BOOLEAN, day DATE, at TIMESTAMP_NTZ, attempt INT, props STRING, __topic__ STRING"
    spark.sql(f"""CREATE TEMPORARY VIEW {source} ({columns}) USING shardlake OPTIONS (
        project '{events_log_root(spark, sf_dir)}', logstore 'events-.*', logstore.pattern 'true',
        scan.startup.mode '{T_START}', stop.time '{T_STOP}')""")
    spark.sql(f"""CREATE TEMPORARY VIEW {sink} ({columns}, __source__ STRING) USING shardlake OPTIONS (
        project '{_scratch(spark)}/store', logstore 'copy', sink.shards '4', sink.source 'copied')""")
    spark.sql(f"""INSERT INTO {sink} SELECT event_id, ok, day, at, attempt, props, __topic__, NULL FROM {source}""")
    return spark.sql(f"SELECT * FROM {sink}")


@register("stream_dedup_intervals", with_events(DELIVERED_SQL))
def stream_dedup_intervals(spark, sf_dir):
    """A3: the first two thirds of each shard's groups are delivered, then, to
    the same query started again, all groups: those delivered before are
    dropped, however old."""
    folder, groups = _scratch(spark), events_log_store(spark, sf_dir)
    shards = events_shards(spark, sf_dir).select("logstore", "shard", "end_seq")
    for part in ("3 * seq < 2 * end_seq", "true"):
        (groups.join(F.broadcast(shards), ["logstore", "shard"]).where(part).select(*groups.columns)   # a row per shard
         .write.mode("append").parquet(f"{folder}/in"))
        fresh = dedup_positions(spark.readStream.schema(groups.schema).parquet(f"{folder}/in"))
        with interval_state(spark):
            _deliver(spark, decode(fresh, "event_id bigint", keep=("logstore", "shard", "seq")), folder)
    return _delivered(spark, folder)
