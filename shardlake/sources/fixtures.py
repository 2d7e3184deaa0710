"""Log stores derived from the driver's tables, with plain expressions.

``events`` becomes the log store family ``events-<event_type>``: shard =
``user_id mod 4``; inside a shard logs are ordered by ``(ts, event_id)`` and
packed ten to a group; ``seq`` is the group's dense position in the shard,
``cursor_time`` the latest ``ts`` of the group (the write time), ``time`` and
``time_ns`` the log's epoch seconds and nanosecond part.  Everything is a
function of the input columns, so SQL can restate it (see ``queries.base``).

Fixed layout of an ``events`` log (key order as written):
event_id, user_id, value, props, ok, day, at, clock, attempt, and for
``error`` events a second ``attempt`` (a repeated key: the last one wins).
``ok`` alternates ``TRUE`` / ``false`` / ``True``; ``day``, ``at`` and
``clock`` alternate between their two encodings (ISO text for even ids,
epoch days / epoch milliseconds / milliseconds of day for odd ids).
Topic is ``web`` for even shards, ``app`` for odd ones; source
``10.0.<shard>.1``; tags ``hostname = host-<shard>`` and ``day`` = date of
the group's first log.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import hashlib

from ..model import cursor_of, epoch_micros, floor_div
from ..plans.numbering import position_within
from ..session import ensure_checkpoint_dir
from .logstore import hadoop_fs, materialize_log_store, read_log_store
from .manifest import READONLY, FileIndex, by_position, open_store, set_status

# bump when the derivation below changes: stored copies are keyed by it
FIXTURE_VERSION = "events-v5"
LOGS_PER_GROUP = 10
SHARDS_PER_STORE = 4
MICROS_PER_DAY = 86_400_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _kv(key: str, value) -> F.Column:
    return F.struct(F.lit(key).alias("key"), value.cast("string").alias("value"))


def events_by_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event, as it is, with its ``logstore`` and ``shard``."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("events-"), F.col("event_type")).alias("logstore"),
        F.pmod(F.col("user_id"), F.lit(SHARDS_PER_STORE)).cast("int").alias("shard"),
        "ts", "event_id", "user_id", "value", "props")


def event_log() -> F.Column:
    """An event as a log (``time, time_ns, contents``)."""
    us = epoch_micros(F.col("ts"))
    even = F.col("event_id") % 2 == 0
    contents = F.array(
        _kv("event_id", F.col("event_id")),
        _kv("user_id", F.col("user_id")),
        _kv("value", F.col("value")),
        _kv("props", F.col("props")),
        _kv("ok", F.when(F.col("event_id") % 3 == 0, F.lit("TRUE"))
                   .when(F.col("event_id") % 3 == 1, F.lit("false")).otherwise(F.lit("True"))),
        _kv("day", F.when(even, F.date_format("ts", "yyyy-MM-dd"))
                    .otherwise(floor_div(us, MICROS_PER_DAY).cast("string"))),
        _kv("at", F.when(even, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
                   .otherwise(floor_div(us, 1000).cast("string"))),
        _kv("clock", F.when(even, F.date_format("ts", "HH:mm:ss"))
                      .otherwise(floor_div(F.pmod(us, F.lit(MICROS_PER_DAY)), 1000).cast("string"))),
        _kv("attempt", F.lit("1")),
    )
    retry = F.array(_kv("attempt", (F.col("event_id") % 3 + 2)))
    return F.struct(
        floor_div(us, 1000000).cast("int").alias("time"),
        (F.pmod(us, F.lit(1000000)) * 1000).cast("int").alias("time_ns"),
        F.when(F.col("logstore") == "events-error", F.concat(contents, retry)).otherwise(contents).alias("contents"))


def pack_sequential(logs: DataFrame, order: list[str], per_group: int = LOGS_PER_GROUP) -> DataFrame:
    """Give each log ``seq`` (group position in its shard) and ``idx``
    (position in the group): ``per_group`` consecutive logs of a shard by
    ``order`` form a group.  Exact and skew-safe (see ``position_within``)."""
    ranked = position_within(logs, ["logstore", "shard"], order)
    return (ranked.withColumn("seq", floor_div(F.col("pos"), per_group))
                  .withColumn("idx", (F.col("pos") % per_group).cast("int"))
                  .drop("pos"))


def events_log_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` log store family as log-group rows (``model.LOG_GROUP``),
    in range partitions on their positions (``manifest.by_position``).

    The events are numbered and dealt as they are; a log, about ten times as
    large, is made of each last, where its group is written."""
    events = by_position(pack_sequential(events_by_shard(spark, sf_dir), ["ts", "event_id"]))
    logs = events.select("logstore", "shard", "seq", "idx", "ts", event_log().alias("log"))
    grouped = logs.groupBy("logstore", "shard", "seq").agg(
        F.max("ts").alias("cursor_time"),
        F.min("ts").alias("first_ts"),
        # a group holds at most LOGS_PER_GROUP logs: bounded collect
        F.sort_array(F.collect_list(F.struct("idx", "log"))).alias("entries"),
    )
    shard = F.col("shard")
    return grouped.select(
        "logstore", "shard", "seq",
        cursor_of(F.col("seq")).alias("cursor"),
        cursor_of(F.col("seq") + 1).alias("next_cursor"),
        "cursor_time",
        F.when(shard % 2 == 0, F.lit("web")).otherwise(F.lit("app")).alias("topic"),
        F.concat(F.lit("10.0."), shard.cast("string"), F.lit(".1")).alias("source"),
        F.create_map(F.lit("hostname"), F.concat(F.lit("host-"), shard.cast("string")),
                     F.lit("day"), F.date_format("first_ts", "yyyy-MM-dd")).alias("tags"),
        F.col("entries.log").alias("logs"),
    )


def shards_of(groups: DataFrame, readonly_shard: int | None = SHARDS_PER_STORE - 1) -> DataFrame:
    """Shard table (``model.SHARDS``) of a log-group table: one row per shard
    with its first and one-past-last ``seq``.  In the derived stores the shard
    numbered ``readonly_shard`` is closed (``readonly``)."""
    status = (F.when(F.col("shard") == readonly_shard, F.lit("readonly")).otherwise(F.lit("readwrite"))
              if readonly_shard is not None else F.lit("readwrite"))
    return (groups.groupBy("logstore", "shard")
                  .agg(F.min("seq").alias("begin_seq"), (F.max("seq") + 1).alias("end_seq"))
                  .select("logstore", "shard", status.alias("status"), "begin_seq", "end_seq"))


def events_log_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` log stores as a stored table: derived once per state of
    the input (written into the shared checkpoint folder, see
    :func:`events_log_root`), then read like any log store: a Parquet scan with
    partition pruning on ``logstore`` and ``shard``."""
    return read_log_store(spark, events_log_root(spark, sf_dir))


def events_log_root(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the derived log stores, keyed by the derivation's version and
    by the name, size and modification time of every input file: changed
    input gives another store."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    state = [FIXTURE_VERSION]
    for name in sorted(table(spark, sf_dir, "events").inputFiles()):
        fs, path = hadoop_fs(spark, name)
        status = fs.getFileStatus(path)
        state.append(f"{name}|{status.getLen()}|{status.getModificationTime()}")
    key = hashlib.sha1("\n".join(map(str, state)).encode()).hexdigest()[:16]
    return materialize_log_store(spark, f"{base}/shardlake-logstores/{key}",
                                 lambda: events_log_groups(spark, sf_dir), lambda root: _close_shards(spark, root), placed=True)


def _close_shards(spark: SparkSession, root: str) -> None:
    """The last shard of every derived store is closed."""
    last = open_store(spark, root).ends().where(F.col("shard") == SHARDS_PER_STORE - 1)
    set_status(spark, root, last.select("logstore", "shard", F.lit(READONLY).alias("status")))


def events_index(spark: SparkSession, sf_dir: str) -> FileIndex:
    """The manifest's index of the derived log stores."""
    return FileIndex(spark, events_log_root(spark, sf_dir))


def events_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard table of the derived log stores, as their manifest keeps it."""
    return open_store(spark, events_log_root(spark, sf_dir)).shards()
