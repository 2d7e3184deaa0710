"""SQL surface (T1-T4): log tables as temporary views, and INSERT into a
log store.

``register_log_table`` is the counterpart of ``CREATE TABLE ... WITH
('connector' = ...)``: options are validated, the log stores are selected,
positions applied, and the declared schema decoded; the result is a view that
Spark SQL plans like any other (pruning, pushdown, joins).
"""
from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators.decode import as_schema, decode
from .operators.encode import encode_rows
from .plans.positions import (CHECKPOINT, LATEST, TIMESTAMP, bounded, parse_start_position, parse_stop_time, read_from,
                              resolve_positions, seconds_ntz, stored_positions)
from .sources.logstore import read_log_store, select_logstores


def _bool(v) -> bool:
    if isinstance(v, bool):
        return v
    s = str(v).strip().lower()
    if s in ("true", "false"):
        return s == "true"
    raise ValueError(f"not a boolean: {v}")


# Checkpoint commit modes; '-' and '_' are interchangeable.
CHECKPOINT_MODES = ("ON_CHECKPOINTS", "PERIODIC", "DISABLED")


def parse_checkpoint_mode(text: str | None) -> str:
    if text is None or str(text).strip() == "":
        return "ON_CHECKPOINTS"
    norm = str(text).strip().upper().replace("-", "_")
    if norm not in CHECKPOINT_MODES:
        raise ValueError(f"Unknown checkpoint mode: {text}")
    return norm


@dataclass
class LogTableOptions:
    """Options of a log table (T2).  Unknown keys are rejected."""
    project: str = ""                       # root path of the log store table
    logstore: str = ""                      # name, comma list, or pattern (with logstore_pattern)
    logstore_pattern: bool = False
    consumer_group: str | None = None
    scan_startup_mode: str = "earliest"
    scan_startup_default_position: str = "earliest"
    stop_time: str | None = None
    checkpoint_mode: str = "ON_CHECKPOINTS"
    commit_interval_ms: int = 10_000
    max_number_per_fetch: int = 100
    fetch_interval_ms: int = 100             # accepted: a trigger interval is the query's
    shards_discovery_interval_ms: int = 60_000  # accepted: every trigger lists the store
    ignore_parse_errors: bool = False
    scan_parallelism: int | None = None
    sink_parallelism: int | None = None
    sink_topic: str = ""
    sink_source: str | None = None
    producer_buckets: int | None = None
    producer_adjust_shard_hash: bool = True
    sink_shards: int = 1                     # shards of a log store that an insert creates

    # The option names.
    _KEYS = {
        "project": "project", "logstore": "logstore", "logstore.pattern": "logstore_pattern",
        "consumer-group": "consumer_group", "scan.startup.mode": "scan_startup_mode",
        "scan.startup.default-position": "scan_startup_default_position", "stop.time": "stop_time",
        "checkpoint.mode": "checkpoint_mode", "commit.interval.ms": "commit_interval_ms",
        "max.number.per.fetch": "max_number_per_fetch", "fetch.interval.ms": "fetch_interval_ms",
        "shards.discovery.interval.ms": "shards_discovery_interval_ms",
        "ignore-parse-errors": "ignore_parse_errors", "scan.parallelism": "scan_parallelism",
        "sink.parallelism": "sink_parallelism", "sink.topic": "sink_topic", "sink.source": "sink_source",
        "producer.buckets": "producer_buckets", "producer.adjust.shard.hash": "producer_adjust_shard_hash",
        "sink.shards": "sink_shards",
    }

    @classmethod
    def from_options(cls, options: dict) -> "LogTableOptions":
        opts = cls()
        types = {f.name: f.type for f in fields(cls)}
        for key, value in options.items():
            if key == "connector":
                continue
            attr = cls._KEYS.get(key)
            if attr is None:
                raise ValueError(f"Unsupported option '{key}'")
            kind = types[attr]
            if "bool" in str(kind):
                value = _bool(value)
            elif "int" in str(kind) and value is not None:
                value = int(value)
            setattr(opts, attr, value)
        if not opts.logstore:
            raise ValueError("option 'logstore' is required")
        start, fallback = parse_start_position(opts.scan_startup_mode), parse_start_position(opts.scan_startup_default_position)
        if start.kind == "checkpoint" and not opts.consumer_group:
            raise ValueError("Starting from a checkpoint needs a consumer group")
        if start.kind == fallback.kind == "checkpoint":
            raise ValueError("The fallback position of a checkpoint start cannot be 'checkpoint'")
        parse_stop_time(opts.stop_time)
        for name in ("commit.interval.ms", "fetch.interval.ms", "shards.discovery.interval.ms"):
            if getattr(opts, cls._KEYS[name]) <= 0:
                raise ValueError(f"{name} must be positive")
        opts.checkpoint_mode = parse_checkpoint_mode(opts.checkpoint_mode)
        if opts.max_number_per_fetch <= 0:
            raise ValueError("max.number.per.fetch must be positive")
        return opts

    def selection(self) -> dict:
        if self.logstore_pattern:
            return {"pattern": self.logstore}
        names = [n.strip() for n in self.logstore.split(",")]
        return {"logstore": names[0] if len(names) == 1 else names}


def log_table(spark: SparkSession, schema: T.StructType | str, options: dict,
              groups: DataFrame | None = None, checkpoints: DataFrame | None = None,
              keep: tuple[str, ...] = ()) -> DataFrame:
    """The decoded table described by ``options``.  ``groups`` replaces the
    ``project`` path when the log groups are derived rather than stored."""
    from .sources.manifest import FileIndex
    opts = LogTableOptions.from_options(options)
    store = None
    start, stop = parse_start_position(opts.scan_startup_mode), parse_stop_time(opts.stop_time)
    if groups is None:
        if not opts.project:
            raise ValueError("option 'project' is required")
        groups = read_log_store(spark, opts.project, **opts.selection())
        if start.kind in (LATEST, CHECKPOINT):
            store = FileIndex(spark, opts.project).select(**opts.selection())
    else:
        groups = select_logstores(groups, **opts.selection())
    if start.kind in (LATEST, CHECKPOINT):
        groups = bounded(groups, resolve_positions(
            groups, opts.scan_startup_mode, None, checkpoints, opts.consumer_group,
            opts.scan_startup_default_position, store=store))
    # write times never fall within a shard, so times are plain conditions
    # that reach the scan
    if start.kind == TIMESTAMP:
        groups = groups.where(F.col("cursor_time") >= seconds_ntz(start.timestamp))
    if stop is not None:
        groups = groups.where(F.col("cursor_time") < seconds_ntz(stop))
    out = decode(groups, as_schema(schema), opts.ignore_parse_errors, keep=keep)
    if opts.scan_parallelism:
        out = out.repartition(opts.scan_parallelism)
    return out


def stream_log_table(spark: SparkSession, schema: T.StructType | str, options: dict,
                     checkpoints: DataFrame | None = None,
                     keep: tuple[str, ...] = ("logstore", "shard", "seq", "cursor_time"),
                     state: str | None = None) -> DataFrame:
    """The streaming form of :func:`log_table` (R2 with R3-R10).

    ``max.number.per.fetch`` bounds the *files* read per trigger (the store
    keeps a shard's groups in seq-ordered files).

    A start time and a stop time are conditions on the write time, so they
    hold for shards found later and for groups written later alike.  ``latest``
    and ``checkpoint`` need a position for each shard: it is resolved once,
    stored under ``state`` (a folder next to the query's checkpoint, required
    for these two) and read from there when the query starts again.  A shard
    found later has no stored position and is read from its beginning (from
    the fallback time, where the fallback is a time)."""
    from .sources.logstore import stream_log_store
    from .sources.manifest import FileIndex
    opts = LogTableOptions.from_options(options)
    if not opts.project:
        raise ValueError("option 'project' is required")
    sel = opts.selection()
    groups = stream_log_store(spark, opts.project, max_files_per_trigger=opts.max_number_per_fetch, **sel)
    start, stop = parse_start_position(opts.scan_startup_mode), parse_stop_time(opts.stop_time)
    if stop is not None:
        groups = groups.where(F.col("cursor_time") < seconds_ntz(stop))
    if start.kind == TIMESTAMP:
        groups = groups.where(F.col("cursor_time") >= seconds_ntz(start.timestamp))
    elif start.kind in (LATEST, CHECKPOINT):
        if not state:
            raise ValueError(f"a stream that starts from '{start.kind}' needs a state folder for its positions")
        pos = stored_positions(spark, state, lambda: resolve_positions(
            read_log_store(spark, opts.project, **sel), opts.scan_startup_mode, None, checkpoints,
            opts.consumer_group, opts.scan_startup_default_position, store=FileIndex(spark, opts.project).select(**sel)))
        fallback = parse_start_position(opts.scan_startup_default_position)
        since = fallback.timestamp if start.kind == CHECKPOINT and fallback.kind == TIMESTAMP else None
        groups = read_from(groups, pos, since)
    out = decode(groups, as_schema(schema), opts.ignore_parse_errors, keep=keep)
    return out.repartition(opts.scan_parallelism) if opts.scan_parallelism else out


def register_log_table(spark: SparkSession, name: str, schema: T.StructType | str, options: dict,
                       groups: DataFrame | None = None, checkpoints: DataFrame | None = None,
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """``CREATE TEMPORARY VIEW name`` over a log table."""
    df = log_table(spark, schema, options, groups, checkpoints, keep)
    df.createOrReplaceTempView(name)
    return df


CHANGE_TYPE = "_change_type"


def insert_only(rows: DataFrame) -> DataFrame:
    """T4: only inserts may reach a log store.  A ``_change_type`` column, when
    present, must say ``insert`` for every row; anything else raises."""
    if CHANGE_TYPE not in rows.columns:
        return rows
    ct = F.lower(F.col(CHANGE_TYPE))
    checked = F.when(ct.isNull() | (ct == "insert"), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("Only INSERT rows can be written to a log store, got "),
                               F.col(CHANGE_TYPE))).cast("boolean"))
    return rows.where(checked).drop(CHANGE_TYPE)


def sink_records(rows: DataFrame, options: dict, now_seconds: int | None = None) -> DataFrame:
    """Encode rows for ``INSERT INTO`` a log table (T4 with K1-K5)."""
    opts = LogTableOptions.from_options(options)   # a default log store is required
    if opts.logstore_pattern or "," in opts.logstore:
        raise ValueError("a sink writes to one default log store, not to a list or a pattern")
    out = encode_rows(insert_only(rows), default_topic=opts.sink_topic, default_source=opts.sink_source,
                      default_logstore=opts.logstore, now_seconds=now_seconds)
    if opts.producer_buckets and opts.producer_adjust_shard_hash:
        # K9: a key is moved to the begin key of its bucket, so the records
        # of one bucket go to one shard together
        from .operators.route import adjust_hash_key
        out = out.withColumn("hash_key", adjust_hash_key(F.col("hash_key"), opts.producer_buckets))
    if opts.sink_parallelism:
        out = out.repartition(opts.sink_parallelism)
    return out


def insert_into(rows: DataFrame, options: dict, order: tuple[str, ...] = ("time",), write_time: str | None = None,
                now_seconds: int | None = None, key: tuple[str, int] | None = None) -> None:
    """T4: ``INSERT INTO`` the log table described by ``options``: rows are
    encoded and appended to the log stores under ``project``.  What is there
    already is known from the store's manifest; a ``key`` (writer, batch) that
    was committed before inserts nothing.

    A row goes to its ``__logstore__`` if that store exists, else to the
    default ``logstore``, which is created with ``sink.shards`` shards if
    need be; a row for another store raises."""
    from .sources.logstore import append_records
    from .sources.manifest import open_store
    opts = LogTableOptions.from_options(options)
    if not opts.project:
        raise ValueError("option 'project' is required")
    spark = rows.sparkSession
    own = spark.range(opts.sink_shards).select(F.lit(opts.logstore).alias("logstore"), F.col("id").cast("int").alias("shard"))
    store = open_store(spark, opts.project)
    if store.version:
        have = store.shards().where("status <> 'readonly'").select("logstore", "shard")
        own = have.unionByName(own.join(have.select("logstore").distinct(), "logstore", "left_anti"))
    append_records(sink_records(rows, options, now_seconds), opts.project, own, order=order, write_time=write_time, key=key)


def insert_sql(spark: SparkSession, query: str, options: dict, **more) -> None:
    """``INSERT INTO`` a log table the rows of a SELECT."""
    insert_into(spark.sql(query), options, **more)
