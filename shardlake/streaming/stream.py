"""Structured Streaming over log stores.

* The source is the Parquet log-store table read as a file stream: new
  files and new shard directories are picked up at every trigger (R11), the
  read size per trigger is bounded by files or bytes (R10), and the offsets
  live in the query's checkpoint folder, so a restarted query resumes where
  it stopped (R13).
* The sink is ``foreachBatch``: the batch is written to a folder named by
  its ``batch_id`` (overwritten when a failed batch is retried, so the
  output is exactly once), then the consumer group's progress is appended
  (W4; positions only move forward, so repeating a commit is harmless).
"""
from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parse import ntz_to_ltz
from ..model import cursor_of
from ..operators.decode import decode
from ..sql import parse_checkpoint_mode
from ..sources.logstore import stream_log_store
from .progress import COMMIT_COLUMNS, merged_ranges, position_of_ranges, read_ranges

RANGE_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("consumer_group", "logstore")]
                            + [T.StructField("shard", T.IntegerType())]
                            + [T.StructField(n, T.LongType()) for n in ("from_seq", "seq")]
                            + [T.StructField("updated_at", T.TimestampNTZType()), T.StructField("batch_id", T.LongType())])


def stream_decoded(spark: SparkSession, root: str, schema, logstore=None, pattern=None,
                   ignore_parse_errors: bool = False, max_files_per_trigger: int | None = None,
                   max_bytes_per_trigger: int | None = None,
                   keep: tuple[str, ...] = ("logstore", "shard", "seq", "cursor_time")) -> DataFrame:
    """R2: a decoded log table as a stream."""
    groups = stream_log_store(spark, root, logstore, pattern, max_files_per_trigger, max_bytes_per_trigger)
    return decode(groups, schema, ignore_parse_errors, keep=keep)


def with_lag_metrics(df: DataFrame, name: str = "lag") -> DataFrame:
    """W7 on a stream: per micro-batch, the newest write time read and the
    row count, reported in the query progress (``observedMetrics``) and to
    ``StreamingQueryListener``s; fetch lag = trigger time - ``max_cursor_time``."""
    return df.observe(name, F.max("cursor_time").alias("max_cursor_time"), F.count(F.lit(1)).alias("rows"))


def fetch_lag_seconds(progress: dict, name: str = "lag") -> float | None:
    """W7 from one progress report (``query.lastProgress`` or a listener
    event): trigger time minus the newest write time read in that batch;
    None for a batch that read nothing."""
    import datetime as dt
    row = (progress.get("observedMetrics") or {}).get(name)
    if row is not None and hasattr(row, "asDict"):
        row = row.asDict()
    if not row or row.get("max_cursor_time") is None:
        return None
    newest = row["max_cursor_time"]
    if isinstance(newest, str):
        newest = dt.datetime.fromisoformat(newest)
    trigger = dt.datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00")).replace(tzinfo=None)
    return (trigger - newest).total_seconds()


class LagListener:
    """A ``StreamingQueryListener`` keeping the latest fetch lag per query
    (register with ``spark.streams.addListener(LagListener().listener())``)."""

    def __init__(self, name: str = "lag"):
        self.name = name
        self.lag: dict[str, float] = {}

    def listener(self):
        from pyspark.sql.streaming import StreamingQueryListener
        outer = self

        class _Listener(StreamingQueryListener):
            def onQueryStarted(self, event):
                pass

            def onQueryProgress(self, event):
                p = event.progress
                metrics = dict(p.observedMetrics or {})
                lag = fetch_lag_seconds({"observedMetrics": metrics, "timestamp": p.timestamp}, outer.name)
                if lag is not None:
                    outer.lag[str(p.id)] = lag

            def onQueryIdle(self, event):
                pass

            def onQueryTerminated(self, event):
                pass

        return _Listener()


def with_event_time(df: DataFrame, column: str = "__time__", delay: str | None = None) -> DataFrame:
    """Pick the event time column and, optionally, a watermark.
    Watermarks need an instant (TIMESTAMP): a wall-clock TIMESTAMP_NTZ is
    read as UTC."""
    col = F.col(column)
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        col = ntz_to_ltz(col)
    out = df.withColumn("event_time", col)
    return out.withWatermark("event_time", delay) if delay else out


@dataclass
class ProgressCommitter:
    """Commit what each micro-batch has read for a consumer group.

    A commit is the ranges of positions read, one row per shard and run; the
    group's position is where they follow its start without a gap, so files
    read out of order never commit what was not read.  ``ON_CHECKPOINTS``
    commits every batch; ``PERIODIC`` the first one and then at most once per
    ``interval_ms``: ranges held back are written ahead, beside the table, and
    go out merged with the next commit or with :meth:`flush`, to be called when
    the query has ended; those of a lost process go out with the first commit
    of the next one.  ``DISABLED`` commits never.  The table
    (``commits_path``) is created by the first commit.  ``start``: positions
    (``logstore, shard, start_seq``) that the group begins at, if not at 0."""
    commits_path: str
    consumer_group: str
    mode: str = "ON_CHECKPOINTS"
    interval_ms: int = 10_000
    start: DataFrame | None = None
    compact_every: int = 100
    _last: float | None = None
    _commits: int = 0
    _started: bool = False

    def __post_init__(self):
        self.mode = parse_checkpoint_mode(self.mode)

    @classmethod
    def from_options(cls, commits_path: str, options: dict) -> "ProgressCommitter":
        """From log table options: ``consumer-group``, ``checkpoint.mode``,
        ``commit.interval.ms``."""
        from ..sql import LogTableOptions
        opts = LogTableOptions.from_options(options)
        if not opts.consumer_group:
            raise ValueError("option 'consumer-group' is required to commit progress")
        return cls(commits_path, opts.consumer_group, opts.checkpoint_mode, opts.commit_interval_ms)

    def _rows(self, ranges: DataFrame, batch_id: int) -> DataFrame:
        return ranges.select(F.lit(self.consumer_group).alias("consumer_group"), "logstore", "shard", "from_seq", "seq",
                             F.localtimestamp().alias("updated_at"), F.lit(batch_id).cast("long").alias("batch_id"))

    def commit(self, batch: DataFrame, batch_id: int) -> None:
        if self.mode == "DISABLED":
            return
        spark = batch.sparkSession
        rows = self._rows(read_ranges(batch), batch_id)
        if self.start is not None and not self._started:
            # all before the start counts as read
            anchors = self.start.select("logstore", "shard", F.lit(0).cast("long").alias("from_seq"), F.col("start_seq").alias("seq"))
            rows = rows.unionByName(self._rows(anchors, batch_id))
        self._started = True
        if self.mode == "PERIODIC":
            # the batch is delivered: what it read must not be lost with this process
            rows.coalesce(1).write.parquet(f"{self._held_folder()}/{uuid.uuid4().hex}")
            now = time.monotonic()
            if self._last is not None and (now - self._last) * 1000 < self.interval_ms:
                return
            self._last = now
            self.flush(spark)
            return
        self._write(rows)

    def flush(self, spark: SparkSession) -> None:
        """Commit what is held back, by this process or by one before it.  Lost
        between the commit and the end of what it held, ranges are committed
        twice, which changes no position."""
        from ..sources.logstore import hadoop_fs
        fs, folder = hadoop_fs(spark, self._held_folder())
        held = [f.getPath() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        whole = [p for p in held if fs.exists(p.suffix("/_SUCCESS"))]
        if whole:
            self._write(merged_ranges(spark.read.schema(RANGE_SCHEMA).parquet(*[p.toString() for p in whole])))
            for p in whole:
                fs.delete(p, True)

    def _held_folder(self) -> str:
        return f"{self.commits_path}/_held/{self.consumer_group.encode().hex()}"

    def _write(self, rows: DataFrame) -> None:
        # one small file per commit: a row per shard and run of the batch
        rows.coalesce(1).write.mode("append").parquet(_generation(rows.sparkSession, self.commits_path, 0))
        self._commits += 1
        if self.compact_every and self._commits % self.compact_every == 0:
            compact_commits(rows.sparkSession, self.commits_path)


def _generations(spark: SparkSession, commits_path: str) -> list[str]:
    """Folders of the commit table, the last one being written to."""
    from ..sources.logstore import hadoop_fs
    fs, root = hadoop_fs(spark, commits_path)
    if not fs.exists(root):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(root) if f.getPath().getName().startswith("part-of-"))


def _generation(spark: SparkSession, commits_path: str, more: int) -> str:
    have = _generations(spark, commits_path)
    n = int(have[-1].rsplit("-", 1)[1]) if have else 0
    return f"{commits_path}/part-of-{n + more:08d}"


def _ranges(spark: SparkSession, commits_path: str, folders: list[str]) -> DataFrame:
    return spark.read.schema(RANGE_SCHEMA).parquet(*[f"{commits_path}/{f}" for f in folders])


def compact_commits(spark: SparkSession, commits_path: str) -> None:
    """Merge the commit files: the merged ranges start a new folder, then the
    older ones go.  A reader between the two sees rows twice, which changes
    no position; one consumer group writes a table at a time."""
    from ..sources.logstore import hadoop_fs
    old = _generations(spark, commits_path)
    if not old:
        return
    merged_ranges(_ranges(spark, commits_path, old)).coalesce(1).write.parquet(_generation(spark, commits_path, 1))
    for f in old:
        fs, path = hadoop_fs(spark, f"{commits_path}/{f}")
        fs.delete(path, True)


def read_commits(spark: SparkSession, commits_path: str) -> DataFrame:
    """The committed positions of a table written by :class:`ProgressCommitter`:
    ``model.CONSUMER_GROUPS`` rows, one per group and shard."""
    pos = position_of_ranges(_ranges(spark, commits_path, _generations(spark, commits_path)))
    return pos.withColumn("cursor", cursor_of(F.col("seq"))).select(*COMMIT_COLUMNS)


def batch_sink(output_path: str, transform: Callable[[DataFrame], DataFrame] | None = None,
               committer: ProgressCommitter | None = None, fmt: str = "parquet",
               partition_by: tuple[str, ...] = ()) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function writing each batch to
    ``output_path/query_id=<id>/batch_id=<id>`` (overwrite: a retried batch
    replaces its own output), then committing the consumer progress."""
    def run(batch: DataFrame, batch_id: int) -> None:
        # batch ids start again with each checkpoint: the query's id keeps
        # the outputs of two queries on one folder apart
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        folder = f"{output_path}/query_id={query}" if query else output_path
        # the batch feeds both the write and the commit: read it once
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK) if committer is not None else batch
        try:
            out = transform(kept) if transform else kept
            writer = out.write.mode("overwrite")
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.format(fmt).save(f"{folder}/batch_id={batch_id}")
            if committer is not None:
                committer.commit(kept, batch_id)
        finally:
            if committer is not None:
                kept.unpersist()
    return run


def start_copy(spark: SparkSession, root: str, schema, output_path: str, checkpoint: str,
               committer: ProgressCommitter | None = None, logstore=None, pattern=None,
               max_files_per_trigger: int | None = None, available_now: bool = True,
               processing_time: str | None = None):
    """Read log groups as a stream, decode them, write every batch with its
    id and commit progress.  The decoded rows keep ``logstore, shard, seq``
    so the progress can be computed from the batch itself."""
    stream = stream_decoded(spark, root, schema, logstore, pattern,
                            max_files_per_trigger=max_files_per_trigger)
    w = stream.writeStream.foreachBatch(batch_sink(output_path, committer=committer)) \
        .option("checkpointLocation", checkpoint)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def finish(query, committer: ProgressCommitter | None = None, timeout: float | None = None) -> None:
    """Wait for a query to end, then commit what its committer holds back
    (also after a failure: it was read and written)."""
    try:
        query.awaitTermination(timeout) if timeout else query.awaitTermination()
    finally:
        if committer is not None:
            committer.flush(query_session())


def query_session() -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def console_sink(df: DataFrame, checkpoint: str, rows: int = 2 ** 31 - 1):
    """Print every row of each batch; ``rows`` cuts the print short."""
    return (df.writeStream.format("console").option("numRows", rows).option("truncate", "false")
              .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def start_insert(rows: DataFrame, root: str, shards: DataFrame, options: dict, checkpoint: str,
                 order: tuple[str, ...] = ("time",), available_now: bool = True,
                 processing_time: str | None = None, once: bool = False):
    """T4 on a stream: ``INSERT INTO`` a log table, exactly once.  Each
    micro-batch is encoded with the table's options (K1-K6) and appended to
    the log store at ``root`` (K7-K11, behind each shard's positions) under
    the key (query id, batch id): a batch that runs again after a failure finds
    its key in the store's manifest if it had been committed, and is not
    written twice; if it had not, nothing of it is in the store."""
    from ..plans.cache import scoped
    from ..sources.logstore import append_records
    from ..sql import sink_records

    def run(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        with scoped():
            append_records(sink_records(batch, options), root, shards, order=order,
                           key=(query, batch_id) if query else None)

    w = rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif once:
        w = w.trigger(once=True)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()
