"""Consumption progress of a consumer group (W1, W4-W7) as DataFrames.

A consumer-group table (``model.CONSUMER_GROUPS``) holds, per group and
shard, ``seq`` = the next position to read (its ``cursor`` is the text form).
Commits are append-only rows; in a table of positions the current one of a
shard is the largest committed ``seq``, so replaying a commit (a retried batch)
changes nothing.  A stream commits the *ranges* it has read, since files need
not arrive in ``seq`` order: its position is the end of the ranges that follow
its start without a gap (``position_of_ranges``).
Every table here has one row per shard (or per shard and commit), so joins
against the log groups broadcast it after a size check (``plans.broadcast``).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..model import CONSUMER_GROUPS, cursor_of, seq_of
from ..plans.positions import ScanIndex

SHARD_KEY = ["logstore", "shard"]
COMMIT_COLUMNS = [f.name for f in CONSUMER_GROUPS.fields]


def batch_progress(read_groups: DataFrame, consumer_group: str, updated_at=None) -> DataFrame:
    """The commit rows of one read: per shard, the position after the
    last group read (``max(seq) + 1``).  A partial aggregate: one row per
    shard and task crosses the shuffle."""
    at = F.lit(updated_at) if updated_at is not None else F.localtimestamp()
    nxt = read_groups.groupBy(*SHARD_KEY).agg((F.max("seq") + 1).alias("seq"))
    return nxt.select(F.lit(consumer_group).alias("consumer_group"), *SHARD_KEY,
                      cursor_of(F.col("seq")).alias("cursor"), "seq",
                      at.cast("timestamp_ntz").alias("updated_at"))


def read_ranges(read_groups: DataFrame) -> DataFrame:
    """The runs of consecutive ``seq`` in a read: ``logstore, shard, from_seq,
    seq`` (half-open).  The ends of the runs are found by anti joins on the
    position, so no shard is sorted in one task; only the runs, a few for each
    file read, are put in order."""
    at = read_groups.select(*SHARD_KEY, "seq").distinct()
    key = [*SHARD_KEY, "seq"]
    first = at.join(at.select(*SHARD_KEY, (F.col("seq") + 1).alias("seq")), key, "left_anti")
    last = at.join(at.select(*SHARD_KEY, (F.col("seq") - 1).alias("seq")), key, "left_anti")
    order = Window.partitionBy(*SHARD_KEY).orderBy("seq")
    nth = F.row_number().over(order)
    return (first.withColumn("_n", nth).withColumnRenamed("seq", "from_seq")
            .join(last.withColumn("_n", nth), [*SHARD_KEY, "_n"])
            .select(*SHARD_KEY, "from_seq", (F.col("seq") + 1).alias("seq")))


def position_of_ranges(ranges: DataFrame) -> DataFrame:
    """``consumer_group, logstore, shard, seq, updated_at``: how far a group
    has read a shard from 0 on without a gap, by its ``ranges`` (``from_seq``,
    ``seq``, half-open; a later start is a range from 0).  One row per shard
    and run read."""
    key = ["consumer_group", *SHARD_KEY]
    w = Window.partitionBy(*key).orderBy("from_seq", "seq")
    before = F.coalesce(F.max("seq").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    gaps = F.sum((F.col("from_seq") > F.col("_before")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return (ranges.withColumn("_before", before).withColumn("_gaps", gaps)
            .groupBy(*key).agg(F.coalesce(F.max(F.when(F.col("_gaps") == 0, F.col("seq"))), F.lit(0)).alias("seq"),
                               F.max("updated_at").alias("updated_at")))


def merged_ranges(ranges: DataFrame) -> DataFrame:
    """The same ranges with adjoining and overlapping ones made one."""
    key = ["consumer_group", *SHARD_KEY]
    w = Window.partitionBy(*key).orderBy("from_seq", "seq")
    before = F.max("seq").over(w.rowsBetween(Window.unboundedPreceding, -1))
    placed = ranges.withColumn("_new", (before.isNull() | (F.col("from_seq") > before)).cast("int"))
    run = F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return (placed.withColumn("_run", run).groupBy(*key, "_run")
            .agg(F.min("from_seq").alias("from_seq"), F.max("seq").alias("seq"), F.max("updated_at").alias("updated_at"),
                 F.max("batch_id").alias("batch_id"))
            .select(*key, "from_seq", "seq", "updated_at", "batch_id"))


def current_positions(commits: DataFrame, consumer_group: str | None = None) -> DataFrame:
    """Latest committed position per (group, shard) from append-only commit
    rows (``seq`` or, when NULL, the position in ``cursor``)."""
    c = commits if consumer_group is None else commits.where(F.col("consumer_group") == consumer_group)
    seq = F.coalesce(F.col("seq"), seq_of("cursor"))
    return (c.groupBy("consumer_group", *SHARD_KEY)
             .agg(F.max(seq).alias("seq"), F.max("updated_at").alias("updated_at"))
             .select("consumer_group", *SHARD_KEY, cursor_of(F.col("seq")).alias("cursor"), "seq", "updated_at"))


def merge_commit(commits: DataFrame, read_groups: DataFrame, consumer_group: str, updated_at=None) -> DataFrame:
    """The consumer-group table after committing a read: positions
    only move forward; a shard or group seen for the first time is created."""
    new = batch_progress(read_groups, consumer_group, updated_at).select(*COMMIT_COLUMNS)
    return current_positions(commits.select(*COMMIT_COLUMNS).unionByName(new))


def progress_time(positions: DataFrame, groups: DataFrame, store=None) -> DataFrame:
    """Per shard, the write time of the last group read (the group just
    before the committed position): the consumer's position as a time.
    NULL when nothing was read yet.  ``store``: the ``FileIndex`` of the store
    that holds the groups, which knows most times without opening a file."""
    p = positions.select("consumer_group", *SHARD_KEY, F.col("seq").alias("next_seq"))
    timed = (store or ScanIndex(groups)).time_of(p)
    return timed.select("consumer_group", *SHARD_KEY, "next_seq", "progress_time")


def consumer_lag(positions: DataFrame, groups: DataFrame, now=None, store=None) -> DataFrame:
    """Per shard, groups not yet read, seconds between the newest write
    and the consumer's position, and the fetch lag ``now - progress time``
    (``now`` fixed for reproducible reports, else the current time)."""
    store = store or ScanIndex(groups)
    idx = store.shards()
    t = progress_time(positions, groups, store).join(idx, SHARD_KEY, "left")
    now_col = F.lit(now).cast("timestamp_ntz") if now is not None else F.localtimestamp()
    return t.select(
        "consumer_group", *SHARD_KEY, "next_seq", "progress_time",
        (F.col("end_seq") - F.col("next_seq")).alias("groups_behind"),
        F.timestamp_diff("SECOND", F.col("progress_time"), F.col("end_time")).alias("write_lag_s"),
        F.timestamp_diff("SECOND", F.col("progress_time"), now_col).alias("fetch_lag_s"))


def source_timestamps(groups: DataFrame) -> DataFrame:
    """The record timestamp a read attaches to a group: the group's
    write time (``cursor_time``, new source) and the first log's time in
    milliseconds (legacy source)."""
    return groups.select(*SHARD_KEY, "seq", "cursor_time",
                         (F.col("logs")[0]["time"].cast("long") * 1000).alias("legacy_ts_ms"))
