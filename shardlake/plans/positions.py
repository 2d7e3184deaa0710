"""Start and stop positions per shard.

A *positions* DataFrame has one row per shard: ``logstore, shard,
start_seq, stop_seq`` (``stop_seq`` NULL = unbounded; the range is
half-open).  For a stored log store it is resolved from the manifest
(``sources.manifest.FileIndex``: rows of files, and at most one file of each
shard), for other groups by an aggregate over them (``ScanIndex``), and joined
back to the groups with a broadcast on ``(logstore, shard)`` plus a range
condition on ``seq``; it has one row per shard, whatever the data.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import seq_of
from .broadcast import materialize_small, maybe_broadcast

EARLIEST, LATEST, CHECKPOINT, TIMESTAMP = "earliest", "latest", "checkpoint", "timestamp"
# Accepted spellings of the starting positions.
_ALIASES = {
    "earliest": EARLIEST, "begin_cursor": EARLIEST,
    "latest": LATEST, "end_cursor": LATEST,
    "checkpoint": CHECKPOINT, "consumer_from_checkpoint": CHECKPOINT,
}


@dataclass(frozen=True)
class StartPosition:
    kind: str
    timestamp: int | None = None   # epoch seconds for TIMESTAMP


def parse_start_position(text: str | int | None) -> StartPosition:
    """``earliest``/``begin_cursor`` (also empty), ``latest``/``end_cursor``,
    ``checkpoint``/``consumer_from_checkpoint``, or integer epoch seconds.
    Case and surrounding blanks are ignored.  The bare word ``timestamp`` is
    rejected here (it carries no time)."""
    if text is None:
        return StartPosition(EARLIEST)
    if isinstance(text, int) and not isinstance(text, bool):
        return StartPosition(TIMESTAMP, text)
    norm = str(text).strip().lower()
    if norm == "":
        return StartPosition(EARLIEST)
    if norm in _ALIASES:
        return StartPosition(_ALIASES[norm])
    try:
        seconds = int(norm)
    except ValueError:
        raise ValueError(f"Unknown starting position: {text}") from None
    if not -2**31 <= seconds < 2**31:
        raise ValueError(f"Unknown starting position: {text}")
    return StartPosition(TIMESTAMP, seconds)


def parse_stop_time(text: str | int | None) -> int | None:
    """Stop time in epoch seconds; a value that is not an integer is an error."""
    if text is None or (isinstance(text, str) and text.strip() == ""):
        return None
    try:
        return int(str(text).strip())
    except ValueError:
        raise ValueError(f"Invalid stop time: {text}") from None


def shard_index(groups: DataFrame) -> DataFrame:
    """One row per shard: ``begin_seq``, ``end_seq`` (one past the last) and
    the latest ``cursor_time``.  Partial aggregation map-side: only one row per
    shard and task crosses the shuffle."""
    return groups.groupBy("logstore", "shard").agg(
        F.min("seq").alias("begin_seq"), (F.max("seq") + 1).alias("end_seq"),
        F.max("cursor_time").alias("end_time"))


class ScanIndex:
    """Positions and times from the groups themselves, for groups that are
    not a stored log store (which has ``sources.manifest.FileIndex``)."""

    def __init__(self, groups: DataFrame):
        self.groups = groups

    def shards(self) -> DataFrame:
        return shard_index(self.groups)

    def first_seq_at(self, seconds: int, strict_after: bool = False, name: str = "at_seq") -> DataFrame:
        return first_seq_at(self.groups, seconds, strict_after, name)

    def time_of(self, positions: DataFrame) -> DataFrame:
        """``positions`` (``logstore, shard, next_seq``) with ``progress_time``."""
        from .broadcast import checked_broadcast
        key = ["logstore", "shard", "next_seq"]
        at = checked_broadcast(positions.select(*key).distinct())  # one row per shard and position
        last = self.groups.select("logstore", "shard", (F.col("seq") + 1).alias("next_seq"),
                                  F.col("cursor_time").alias("progress_time")).join(at, key, "left_semi")
        return positions.join(last, key, "left")


def seconds_ntz(seconds: int):
    return F.timestamp_add("SECOND", F.lit(seconds), F.expr("timestamp_ntz'1970-01-01 00:00:00'"))


def first_seq_at(groups: DataFrame, seconds: int, strict_after: bool = False, name: str = "at_seq") -> DataFrame:
    """Per shard, the first ``seq`` written at or after ``seconds`` (or
    strictly after, for 'latest as of')."""
    t = seconds_ntz(seconds)
    cond = F.col("cursor_time") > t if strict_after else F.col("cursor_time") >= t
    return groups.where(cond).groupBy("logstore", "shard").agg(F.min("seq").alias(name))


def resolve_positions(groups: DataFrame, start: str | int | None = EARLIEST,
                      stop_time: str | int | None = None,
                      checkpoints: DataFrame | None = None, consumer_group: str | None = None,
                      fallback: str | int | None = EARLIEST, as_of: int | None = None,
                      store=None) -> DataFrame:
    """Positions for reading ``groups``.  ``store``: the ``FileIndex`` of the
    store that holds the groups, which resolves them without a scan.

    * ``earliest``: from the first group; ``latest``: from the end (as of
      ``as_of`` seconds when given: the first group written after it).
    * integer seconds: the first group whose ``cursor_time`` is at or after it.
    * ``checkpoint``: the committed ``seq`` of ``consumer_group`` in
      ``checkpoints`` (``model.CONSUMER_GROUPS``), else ``fallback``.
    * ``stop_time``: reading stops before the first group written at or after
      it (half-open); shards with nothing that late read to their end.
    """
    pos = parse_start_position(start)
    stop = parse_stop_time(stop_time)
    store = store or ScanIndex(groups)
    index = store.shards()
    fb = parse_start_position(fallback)
    if pos.kind == CHECKPOINT and fb.kind == CHECKPOINT:
        raise ValueError("The fallback position of a checkpoint start cannot be 'checkpoint'")
    if pos.kind == CHECKPOINT and not consumer_group:
        raise ValueError("Starting from a checkpoint needs a consumer group")

    def plain(p: StartPosition, frame: DataFrame) -> tuple[DataFrame, F.Column]:
        if p.kind == EARLIEST:
            return frame, F.col("begin_seq")
        if p.kind == LATEST:
            if as_of is None:
                return frame, F.col("end_seq")
            f = frame.join(store.first_seq_at(as_of, strict_after=True, name="_latest"),
                           ["logstore", "shard"], "left")
            return f, F.coalesce(F.col("_latest"), F.col("end_seq"))
        f = frame.join(store.first_seq_at(p.timestamp, name="_at"), ["logstore", "shard"], "left")
        return f, F.coalesce(F.col("_at"), F.col("end_seq"))

    frame = index
    if pos.kind == CHECKPOINT:
        cp = (checkpoints.where(F.col("consumer_group") == consumer_group)
                         .select("logstore", "shard", F.coalesce(F.col("seq"), seq_of("cursor")).alias("_cp")))
        frame = frame.join(cp, ["logstore", "shard"], "left")
        frame, fallback_col = plain(fb, frame)
        start_col = F.coalesce(F.col("_cp"), fallback_col)
    else:
        frame, start_col = plain(pos, frame)
    if stop is not None:
        frame = frame.join(store.first_seq_at(stop, name="_stop"), ["logstore", "shard"], "left")
        stop_col = F.coalesce(F.col("_stop"), F.col("end_seq"))
    else:
        stop_col = F.lit(None).cast("long")
    return frame.select("logstore", "shard", start_col.alias("start_seq"), stop_col.alias("stop_seq"))


def materialized(positions: DataFrame) -> tuple[DataFrame, bool]:
    """Positions computed once (persisted) with their broadcast size check,
    for callers that use them more than once (pass both to :func:`bounded`)."""
    return materialize_small(positions)


#: More log stores than this get no literal bounds.
LITERAL_STORES = 200


def literal_bounds(positions: DataFrame):
    """A condition with literals that every group inside its positions meets:
    per log store the least start and the largest stop.  The scan prunes
    partitions and row groups by it (``PartitionFilters``, ``PushedFilters``);
    a store that nothing is read from falls out.  None for many log stores."""
    stores = (positions.where(F.col("stop_seq").isNull() | (F.col("start_seq") < F.col("stop_seq"))).groupBy("logstore")
              .agg(F.min("start_seq").alias("lo"), F.max(F.coalesce("stop_seq", F.lit(2 ** 63 - 1))).alias("hi"))
              .limit(LITERAL_STORES + 1).collect())
    if len(stores) > LITERAL_STORES:
        return None
    if not stores:
        return F.lit(False)
    cond = F.lit(False)
    for r in stores:
        cond = cond | ((F.col("logstore") == r["logstore"]) & (F.col("seq") >= r["lo"]) & (F.col("seq") < r["hi"]))
    # partitions are pruned by the stores; row groups by a condition on seq alone
    return cond & (F.col("seq") >= min(r["lo"] for r in stores)) & (F.col("seq") < max(r["hi"] for r in stores))


def bounded(groups: DataFrame, positions: DataFrame, fits: bool | None = None) -> DataFrame:
    """The groups inside their shard's ``[start_seq, stop_seq)``.

    ``positions`` has one row per shard (bounded by the shard count, not the
    data), so after a size check it is broadcast and the join keeps the
    groups' partitioning; the positions stay materialised for later uses.
    Their extremes reach the scan as literals, so it skips what lies outside."""
    kept, fits = (positions, fits) if fits is not None else materialize_small(positions)
    extremes = literal_bounds(kept)
    if extremes is not None:
        groups = groups.where(extremes)
    p = maybe_broadcast(kept.select(F.col("logstore").alias("_ls"), F.col("shard").alias("_sh"),
                                    "start_seq", "stop_seq"), fits)
    cond = ((groups["logstore"] == p["_ls"]) & (groups["shard"] == p["_sh"])
            & (groups["seq"] >= p["start_seq"])
            & (p["stop_seq"].isNull() | (groups["seq"] < p["stop_seq"])))
    return groups.join(p, cond, "left_semi")


def stored_positions(spark, folder: str, build) -> DataFrame:
    """The positions in ``folder``; the first call resolves them by ``build()``
    and stores them (one row per shard, written aside and renamed, so a reader
    finds all or nothing)."""
    import uuid

    from ..sources.logstore import hadoop_fs
    fs, final = hadoop_fs(spark, folder)
    if not fs.exists(final.suffix("/_SUCCESS")):
        aside = f"{folder.rstrip('/')}.tmp-{uuid.uuid4().hex}"
        build().coalesce(1).write.parquet(aside)
        _, made = hadoop_fs(spark, aside)
        if not fs.exists(final):
            fs.mkdirs(final.getParent())
            fs.rename(made, final)
        # another start of the same query may have been first: its positions hold
        for left in (made, final.suffix("/" + made.getName())):
            if fs.exists(left):
                fs.delete(left, True)
    return spark.read.schema("logstore string, shard int, start_seq long, stop_seq long").parquet(folder)


def read_from(groups: DataFrame, positions: DataFrame, since: int | None = None) -> DataFrame:
    """The groups at or after their shard's ``start_seq``; a shard without a
    position is read from its beginning, or from the write time ``since``."""
    kept, fits = materialize_small(positions.select(F.col("logstore").alias("_ls"), F.col("shard").alias("_sh"), "start_seq"))
    p = maybe_broadcast(kept, fits)
    joined = groups.join(p, (groups["logstore"] == p["_ls"]) & (groups["shard"] == p["_sh"]), "left")
    late = F.lit(True) if since is None else F.col("start_seq").isNotNull() | (F.col("cursor_time") >= seconds_ntz(since))
    return joined.where((F.col("seq") >= F.coalesce("start_seq", F.lit(0))) & late).select(*groups.columns)


def finished_shards(shards: DataFrame, progress: DataFrame) -> DataFrame:
    """A shard is finished when it is read-only and the consumer's next
    position has reached its end, or when it no longer exists (a consumer
    has a position for it, the shard table has no row).  ``progress``:
    ``logstore, shard, next_seq``."""
    joined = shards.join(progress, ["logstore", "shard"], "full")
    gone = F.col("status").isNull()
    done = gone | ((F.col("status") == "readonly")
                   & (F.coalesce(F.col("next_seq"), F.lit(-1)) >= F.col("end_seq")))
    return joined.select("logstore", "shard", "status", "end_seq",
                         F.col("next_seq"), done.alias("finished"))
