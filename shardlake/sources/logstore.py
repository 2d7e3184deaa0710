"""Log store tables on disk: Parquet partitioned by ``logstore, shard``.

Writing sorts each shard's files by ``seq`` so Parquet min/max statistics
prune position ranges; reading selects log stores by name, list or full-match
pattern on the partition column (partition pruning), for batch or streaming.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import LOG_GROUP


def write_log_store(groups: DataFrame, root: str, mode: str = "append", placed: bool = False) -> None:
    """Append (or overwrite) log groups, positions included, under ``root``.
    ``placed``: they lie in range partitions on their positions already.

    Files are range partitioned on ``(logstore, shard, seq)``, so each covers
    a narrow ``seq`` range and Parquet min/max statistics prune position
    bounds; the store's manifest (``sources.manifest``) lists them."""
    from .manifest import append_positioned
    spark = groups.sparkSession
    fs, path = hadoop_fs(spark, root)
    if mode == "overwrite" and fs.exists(path):
        fs.delete(path, True)
    append_positioned(groups, root, placed)
    fs.create(path.suffix("/_SUCCESS"), True).close()


def hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def materialize_log_store(spark: SparkSession, root: str, build, finish=None, placed: bool = False) -> str:
    """Write ``build()`` as a log store at ``root`` once; later calls reuse
    it (``placed``: see ``write_log_store``).  ``finish(folder)`` may add to it before it is in place.  The table is written next to ``root`` and renamed into place, so a
    reader never sees a half-written store and an interrupted build is
    redone."""
    fs, final = hadoop_fs(spark, root)
    if fs.exists(final.suffix("/_SUCCESS")):
        return root
    import uuid
    tmp = f"{root}.tmp-{uuid.uuid4().hex}"
    from ..plans.cache import scoped
    with scoped():
        write_log_store(build(), tmp, placed=placed)
    if finish is not None:
        finish(tmp)
    _, tmp_path = hadoop_fs(spark, tmp)
    # another builder may have finished meanwhile: keep its store.  (A rename
    # onto an existing folder would move this copy *inside* it.)
    if not fs.exists(final):
        fs.rename(tmp_path, final)
    nested = final.suffix("/" + tmp_path.getName())
    for leftover in (tmp_path, nested):
        if fs.exists(leftover):
            fs.delete(leftover, True)
    if not fs.exists(final.suffix("/_SUCCESS")):
        raise OSError(f"could not move the log store into {root}")
    return root


def full_match(name: Column, pattern: str) -> Column:
    """The regular expression must match the whole name."""
    return name.rlike(f"^(?:{pattern})$")


def select_logstores(groups: DataFrame, logstore: str | Sequence[str] | None = None,
                     pattern: str | None = None) -> DataFrame:
    """One name, a list of names, or a full-match pattern."""
    if logstore is not None and pattern is not None:
        raise ValueError("give a log store (or list) or a pattern, not both")
    if isinstance(logstore, str):
        if logstore == "":
            raise ValueError("logstore must not be empty")
        return groups.where(F.col("logstore") == logstore)
    if logstore is not None:
        names = list(logstore)
        if not names or any(n is None or n == "" for n in names):
            raise ValueError("logstore list must not be empty or hold empty names")
        return groups.where(F.col("logstore").isin(names))
    if pattern is not None:
        return groups.where(full_match(F.col("logstore"), pattern))
    return groups


def read_log_store(spark: SparkSession, root: str, logstore: str | Sequence[str] | None = None,
                   pattern: str | None = None) -> DataFrame:
    """Batch scan of a log store table with log store selection."""
    from .manifest import settle
    settle(spark, root)
    df = spark.read.schema(LOG_GROUP).parquet(root)
    return select_logstores(df, logstore, pattern).select(*[f.name for f in LOG_GROUP.fields])


def stream_log_store(spark: SparkSession, root: str, logstore: str | Sequence[str] | None = None,
                     pattern: str | None = None, max_files_per_trigger: int | None = None,
                     max_bytes_per_trigger: int | None = None) -> DataFrame:
    """The same table as a stream.  New files, and new shard
    directories, are picked up by the file source; the read size per trigger
    is bounded by files or bytes; positions live in the query checkpoint."""
    reader = spark.readStream.schema(LOG_GROUP)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    df = reader.parquet(root)
    return select_logstores(df, logstore, pattern).select(*[f.name for f in LOG_GROUP.fields])


def records_to_groups(records: DataFrame, shards: DataFrame, ends: DataFrame | None = None,
                      order: Sequence[str] = ("time",), max_lines: int = 4096,
                      max_bytes: int | None = 3 * 1024 * 1024, write_time: str | None = None) -> DataFrame:
    """K7-K11 and positions: encoded records (``logstore, topic, source,
    hash_key, time, time_ns, contents``) as log-group rows (``LOG_GROUP``).

    * shard: the key range holding the record's hash key, else a stable hash
      (``shards``: ``logstore, shard`` of the target stores, one row each);
    * groups: the records of one ``(logstore, shard, topic, source)`` packed
      greedily by ``max_lines`` / ``max_bytes`` in ``order`` (bounded collects);
    * positions: a shard's groups follow its current end (``ends``:
      ``logstore, shard, end_seq``; else from 0), dense in group order, with
      ``cursor``, ``next_cursor`` and the write time as ``cursor_time``."""
    from ..model import cursor_of
    from ..operators.packing import pack_greedy
    from ..operators.route import shard_by_hash_key, shard_key_ranges
    from ..plans.broadcast import checked_broadcast
    from ..plans.numbering import largest_key_rows, position_within

    keys = ["logstore", "shard", "topic", "source"]
    routed = shard_by_hash_key(records, shard_key_ranges(shards)).withColumn("_tie", F.xxhash64("contents"))
    # records of the largest shard: bounds both the records of any packing
    # key and the groups of any shard, so it is measured once
    per_shard = largest_key_rows(routed, ["logstore", "shard"])
    sort_keys = [*order, "_tie"]
    packed = pack_greedy(routed, sort_keys, max_lines=max_lines, max_bytes=max_bytes, keys=keys,
                         largest=per_shard)
    entry = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(sort_keys)],
                     F.col("time").alias("time"), F.col("time_ns").alias("time_ns"),
                     F.col("contents").alias("contents"))
    grouped = packed.groupBy(*keys, "group_end").agg(
        F.sort_array(F.collect_list(entry)).alias("_logs"))
    logs = F.transform("_logs", lambda e: F.struct(e["time"].alias("time"), e["time_ns"].alias("time_ns"),
                                                   e["contents"].alias("contents")))
    groups = grouped.select(*keys, "group_end", logs.alias("logs"))
    numbered = position_within(groups, ["logstore", "shard"], ["topic", "source", "group_end"],
                               out="_gpos", largest=per_shard)
    if ends is not None:
        numbered = numbered.join(checked_broadcast(ends.select("logstore", "shard", "end_seq")),
                                 ["logstore", "shard"], "left")
    else:
        numbered = numbered.withColumn("end_seq", F.lit(None).cast("long"))
    seq = F.coalesce(F.col("end_seq"), F.lit(0)) + F.col("_gpos")
    now = F.lit(write_time).cast("timestamp_ntz") if write_time else F.localtimestamp()
    out = numbered.select(
        "logstore", "shard", seq.alias("seq"), cursor_of(seq).alias("cursor"),
        cursor_of(seq + 1).alias("next_cursor"), now.alias("cursor_time"), "topic", "source",
        F.create_map().cast("map<string,string>").alias("tags"), "logs")
    return out.select(*[F.col(f.name).cast(f.dataType) for f in LOG_GROUP.fields])


def append_records(records: DataFrame, root: str, shards: DataFrame, order: Sequence[str] = ("time",),
                   max_lines: int = 4096, max_bytes: int | None = 3 * 1024 * 1024,
                   write_time: str | None = None, key: tuple[str, int] | None = None) -> None:
    """K6-K11, then write: append encoded records to the log store at
    ``root`` (see :func:`records_to_groups`), after each shard's current end.

    The ends come from the store's manifest, and the append becomes part of
    the store by one commit to it: writers at the same time get positions of
    their own.  An append with a ``key`` (writer, batch) that was committed
    before adds nothing; one without is delivered at least once."""
    from ..plans.cache import scoped
    from .manifest import append_behind

    with scoped():
        append_behind(records_to_groups(records, shards, None, order, max_lines, max_bytes, write_time), root, key)
