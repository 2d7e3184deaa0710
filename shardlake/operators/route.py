"""Routing and batching of records.

* hash key -> shard: the 32 hex digit key falls into one shard's key range.
  With equal division the range is found by arithmetic on the key's first 32
  bits (no join); for explicit ranges a broadcast join on the log store with a
  range condition (one row per shard on the small side).
* records without a key get a stable shard from a hash of their contents, so
  a rerun after a lost executor writes the same shard.
* batching into groups: by line count exactly, by bytes with running sums.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..model import floor_div
from ..plans.broadcast import checked_broadcast
from ..plans.numbering import position_within

KEY_SPACE_BITS = 32  # key prefix used for range arithmetic


def hash_key_md5(c: Column | str) -> Column:
    """K8: MD5 of the text as 32 lower-case hex digits (zero padded)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.md5(col.cast("string"))


def full_key(hash_key: Column) -> Column:
    """A hash key as 32 lower-case hex digits, short ones padded right.  A key
    that is not 1 to 32 hex digits is an error; NULL stays NULL."""
    good = hash_key.isNull() | hash_key.rlike("^[0-9a-fA-F]{1,32}$")
    return F.when(good, F.rpad(F.lower(hash_key), 32, "0")).otherwise(
        F.raise_error(F.concat(F.lit("Not a hash key of 1 to 32 hex digits: "), hash_key)).cast("string"))


def key_prefix(hash_key: Column) -> Column:
    """First 32 bits of a hex hash key as a number (short keys padded right)."""
    return F.conv(full_key(hash_key).substr(1, 8), 16, 10).cast("long")


def bucket_of_key(hash_key: Column, n: int | Column) -> Column:
    """K9 / equal division: ``prefix * n div 2^32`` -- the index of the
    equal-width key range holding the key."""
    nn = n if isinstance(n, Column) else F.lit(n)
    return floor_div(key_prefix(hash_key) * nn, 1 << KEY_SPACE_BITS).cast("int")


def begin_key(shard_index: Column, n: int | Column) -> Column:
    """Begin key (32 hex digits) of range ``shard_index`` of ``n`` equal ranges."""
    nn = n if isinstance(n, Column) else F.lit(n)
    prefix = F.call_function("div", shard_index.cast("long") * F.lit(1 << KEY_SPACE_BITS) + nn - 1, nn)
    return F.concat(F.lpad(F.lower(F.hex(prefix)), 8, "0"), F.lit("0" * 24))


def adjust_hash_key(hash_key: Column, buckets: int) -> Column:
    """K9: the begin key of the equal-width bucket (of ``buckets``) holding
    ``hash_key``; NULL stays NULL."""
    return F.when(hash_key.isNotNull(), begin_key(bucket_of_key(hash_key, buckets), buckets))


def shard_key_ranges(shards: DataFrame) -> DataFrame:
    """Explicit key ranges per shard: equal division of each log store's key
    space in shard order (``begin_key`` inclusive, ``end_key`` exclusive,
    the last one open)."""
    w = Window.partitionBy("logstore").orderBy("shard")
    n = F.count(F.lit(1)).over(Window.partitionBy("logstore"))
    k = F.row_number().over(w) - 1
    return (shards.select("logstore", "shard", k.alias("_k"), n.alias("_n"))
                  .select("logstore", "shard", begin_key(F.col("_k"), F.col("_n")).alias("begin_key"),
                          F.when(F.col("_k") + 1 < F.col("_n"), begin_key(F.col("_k") + 1, F.col("_n")))
                          .alias("end_key")))


COARSE_HEX = 3                      # coarse key buckets for the range join
COARSE_BUCKETS = 16 ** COARSE_HEX


def coarse_bucket(hash_key: Column) -> Column:
    """The first ``COARSE_HEX`` hex digits of a full key as a number."""
    return F.conv(hash_key.substr(1, COARSE_HEX), 16, 10).cast("int")


def shard_by_hash_key(records: DataFrame, ranges: DataFrame, fallback_shards: int | None = None) -> DataFrame:
    """K7: shard of each record: the range holding its ``hash_key``; records
    without a key get ``pmod(xxhash64(time, contents), shards of its log
    store)`` so reruns agree.  A record whose log store has no shard in
    ``ranges`` (and no ``fallback_shards``) cannot be delivered: an error.

    ``ranges`` has one row per shard.  Each range is listed under every
    coarse key bucket it spans (at most ``shards + 4096`` rows per log
    store), and records join on ``(logstore, bucket)``: a record is checked
    against the one or two ranges of its bucket, not against every shard.
    The table is broadcast after a size check."""
    end_bucket = F.when(F.col("end_key").isNull(), F.lit(COARSE_BUCKETS - 1)).otherwise(
        coarse_bucket(full_key(F.col("end_key"))))
    r = ranges.select(F.col("logstore").alias("_ls"), F.col("shard").alias("_shard"),
                      full_key(F.col("begin_key")).alias("_b"), full_key(F.col("end_key")).alias("_e"),
                      F.explode(F.sequence(coarse_bucket(full_key(F.col("begin_key"))), end_bucket)).alias("_bucket"))
    counts = ranges.groupBy(F.col("logstore").alias("_ls2")).agg(F.count(F.lit(1)).alias("_nshards"))
    key = full_key(F.col("hash_key"))
    with_key = records.join(
        checked_broadcast(r),
        (records["logstore"] == r["_ls"]) & (coarse_bucket(key) == r["_bucket"])
        & (key >= r["_b"]) & (r["_e"].isNull() | (key < r["_e"])),
        "left")
    with_n = with_key.join(checked_broadcast(counts), with_key["logstore"] == counts["_ls2"], "left")
    nshards = F.coalesce(F.col("_nshards"), F.lit(fallback_shards)) if fallback_shards else F.col("_nshards")
    no_key_shard = F.pmod(F.xxhash64(F.col("time"), F.col("contents")), nshards).cast("int")
    found = F.when(key.isNull(), no_key_shard).otherwise(F.col("_shard"))
    unknown = F.concat(F.lit("No shard for a record of log store "), F.coalesce(F.col("logstore"), F.lit("NULL")))
    shard = F.coalesce(found, F.raise_error(unknown).cast("int"))
    return with_n.withColumn("shard", shard).drop("_ls", "_shard", "_b", "_e", "_bucket", "_ls2", "_nshards")


def record_bytes(contents: Column | str = "contents") -> Column:
    """Size of a record's contents: bytes of keys and values."""
    arr = F.col(contents) if isinstance(contents, str) else contents
    return F.aggregate(arr, F.lit(0).cast("long"),
                       lambda acc, kv: acc + F.octet_length(kv["key"]) + F.coalesce(F.octet_length(kv["value"]), F.lit(0)))


def pack_groups(records: DataFrame, order: Sequence[str], max_lines: int = 4096,
                max_bytes: int | None = 3 * 1024 * 1024,
                keys: Sequence[str] = ("logstore", "topic", "source"), largest: int | None = None) -> DataFrame:
    """Batch records sharing ``keys`` into groups of at most
    ``max_lines`` in ``order`` (exact, skew-safe numbering); with
    ``max_bytes`` a line block is cut further by its running byte count: the
    records between two multiples of ``max_bytes`` are one group, and a record
    that lies across a multiple is a group of its own, so only a single record
    can be larger than ``max_bytes``.  Adds ``line_block`` and ``byte_block``;
    records with the same ``keys`` and pair form one group.

    The byte sums run over one line block (at most ``max_lines`` rows), so a
    hot key is spread over many windows and no window grows with the data."""
    keys, order = list(keys), list(order)
    out = position_within(records, keys, order, out="_pos", largest=largest)
    out = out.withColumn("line_block", floor_div(F.col("_pos"), max_lines))
    if max_bytes:
        w = (Window.partitionBy(*keys, "line_block").orderBy("_pos")
                   .rowsBetween(Window.unboundedPreceding, -1))
        cum = F.coalesce(F.sum(record_bytes()).over(w), F.lit(0))
        out = out.withColumn("_bytes", record_bytes()).withColumn("_before", cum)
        first = floor_div(F.col("_before"), max_bytes)
        last = floor_div(F.col("_before") + F.greatest(F.col("_bytes"), F.lit(1)) - 1, max_bytes)
        out = out.withColumn("byte_block", 2 * first + (last > first).cast("long")).drop("_bytes", "_before")
    else:
        out = out.withColumn("byte_block", F.lit(0).cast("long"))
    return out.drop("_pos")
