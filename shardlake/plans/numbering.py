"""Dense positions within a key, without funnelling a hot key into one task.

``row_number() over (partition by shard order by ...)`` puts every row of a
shard into one task; one shard may hold a third of a log store.  So the
largest key is measured first: below a bound the window is used; above it
the rows are range-partitioned on ``keys + order`` (a hot key is cut into
many ranges), numbered inside each range partition, and shifted by the
number of rows of the same key in earlier partitions.

The per-(partition, key) count table has at most ``partitions + distinct keys``
rows (a range partition holds one contiguous key range, so only its first and
last key can also appear elsewhere).  Keys here are shard identities
(``logstore, shard``) or a similarly small set, so the table is a few MB even
for 100k partitions and 100k shards; it is broadcast after a size check
(``plans.broadcast``), else joined with a shuffle.

``order`` must make the order unique inside a key (add an id as tie breaker):
both uses of the range-partitioned rows must see the same order.

Both uses must also see the same *partitioning*: two range exchanges of the
same rows sample their bounds independently and may cut differently.  So the
range-partitioned rows are persisted once and both branches read them; a lost
block is recomputed from that one exchange (same bounds, same sorted order),
so the numbering survives executor loss.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .broadcast import checked_broadcast
from .cache import persist_fresh, release_persisted  # noqa: F401  (re-exported)

HOT_KEY_ROWS = 2_000_000
HOT_KEY_CONF = "shardlake.numbering.hotKeyRows"


def largest_key_rows(df: DataFrame, keys: Sequence[str]) -> int:
    """Row count of the largest key: a partial aggregate (one row per key
    and task crosses the shuffle) reduced to one number."""
    top = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    return int(top or 0)


def position_within(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    out: str = "pos", partitions: int | None = None,
                    hot_key_rows: int | None = None, largest: int | None = None) -> DataFrame:
    """Add ``out`` = 0-based rank of each row inside ``keys`` by ``order``.

    The size of the largest key is measured first.  When no key holds more
    than ``hot_key_rows`` rows (``shardlake.numbering.hotKeyRows``, default
    2,000,000), one window per key is bounded and ``row_number`` is used;
    otherwise the range-partitioned numbering below spreads the hot keys.
    ``largest``: a known upper bound of the largest key (skips the measure)."""
    spark = df.sparkSession
    keys, order = list(keys), list(order)
    limit = hot_key_rows if hot_key_rows is not None else int(spark.conf.get(HOT_KEY_CONF, str(HOT_KEY_ROWS)))
    top = largest if largest is not None else largest_key_rows(df, keys)
    if top <= limit:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(out, (F.row_number().over(w) - 1).cast("long"))
    return _position_by_ranges(df, keys, order, out, partitions or shuffle_partitions(spark))


def _position_by_ranges(df: DataFrame, keys: list[str], order: list[str], out: str, n: int) -> DataFrame:
    """Hot keys: range partitions on ``keys + order``, local numbering, and
    per-(partition, key) offsets (see the module notes)."""
    ranged = (df.repartitionByRange(n, *keys, *order)
                .sortWithinPartitions(*keys, *order)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = persist_fresh(ranged)
    counts = (ranged.groupBy("_pid", *keys)
                    .agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n")))
    earlier = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    renamed = [f"_k{i}" for i in range(len(keys))]
    offsets = counts.select(F.col("_pid").alias("_opid"),
                            *[F.col(k).alias(r) for k, r in zip(keys, renamed)],
                            "_first",
                            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    # null-safe: rows whose key is NULL form a key of their own, like in GROUP BY
    cond = [F.col("_pid") == F.col("_opid")] + [F.col(k).eqNullSafe(F.col(r)) for k, r in zip(keys, renamed)]
    return (ranged.join(checked_broadcast(offsets), cond)
                  .withColumn(out, F.col("_mid") - F.col("_first") + F.col("_before"))
                  .drop("_pid", "_mid", "_opid", "_first", "_before", *renamed))
