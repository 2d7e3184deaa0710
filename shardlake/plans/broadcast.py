"""Size-checked broadcast of the small side of a join.

The small tables joined to the data here (positions, key ranges, task
assignments, per-partition offsets) have one row per shard, per log store
or per (partition, key): their size follows the shard count, not the data.
That bound is still checked at run time: the small side is materialised
(persisted under a plan of its own, ``plans.cache``; a lost block is
recomputed from that plan),
counted, and broadcast only when it has at most ``max_rows`` rows
(``shardlake.broadcast.maxRows``, default 2,000,000, a few tens of MB for
these narrow rows).  Beyond that the join runs as a shuffle join, where
adaptive execution splits skewed partitions.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cache import persist_fresh

MAX_BROADCAST_ROWS = 2_000_000
CONF_KEY = "shardlake.broadcast.maxRows"


def materialize_small(df: DataFrame, max_rows: int | None = None) -> tuple[DataFrame, bool]:
    """``(df persisted, fits)``: ``fits`` when it has at most ``max_rows`` rows."""
    spark = df.sparkSession
    limit = max_rows if max_rows is not None else int(spark.conf.get(CONF_KEY, str(MAX_BROADCAST_ROWS)))
    kept = persist_fresh(df)
    return kept, kept.count() <= limit


def maybe_broadcast(df: DataFrame, fits: bool) -> DataFrame:
    """The broadcast hint when the size check passed, else the plain side."""
    return F.broadcast(df) if fits else df


def checked_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Materialise, check the size, and hint a broadcast only if it fits."""
    kept, fits = materialize_small(df, max_rows)
    return maybe_broadcast(kept, fits)
