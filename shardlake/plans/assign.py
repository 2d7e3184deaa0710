"""Shard-to-task assignment (R14-R16) as columns over the shard table.

The shard table has one row per shard, so the windows here run over a
handful of rows.  Applying an assignment to the data is a join of that small
table (broadcast after a size check) plus ``repartition(n, 'task')`` for shard affinity.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .broadcast import checked_broadcast


def modulo_task(shard: Column | str, n: int) -> Column:
    """``((shard % n) + n) % n``, i.e. the non-negative remainder."""
    s = F.col(shard) if isinstance(shard, str) else shard
    return F.pmod(s, F.lit(n)).cast("int")


def balanced_tasks(shards: DataFrame, n: int, order: tuple[str, ...] = ("logstore", "shard")) -> DataFrame:
    """Fill readers in turn up to ``ceil(total / n)`` shards each: the
    k-th shard (0-based, in ``order``) goes to reader ``k div ceil(total/n)``."""
    w = Window.orderBy(*order)
    total = F.count(F.lit(1)).over(Window.partitionBy())
    per_reader = F.floor((total + n - 1) / n)
    return shards.withColumn("task", F.floor((F.row_number().over(w) - 1) / per_reader).cast("int"))


def writable_rank_tasks(shards: DataFrame, n: int) -> DataFrame:
    """R16 (the custom assigner of the samples): read-only shards by
    ``shard % n``; writable ones by their rank among the log store's shards
    (sorted by id), modulo ``n``."""
    rank = F.row_number().over(Window.partitionBy("logstore").orderBy("shard")) - 1
    task = F.when(F.col("status") == "readonly", F.col("shard") % n).otherwise(F.pmod(rank, F.lit(n)))
    return shards.withColumn("task", task.cast("int"))


def with_task(groups: DataFrame, tasks: DataFrame, n: int) -> DataFrame:
    """Attach the ``task`` of each group's shard and co-locate by it."""
    t = checked_broadcast(tasks.select("logstore", "shard", "task"))
    return groups.join(t, ["logstore", "shard"]).repartition(n, "task")
