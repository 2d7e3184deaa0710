"""Delivery checks (A1-A3): missing, unexpected and duplicate records.

Aggregates only: each check shuffles on the id once, after a partial
aggregate (map-side combine), so a hot id costs one row per task, not one
row per copy.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_and_unexpected(expected: DataFrame, delivered: DataFrame, key: str) -> DataFrame:
    """A1: ids expected but not delivered (``missing``) and delivered but not
    expected (``unexpected``).  Both sides are tagged and grouped by id in
    one shuffle; partial aggregation folds the copies of an id map-side."""
    tagged = (expected.select(F.col(key), F.lit(1).alias("_e"), F.lit(0).alias("_d"))
              .unionByName(delivered.select(F.col(key), F.lit(0).alias("_e"), F.lit(1).alias("_d"))))
    per_id = tagged.groupBy(key).agg(F.max("_e").alias("_e"), F.max("_d").alias("_d"))
    kind = F.when(F.col("_e") == 1, F.lit("missing")).otherwise(F.lit("unexpected"))
    return per_id.where(F.col("_e") != F.col("_d")).select(kind.alias("kind"), key)


def duplicates(delivered: DataFrame, key: str) -> DataFrame:
    """A2: ids delivered more than once, with their copy count."""
    return (delivered.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
                     .where(F.col("copies") > 1))


def duplicate_summary(delivered: DataFrame, key: str, by: tuple[str, ...] = ()) -> DataFrame:
    """A2: reads, distinct ids, and duplicates = reads - distinct (per
    ``by``).  Two partial aggregates: copies of a hot id are combined
    map-side before the shuffle."""
    per_id = delivered.groupBy(*by, key).agg(F.count(F.lit(1)).alias("c"))
    return per_id.groupBy(*by).agg(F.sum("c").alias("reads"), F.count(F.lit(1)).alias("distinct_ids"),
                                   (F.sum("c") - F.count(F.lit(1))).alias("duplicates"))


def dedup_by(delivered: DataFrame, key: str, by: tuple[str, ...] = ("logstore",)) -> DataFrame:
    """A3: one row per sequence number (any copy: copies are equal).  A
    sequence number names a log within its log store, so the store is part
    of the key."""
    return delivered.dropDuplicates([*[b for b in by if b in delivered.columns], key])


def dedup_stream(delivered: DataFrame, key: str, event_time: str = "event_time", delay: str = "1 hour",
                 by: tuple[str, ...] = ("logstore",)) -> DataFrame:
    """A3 on a stream: drop the copies of a sequence number that arrive
    within ``delay`` of the first one (state is kept per key only that long,
    so it stays bounded).  ``event_time`` must be a TIMESTAMP column."""
    keys = [*[b for b in by if b in delivered.columns], key]
    return delivered.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
