"""Synthetic load (R17): a sequence number and 12 letters per record, from
the rate source (one row per 10 ms by default), as sink rows."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the letters a synthetic record draws from.
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def letters_of(seq: F.Column, n: int = 12) -> F.Column:
    """``n`` letters derived from the sequence number (a hash per position,
    so reruns give the same text)."""
    picks = [F.substring(F.lit(LETTERS), (F.pmod(F.xxhash64(seq, F.lit(i)), F.lit(26)) + 1).cast("int"), 1)
             for i in range(n)]
    return F.concat(*picks)


def synthetic_load(spark: SparkSession, rows_per_second: int = 100, rows_per_batch: int | None = None) -> DataFrame:
    """A stream of ``seq, text, __time__`` rows; ``rows_per_batch`` uses the
    deterministic micro-batch rate source instead of wall-clock rate."""
    if rows_per_batch:
        src = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch).load()
    else:
        src = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return src.select(F.col("value").alias("seq"), letters_of(F.col("value")).alias("text"),
                      F.col("timestamp").alias("__time__"))
