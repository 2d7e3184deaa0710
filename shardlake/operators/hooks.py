"""User hooks (U1-U6): where opaque user code plugs into decode and encode.

The built-in decode and encode are column expressions; these hooks are for
logic a user brings as Python.  They run Arrow-batched (``mapInPandas`` /
``pandas_udf``) inside the tasks that already hold the partition: no
shuffle, no row-at-a-time Python, nothing on the driver.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import CONTENT


def deserialize_with(groups: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame],
                     schema: T.StructType | str) -> DataFrame:
    """A row-generating deserializer: ``fn`` gets a batch of log-group
    rows (or exploded log rows) as pandas and returns any number of output
    rows per input row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield fn(b)
    return groups.mapInPandas(run, schema)


def decode_value_with(fn: Callable[[pd.Series], pd.Series], return_type: T.DataType | str) -> Callable[..., Column]:
    """A one-result deserializer applied to a column, vectorised."""
    return F.pandas_udf(fn, return_type)


RECORD_SCHEMA = T.StructType([
    T.StructField("logstore", T.StringType()), T.StructField("topic", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("hash_key", T.StringType()),
    T.StructField("time", T.IntegerType()), T.StructField("time_ns", T.IntegerType()),
    T.StructField("contents", T.ArrayType(CONTENT)),
])


def serialize_with(rows: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """A row-generating serializer: ``fn`` returns record rows
    (``RECORD_SCHEMA``; ``contents`` as lists of ``{key, value}``), any
    number per input row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield fn(b)
    return rows.mapInPandas(run, RECORD_SCHEMA)


def serialize_groups_with(rows: DataFrame, group: Column) -> DataFrame:
    """U4: a group serializer given as an expression that yields the group
    struct (topic, source, tags, logs) of each element."""
    return rows.select(group.alias("group")).select("group.*")


def with_partitioner(records: DataFrame, hash_key: Column) -> DataFrame:
    """A partitioner: the hash key of each record from an expression
    over the record (e.g. ``route.hash_key_md5``)."""
    return records.withColumn("hash_key", hash_key)


def with_assigner(shards: DataFrame, task: Column) -> DataFrame:
    """A shard assigner: the task of each shard from an expression over
    the shard table (``logstore, shard, status``; window functions allowed)."""
    return shards.withColumn("task", task.cast("int"))
