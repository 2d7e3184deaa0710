"""Data model of a log store kept as a Spark table.

A log store table holds one row per *log group*, partitioned on disk by
``logstore`` and ``shard``.  ``seq`` is the dense position of the group in its
shard (the cursor); ``cursor`` is its opaque text form, base64 of the decimal
text of ``seq``.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's for right results:
# metadata field names read by the decoder, and those honoured by the encoder.
FIELD_TIME = "__time__"
FIELD_TOPIC = "__topic__"
FIELD_SOURCE = "__source__"
FIELD_SHARD = "__shard__"
FIELD_CURSOR = "__cursor__"
FIELD_LOGSTORE = "__logstore__"
FIELD_HASH_KEY = "__hash_key__"
DECODE_METADATA = (FIELD_TIME, FIELD_TOPIC, FIELD_SOURCE, FIELD_SHARD, FIELD_CURSOR)
ENCODE_METADATA = (FIELD_TIME, FIELD_TOPIC, FIELD_SOURCE, FIELD_LOGSTORE, FIELD_HASH_KEY)
TAG_PREFIX = "__tag__:"
SHARD_READWRITE = "readwrite"
SHARD_READONLY = "readonly"

CONTENT = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])
LOG = T.StructType([
    T.StructField("time", T.IntegerType()),
    T.StructField("time_ns", T.IntegerType()),
    T.StructField("contents", T.ArrayType(CONTENT)),
])
LOG_GROUP = T.StructType([
    T.StructField("logstore", T.StringType()),
    T.StructField("shard", T.IntegerType()),
    T.StructField("seq", T.LongType()),
    T.StructField("cursor", T.StringType()),
    T.StructField("next_cursor", T.StringType()),
    T.StructField("cursor_time", T.TimestampNTZType()),
    T.StructField("topic", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    T.StructField("logs", T.ArrayType(LOG)),
])
SHARDS = T.StructType([
    T.StructField("logstore", T.StringType()),
    T.StructField("shard", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("begin_seq", T.LongType()),
    T.StructField("end_seq", T.LongType()),
])
CONSUMER_GROUPS = T.StructType([
    T.StructField("consumer_group", T.StringType()),
    T.StructField("logstore", T.StringType()),
    T.StructField("shard", T.IntegerType()),
    T.StructField("cursor", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def cursor_of(seq: Column | str) -> Column:
    """Opaque cursor text of a numeric position: base64 of its decimal text."""
    c = F.col(seq) if isinstance(seq, str) else seq
    return F.base64(c.cast("string").cast("binary"))


def seq_of(cursor: Column | str) -> Column:
    """Inverse of :func:`cursor_of`; NULL for text that is not such a cursor."""
    c = F.col(cursor) if isinstance(cursor, str) else cursor
    return F.try_to_binary(c, F.lit("base64")).cast("string").try_cast("bigint")


def epoch_micros(ts: Column) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ, without the session zone."""
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), ts)


def ntz_from_micros(micros: Column) -> Column:
    """TIMESTAMP_NTZ at ``micros`` since the epoch, without the session zone."""
    return F.timestamp_add("MICROSECOND", micros, F.expr(EPOCH_NTZ))


def consumer_group_present(name: str | None) -> bool:
    """A consumer group is configured when the name is neither null nor empty."""
    return name is not None and name != ""


def floor_div(c: Column, n: int) -> Column:
    """Exact integer floor division (no detour through DOUBLE)."""
    return F.call_function("div", c - F.pmod(c, F.lit(n)), F.lit(n))
