"""Rows to log records (K1-K5, K10, K12-K14), as column expressions.

A *record* row has ``logstore, topic, source, hash_key, time, time_ns,
contents`` (contents = ordered ``array<struct<key, value>>``).  Every
non-metadata column becomes one content with its text form; NULL values are
skipped.  The metadata columns ``__time__ __topic__ __source__ __logstore__
__hash_key__`` are not written as contents; when NULL the default stays.
"""
from __future__ import annotations

import time as clock
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.pairs import last_per_key
from ..functions.text import value_text
from ..model import (CONTENT, ENCODE_METADATA, FIELD_HASH_KEY, FIELD_LOGSTORE, FIELD_SOURCE, FIELD_TIME,
                     FIELD_TOPIC, TAG_PREFIX, epoch_micros, floor_div)

RECORD_COLUMNS = ("logstore", "topic", "source", "hash_key", "time", "time_ns", "contents")
INT_MIN, INT_MAX = -2**31, 2**31 - 1
# "blank": empty or only white space, that is controls x09-x0D and x1C-x1F and
# Unicode's separators but the no-break spaces (fixed values)
BLANK = r"^[\x09-\x0D\x1C-\x20\x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}\x{2028}\x{2029}\x{205F}\x{3000}]*\z"


def _trunc_div(c: Column, n: int) -> Column:
    """Integer division toward zero."""
    return F.call_function("div", c, F.lit(n))


def _wrap_int(c: Column) -> Column:
    """Java ``long.intValue()``: keep the low 32 bits, two's complement."""
    low = c.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    return F.when(low >= 2**31, low - F.lit(2**32)).otherwise(low).cast("int")


def _saturate_int(c: Column) -> Column:
    """Java ``(int) double``: NaN -> 0, clamp to the int range, toward zero."""
    d = c.cast("double")
    return F.when(F.isnan(d), F.lit(0)).otherwise(
        F.greatest(F.least(d, F.lit(float(INT_MAX))), F.lit(float(INT_MIN))).cast("int"))


def time_seconds(c: Column, dtype: T.DataType) -> Column:
    """K4: seconds of a ``__time__`` value: timestamp -> epoch milliseconds /
    1000 toward zero; number -> its int value; text -> parsed as an int
    (anything else raises)."""
    if isinstance(dtype, T.TimestampNTZType):
        # epoch milliseconds (floor), then seconds toward zero
        return _trunc_div(floor_div(epoch_micros(c), 1000), 1000).cast("int")
    if isinstance(dtype, T.TimestampType):
        return _trunc_div(F.unix_millis(c), 1000).cast("int")
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
        return c.cast("int")
    if isinstance(dtype, T.LongType):
        return _wrap_int(c)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return _saturate_int(c)
    if isinstance(dtype, T.DecimalType):
        return _wrap_int(c.cast("decimal(38,0)").try_cast("long"))
    text = value_text(c, dtype)
    return F.when(text.rlike(r"^[+-]?[0-9]+$") & text.try_cast("int").isNotNull(), text.try_cast("int")) \
            .otherwise(F.raise_error(F.concat(F.lit("For input string: "), text)).cast("int"))


def time_nanos(c: Column, dtype: T.DataType) -> Column:
    """Sub-second part kept beside the seconds (written as ``time_ns``)."""
    if isinstance(dtype, T.TimestampNTZType):
        us = epoch_micros(c)
    elif isinstance(dtype, T.TimestampType):
        us = F.unix_micros(c)
    else:
        return F.lit(0)
    return (F.pmod(us, F.lit(1000000)) * 1000).cast("int")


def contents_of(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """K1 + K5: ``array<struct<key, value>>`` of the given (default: all
    non-metadata) columns in column order, NULL values left out."""
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    names = [c for c in (columns or df.columns) if c not in ENCODE_METADATA]
    if not names:
        return F.array().cast(T.ArrayType(CONTENT))
    pairs = F.array(*[F.struct(F.lit(n).alias("key"), value_text(F.col(f"`{n}`"), dtypes[n]).alias("value"))
                      for n in names])
    return F.filter(pairs, lambda kv: kv["value"].isNotNull())


def _meta_text(df: DataFrame, name: str) -> Column | None:
    if name not in df.columns:
        return None
    dtype = df.schema[name].dataType
    return value_text(F.col(f"`{name}`"), dtype)


def route_logstore(record_logstore: Column | None, default: str | None) -> Column:
    """K6: the record's log store unless blank (NULL, empty or only
    whitespace), else the default."""
    dflt = F.lit(default).cast("string")
    if record_logstore is None:
        return dflt
    blank = F.coalesce(record_logstore.rlike(BLANK), F.lit(True))
    return F.when(~blank, record_logstore).otherwise(dflt)


def encode_rows(df: DataFrame, default_topic: str = "", default_source: str | None = None,
                default_logstore: str | None = None, now_seconds: int | None = None,
                keep: Sequence[str] = ()) -> DataFrame:
    """K1-K6: one record per row.  ``now_seconds`` is the default time, else
    the time of this call (of each batch for a streaming ``df``).  It is fixed
    here: a record without a hash key is dealt to a shard by its time, and an
    append runs several jobs over its records, which must deal them alike."""
    if now_seconds is None and not df.isStreaming:
        now_seconds = int(clock.time())
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    now = F.lit(now_seconds).cast("int") if now_seconds is not None else F.unix_timestamp().cast("int")
    if FIELD_TIME in df.columns:
        t = F.col(FIELD_TIME)
        time = F.when(t.isNull(), now).otherwise(time_seconds(t, dtypes[FIELD_TIME]))
        nanos = F.when(t.isNull(), F.lit(0)).otherwise(time_nanos(t, dtypes[FIELD_TIME]))
    else:
        time, nanos = now, F.lit(0)
    topic = _meta_text(df, FIELD_TOPIC)
    source = _meta_text(df, FIELD_SOURCE)
    hash_key = _meta_text(df, FIELD_HASH_KEY)
    return df.select(
        *keep,
        route_logstore(_meta_text(df, FIELD_LOGSTORE), default_logstore).alias("logstore"),
        (F.coalesce(topic, F.lit(default_topic)) if topic is not None else F.lit(default_topic))
        .cast("string").alias("topic"),
        (F.coalesce(source, F.lit(default_source)) if source is not None else F.lit(default_source))
        .cast("string").alias("source"),
        (hash_key if hash_key is not None else F.lit(None)).cast("string").alias("hash_key"),
        time.cast("int").alias("time"),
        nanos.cast("int").alias("time_ns"),
        contents_of(df).alias("contents"),
    )


def skip_empty(records: DataFrame) -> DataFrame:
    """K10 (row sink): drop NULL records (no log item).  A record whose log
    item has no contents is still written, as the row sink does."""
    return records.where(F.col("contents").isNotNull())


def drop_null_keys(contents: Column | str = "contents") -> Column:
    """K10 (group writer): contents whose key is NULL are not written."""
    arr = F.col(contents) if isinstance(contents, str) else contents
    return F.filter(arr, lambda kv: kv["key"].isNotNull())


def encode_group(records: DataFrame, group_keys: Sequence[str], tags: Column | None = None,
                 order: Sequence[str] = ("time",), max_logs: int = 4096) -> DataFrame:
    """A group of logs per element: the logs of all records sharing
    ``group_keys`` (one element) in one log group, at most ``max_logs`` logs
    per group (a larger element becomes consecutive groups, ``block``
    0, 1, ... in ``order``).  Tags are kept (deliberate; the legacy writer
    dropped them).

    The split uses the skew-safe numbering, so no key, however large, is
    collected into one task."""
    from ..plans.numbering import position_within
    keys = list(group_keys)
    tie = F.xxhash64(F.col("contents"))
    numbered = position_within(records.withColumn("_tie", tie), keys, [*order, "_tie"], out="_pos")
    numbered = numbered.withColumn("block", floor_div(F.col("_pos"), max_logs))
    # a record without a log item (NULL contents) adds no log to its group
    logs = F.when(F.col("contents").isNotNull(), F.struct(
        F.col("_pos").alias("_pos"), F.col("time").alias("time"), F.col("time_ns").alias("time_ns"),
        drop_null_keys("contents").alias("contents")))
    meta = [c for c in ("logstore", "topic", "source") if c not in keys]
    agg = numbered.groupBy(*keys, "block").agg(
        *[F.first(c).alias(c) for c in meta], F.sort_array(F.collect_list(logs)).alias("_logs"))
    out = agg.select(*keys, "block", *meta, F.transform("_logs", lambda lg: lg.dropFields("_pos")).alias("logs"))
    out = out.where(F.size("logs") > 0)
    if tags is not None:
        out = out.withColumn("tags", tags)
    return out


def encode_flatmap(df: DataFrame, records: Column) -> DataFrame:
    """Zero to many records per row: ``records`` is an array of
    record structs built from the row; one output row per element."""
    return df.select(F.explode(records).alias("r")).select("r.*")


def json_to_group(json_text: Column | str, now_seconds: int | None = None, strict: bool = True) -> Column:
    """A JSON object line to a log group struct: keys starting with
    ``__tag__:`` become tags (prefix removed), the others contents, the last
    value of a repeated key.  Values keep their JSON text (strings unquoted).
    A line that is no JSON object raises, or gives NULL without ``strict``."""
    js = F.col(json_text) if isinstance(json_text, str) else json_text
    now = F.lit(now_seconds).cast("int") if now_seconds is not None else F.unix_timestamp().cast("int")

    def group(entries: Column) -> Column:
        tags = F.map_from_entries(F.transform(F.filter(entries, lambda e: e["key"].startswith(TAG_PREFIX)), lambda e: F.struct(
            F.substr(e["key"], F.lit(len(TAG_PREFIX) + 1)).alias("key"), e["value"].alias("value"))))
        contents = F.filter(entries, lambda e: ~e["key"].startswith(TAG_PREFIX))
        log = F.struct(now.alias("time"), F.lit(0).alias("time_ns"), contents.alias("contents"))
        return F.struct(F.lit(None).cast("string").alias("topic"), F.lit(None).cast("string").alias("source"),
                        tags.alias("tags"), F.array(log).alias("logs"))

    def checked(m: Column) -> Column:
        known = F.when(m.isNotNull(), _bound(last_per_key(F.map_entries(m)), group))
        if not strict:
            return known
        return F.when(js.isNotNull() & m.isNull(), F.raise_error(F.concat(F.lit("Not a JSON object: "), js)).cast(
            "struct<topic:string,source:string,tags:map<string,string>,logs:array<struct<time:int,time_ns:int,"
            "contents:array<struct<key:string,value:string>>>>>")).otherwise(known)

    return _bound(F.from_json(js, T.MapType(T.StringType(), T.StringType())), checked)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used
    (branches of a condition are not merged by the optimizer)."""
    return F.element_at(F.transform(F.array(value), use), 1)
