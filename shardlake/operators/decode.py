"""Log groups to rows.

All of it is column expressions over the group rows: ``posexplode`` of the
logs, higher-order functions over the ordered contents, guarded casts.  No
shuffle, no Python.  Unused declared columns are pruned by Catalyst (so a
strict parse check on an unused column does not run; ``validate`` touches
every column when the full check is wanted).
"""
from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.pairs import last_per_key
from ..functions.parse import UnsupportedType, millis_to_time, parse_value, type_name
from ..model import (FIELD_CURSOR, FIELD_SHARD, FIELD_SOURCE, FIELD_TIME, FIELD_TOPIC,
                     cursor_of, floor_div, ntz_from_micros)

GROUP_COLUMNS = ("logstore", "shard", "seq", "cursor", "next_cursor", "cursor_time", "topic", "source", "tags")


def explode_logs(groups: DataFrame, keep: Iterable[str] = GROUP_COLUMNS) -> DataFrame:
    """One row per log, group order then log order; ``idx`` is the log's
    position in its group."""
    keep = [c for c in keep if c in groups.columns]
    return (groups.select(*keep, F.posexplode("logs").alias("idx", "log"))
                  .select(*keep, F.col("idx").cast("int").alias("idx"),
                          F.col("log.time").alias("time"), F.col("log.time_ns").alias("time_ns"),
                          F.col("log.contents").alias("contents")))


def content(name: str, contents: Column | str = "contents") -> Column:
    """Value of content ``name`` (exact, case-sensitive); the last of
    repeated keys wins; NULL when absent."""
    arr = F.col(contents) if isinstance(contents, str) else contents
    return F.try_element_at(F.filter(arr, lambda kv: kv["key"] == F.lit(name)), F.lit(-1))["value"]


def contents_map(contents: Column | str = "contents") -> Column:
    """Map of the contents, last value per key (no duplicate-key error).
    Pairs without a key have no place in a map."""
    arr = F.col(contents) if isinstance(contents, str) else contents
    return F.map_from_entries(last_per_key(F.filter(arr, lambda kv: kv["key"].isNotNull())))


def _raw_value(name: str, dtype: T.DataType) -> Column:
    if name == FIELD_TOPIC:
        return F.col("topic")
    if name == FIELD_SOURCE:
        return F.col("source")
    if name == FIELD_SHARD:
        return F.col("shard").cast("string")
    if name == FIELD_CURSOR:
        return F.col("cursor")
    if name == FIELD_TIME:
        return F.col("time").cast("string")
    return content(name)


_METADATA = (FIELD_TOPIC, FIELD_SOURCE, FIELD_SHARD, FIELD_CURSOR, FIELD_TIME)


def _event_time_ntz() -> Column:
    """``__time__`` with its nanosecond part, to microseconds."""
    return ntz_from_micros(F.col("time").cast("long") * 1000000 + floor_div(F.col("time_ns").cast("long"), 1000))


def decoded_column(name: str, dtype: T.DataType, strict: bool, raw: Column | None = None) -> Column:
    """The typed column for one declared field of an exploded log row; ``raw``
    is its text where that was extracted before."""
    if name == FIELD_TIME:
        if isinstance(dtype, T.TimestampNTZType):
            return _event_time_ntz()
        if isinstance(dtype, T.TimestampType):
            return F.timestamp_micros(F.col("time").cast("long") * 1000000 + floor_div(F.col("time_ns").cast("long"), 1000))
        if isinstance(dtype, T.DateType):
            # deliberate: seconds to a date (the reference reads them as days)
            return F.date_from_unix_date(floor_div(F.col("time").cast("long"), 86400).cast("int"))
        if hasattr(T, "TimeType") and isinstance(dtype, T.TimeType):
            # deliberate: seconds (and ns) to the time of day (the reference
            # reads the seconds as milliseconds of the day)
            ms = F.pmod(F.col("time").cast("long"), F.lit(86400)) * 1000 + floor_div(F.col("time_ns").cast("long"), 1000000)
            return millis_to_time(ms).cast(dtype)
    return parse_value(_raw_value(name, dtype) if raw is None else raw, dtype, name, strict)


def _check_supported(schema: T.StructType) -> None:
    for f in schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) or \
                type(f.dataType).__name__ in ("DayTimeIntervalType", "YearMonthIntervalType",
                                              "CalendarIntervalType", "NullType", "VariantType"):
            raise UnsupportedType(f"Unsupported field type {type_name(f.dataType)} for field {f.name}")


def as_schema(schema: T.StructType | str) -> T.StructType:
    if isinstance(schema, str):
        return _parse_ddl(schema)
    return schema


def _parse_ddl(ddl: str) -> T.StructType:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame([], ddl).schema


def decode_logs(logs: DataFrame, schema: T.StructType | str, ignore_parse_errors: bool = False,
                keep: Sequence[str] = ()) -> DataFrame:
    """D2-D9 on exploded log rows: one typed column per declared field.

    Two projections: the first extracts each declared content once, the
    second parses its text.  The parse rules use the text several times, so
    the optimizer keeps the two apart."""
    schema = as_schema(schema)
    _check_supported(schema)
    strict = not ignore_parse_errors
    contents = [f.name for f in schema.fields if f.name not in _METADATA]
    raw = {name: f"_raw_{i}" for i, name in enumerate(contents)}
    texts = logs.select("*", *[content(name).alias(alias) for name, alias in raw.items()])
    cols = [decoded_column(f.name, f.dataType, strict, F.col(raw[f.name]) if f.name in raw else None).alias(f.name)
            for f in schema.fields]
    return texts.select(*keep, *cols)


def decode(groups: DataFrame, schema: T.StructType | str, ignore_parse_errors: bool = False,
           keep: Sequence[str] = ()) -> DataFrame:
    """Declared-schema read of log groups: explode, then typed fields."""
    return decode_logs(explode_logs(groups), schema, ignore_parse_errors, keep)


def validate(decoded: DataFrame) -> int:
    """Touch every column so strict parse checks run even for columns a later
    query would prune; returns the row count."""
    counts = [F.count(F.col(c)).alias(f"_{i}") for i, c in enumerate(decoded.columns)]
    return decoded.agg(F.count(F.lit(1)).alias("_n"), *counts).first()["_n"]


def raw_group(groups: DataFrame) -> DataFrame:
    """Group struct with contents as maps (last value per key)."""
    logs = F.transform("logs", lambda lg: F.struct(lg["time"].alias("time"),
                                                   contents_map(lg["contents"]).alias("contents")))
    return groups.select("logstore", "shard", "seq", "cursor", F.struct(
        F.col("source"), F.col("topic"), F.col("tags"), logs.alias("logs")).alias("group"))


def fast_group(groups: DataFrame) -> DataFrame:
    """Group struct with contents as the stored ordered pairs."""
    return groups.select("logstore", "shard", "seq", "cursor", F.struct(
        "source", "topic", "tags", "logs").alias("group"))


def sequence_number(shard: Column | str = "shard", seq: Column | str = "seq",
                    idx: Column | str = "idx") -> Column:
    """``shard|base64(offset)|log index`` for a log at position ``idx``
    of the group at position ``seq``."""
    s = F.col(shard) if isinstance(shard, str) else shard
    q = F.col(seq) if isinstance(seq, str) else seq
    i = F.col(idx) if isinstance(idx, str) else idx
    return F.concat_ws("|", s.cast("string"), cursor_of(q), i.cast("string"))


def with_sequence_number(logs: DataFrame, key: str) -> DataFrame:
    """Add content ``key`` = sequence number to every exploded log."""
    sn = F.struct(F.lit(key).alias("key"), sequence_number().alias("value"))
    return logs.withColumn("contents", F.concat("contents", F.array(sn)))


def tag(name: str) -> Column:
    """A group tag, visible on each log."""
    return F.col("tags")[name]


def content_map_record(logs: DataFrame) -> DataFrame:
    """Time, topic, source, shard, cursor and all contents as a map."""
    return logs.select(
        F.col("time"), F.col("topic"), F.col("source"), F.col("shard"), F.col("cursor"),
        contents_map("contents").alias("fields"))


def log_to_json(contents: Column | str = "contents") -> Column:
    """Contents as a JSON object text (last value per key)."""
    return F.to_json(contents_map(contents))


def extract_field(logs: DataFrame, key: str, keep: Sequence[str] = ()) -> DataFrame:
    """The value of every content ``key`` (repeats included); logs
    without it yield nothing."""
    hits = F.filter("contents", lambda kv: kv["key"] == F.lit(key))
    return logs.select(*keep, F.explode(hits).alias("kv")).select(*keep, F.col("kv.value").alias(key))
