"""Text form of typed values written into log contents (the sink side).

Numbers and booleans use Spark's cast, which prints like Java (``1.0E10``,
``true``).  Decimals keep their scale in plain notation.  Times and
timestamps use the shortest ISO form: ``HH:mm`` when seconds and fraction are
zero, else ``HH:mm:ss``, then 3 or 6 fraction digits (Spark keeps
microseconds), with ``T`` between date and time.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .parse import UnsupportedType, type_name


def iso_timestamp_text(ts: Column) -> Column:
    """Shortest ISO text of a TIMESTAMP_NTZ (``2024-01-01T00:00``, ``..T00:00:01.5`` as ``.500``):
    the full text once, then the zero seconds or zero fraction digits cut off."""
    full = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    n = F.length(full)

    def tail(k: int) -> Column:
        return F.substring(full, -k, k)

    def head(cut: int) -> Column:
        return full.substr(F.lit(1), n - cut)

    return (F.when(tail(10) == ":00.000000", head(10))
             .when(tail(7) == ".000000", head(7))
             .when(tail(3) == "000", head(3))
             .otherwise(full))


def iso_time_text_from_millis(millis: Column) -> Column:
    """Shortest ISO text of a time of day given in milliseconds."""
    ms_all = millis.cast("long")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    h = F.call_function("div", ms_all, F.lit(3600000))
    m = F.pmod(F.call_function("div", ms_all, F.lit(60000)), F.lit(60))
    s = F.pmod(F.call_function("div", ms_all, F.lit(1000)), F.lit(60))
    ms = F.pmod(ms_all, F.lit(1000))
    hm = F.concat(two(h), F.lit(":"), two(m))
    return (F.when((s == 0) & (ms == 0), hm)
             .when(ms == 0, F.concat(hm, F.lit(":"), two(s)))
             .otherwise(F.concat(hm, F.lit(":"), two(s), F.lit("."), F.lpad(ms.cast("string"), 3, "0"))))


def value_text(c: Column, dtype: T.DataType) -> Column:
    """Text written for one typed value (NULL stays NULL)."""
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return c
    if isinstance(dtype, (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                          T.FloatType, T.DoubleType, T.DecimalType, T.DateType)):
        return c.cast("string")
    if hasattr(T, "TimeType") and isinstance(dtype, T.TimeType):
        millis = F.time_diff(F.lit("MILLISECOND"), F.expr("TIME'00:00:00'"), c)
        return iso_time_text_from_millis(millis)
    if isinstance(dtype, T.TimestampNTZType):
        return iso_timestamp_text(c)
    if isinstance(dtype, T.TimestampType):
        return iso_timestamp_text(F.timestamp_add("MICROSECOND", F.unix_micros(c),
                                                  F.expr("timestamp_ntz'1970-01-01 00:00:00'")))
    if isinstance(dtype, T.BinaryType):
        return F.decode(c, "UTF-8")
    raise UnsupportedType(f"Unsupported SQL sink field type: {type_name(dtype)}")
