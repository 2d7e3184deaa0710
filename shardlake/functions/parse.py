"""Typed parsing of log content text, as column expressions.

Each ``parse_*`` returns ``(value, valid)``: the typed value (NULL when the
text is not accepted) and whether the text is accepted.  Spark's casts are
more lenient than the rules logs are decoded with (they trim blanks, take
``yes`` as true, take a zone suffix on a timestamp), so every cast sits behind
a pattern guard.  Nothing here leaves the JVM: no Python UDF.

:func:`parse_value` picks the rule by Spark type; with ``strict`` an accepted
NULL passes, and a non-NULL text that is not accepted raises an error naming
field, value and type.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import EPOCH_NTZ, ntz_from_micros

# Fixed text patterns of the accepted forms.
# integral numbers: optional sign, ASCII digits
INTEGRAL = r"^[+-]?[0-9]+$"
# "integer" for DATE / TIME / TIMESTAMP: optional minus, digits (no plus)
EPOCH_INTEGER = r"^-?[0-9]+$"
# floating point after trimming: sign, NaN / Infinity, decimal or hex form, f/d suffix
FLOATING = (r"^[+-]?(NaN|Infinity|(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
            r"|0[xX]([0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+)[fFdD]?)$")
DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
ISO_TIME = r"^([01][0-9]|2[0-3]):([0-5][0-9])(:([0-5][0-9])(\.([0-9]{1,9}))?)?$"
ISO_DATE_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?$"
JDBC_TIMESTAMP = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?$"
# characters Java's String.trim removes
JAVA_BLANK_EDGES = r"^[\x00-\x20]+|[\x00-\x20]+$"


def _matches(raw: Column, pattern: str) -> Column:
    return F.coalesce(raw.rlike(pattern), F.lit(False))


def parse_boolean(raw: Column) -> tuple[Column, Column]:
    low = F.lower(raw)
    value = F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))
    return value, value.isNotNull()


def parse_integral(raw: Column, dtype: T.DataType) -> tuple[Column, Column]:
    value = F.when(_matches(raw, INTEGRAL), raw.try_cast(dtype))
    return value, value.isNotNull()


def parse_floating(raw: Column, dtype: T.DataType) -> tuple[Column, Column]:
    trimmed = F.regexp_replace(raw, JAVA_BLANK_EDGES, "")
    # Spark does not know the f/d suffix on every path: drop it before the cast
    body = F.regexp_replace(trimmed, "[fFdD]$", "")
    value = F.when(_matches(trimmed, FLOATING), body.try_cast(dtype))
    return value, value.isNotNull()


def parse_decimal(raw: Column, dtype: T.DecimalType) -> tuple[Column, Column]:
    # precision overflow gives NULL, not an error (the text itself is valid)
    ok = _matches(raw, DECIMAL)
    return F.when(ok, raw.try_cast(dtype)), ok


def parse_date(raw: Column) -> tuple[Column, Column]:
    days = F.when(_matches(raw, EPOCH_INTEGER), raw.try_cast("int"))
    iso = F.when(_matches(raw, ISO_DATE), raw.try_cast("date"))
    value = F.coalesce(F.date_from_unix_date(days), iso)
    return value, value.isNotNull()


def parse_time_millis(raw: Column) -> tuple[Column, Column]:
    """TIME as milliseconds of the day: an integer is taken as is, else ISO
    ``HH:mm[:ss[.fffffffff]]`` cut to milliseconds."""
    as_int = F.when(_matches(raw, EPOCH_INTEGER), raw.try_cast("int"))
    iso_ok = _matches(raw, ISO_TIME)
    part = lambda i: F.regexp_extract(raw, ISO_TIME, i)
    frac = F.rpad(part(6), 3, "0").substr(1, 3)
    millis = (part(1).cast("int") * 3600000 + part(2).cast("int") * 60000
              + F.coalesce(F.nullif(part(4), F.lit("")).cast("int"), F.lit(0)) * 1000
              + F.coalesce(F.nullif(frac, F.lit("000")).cast("int"), F.lit(0)))
    value = F.coalesce(as_int, F.when(iso_ok, millis))
    return value, value.isNotNull()


def millis_to_time(millis: Column) -> Column:
    """TIME value of a millisecond-of-day count (NULL outside one day)."""
    ms = millis.cast("long")
    seconds = (F.pmod(ms, F.lit(60000)).cast("decimal(16,6)") / F.lit(1000)).cast("decimal(16,6)")
    value = F.make_time(F.call_function("div", ms, F.lit(3600000)).cast("int"),
                        F.pmod(F.call_function("div", ms, F.lit(60000)), F.lit(60)).cast("int"), seconds)
    return F.when((ms >= 0) & (ms < 86400000), value)


def _cut_fraction(raw: Column) -> Column:
    # Spark keeps microseconds: drop digits 7..9 of the fraction
    return F.regexp_replace(raw, r"(\.[0-9]{6})[0-9]{1,3}$", "$1")


def parse_timestamp_ntz(raw: Column) -> tuple[Column, Column]:
    """Integer = epoch milliseconds; else ISO ``yyyy-MM-ddTHH:mm[:ss[.f]]``
    (no zone); else the JDBC form ``yyyy-[m]m-[d]d hh:mm:ss[.f]``.  Wall
    clock, no session zone involved."""
    millis = F.when(_matches(raw, EPOCH_INTEGER), raw.try_cast("bigint"))
    from_millis = ntz_from_micros(F.try_multiply(millis, F.lit(1000)))
    iso = F.when(_matches(raw, ISO_DATE_TIME), _cut_fraction(raw).try_cast("timestamp_ntz"))
    jdbc = F.when(_matches(raw, JDBC_TIMESTAMP), _cut_fraction(raw).try_cast("timestamp_ntz"))
    value = F.coalesce(from_millis, iso, jdbc)
    return value, value.isNotNull()


def ntz_to_ltz(ntz: Column) -> Column:
    """Read a wall clock as a UTC instant (TIMESTAMP_LTZ), zone-independent."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), ntz))


def parse_binary(raw: Column) -> tuple[Column, Column]:
    value = F.encode(raw, "UTF-8")
    return value, F.lit(True)


class UnsupportedType(TypeError):
    pass


def type_name(dtype: T.DataType) -> str:
    return dtype.simpleString().upper()


def parse_typed(raw: Column, dtype: T.DataType) -> tuple[Column, Column]:
    """``(value, valid)`` of ``raw`` read as ``dtype``."""
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return raw.cast("string"), F.lit(True)
    if isinstance(dtype, T.BooleanType):
        return parse_boolean(raw)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return parse_integral(raw, dtype)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return parse_floating(raw, dtype)
    if isinstance(dtype, T.DecimalType):
        return parse_decimal(raw, dtype)
    if isinstance(dtype, T.DateType):
        return parse_date(raw)
    if hasattr(T, "TimeType") and isinstance(dtype, T.TimeType):
        millis, ok = parse_time_millis(raw)
        return millis_to_time(millis), ok
    if isinstance(dtype, T.TimestampNTZType):
        return parse_timestamp_ntz(raw)
    if isinstance(dtype, T.TimestampType):
        value, ok = parse_timestamp_ntz(raw)
        return ntz_to_ltz(value), ok
    if isinstance(dtype, T.BinaryType):
        return parse_binary(raw)
    raise UnsupportedType(f"Unsupported field type {type_name(dtype)}")


def parse_value(raw: Column, dtype: T.DataType, field: str, strict: bool) -> Column:
    """Typed value of ``raw``.  ``strict``: a non-NULL text that is not
    accepted raises an error; otherwise it becomes NULL."""
    value, valid = parse_typed(raw, dtype)
    value = value.cast(dtype)  # e.g. TIME(6) of the parse to a declared TIME(3)
    if not strict:
        return value
    message = F.concat(F.lit(f"Failed to parse field '{field}' value '"), raw,
                       F.lit(f"' as {type_name(dtype)}"))
    return F.when(raw.isNotNull() & ~valid, F.raise_error(message).cast(dtype)).otherwise(value)
