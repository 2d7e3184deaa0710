"""The parse rules of ``functions.parse`` on single texts, for readers that run
in Python (``sources.using``).  The patterns are those of that module; a test
holds both against each other.

:func:`typed` parses each distinct text of an Arrow array once.
"""
from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from decimal import ROUND_HALF_UP, Context, Decimal, InvalidOperation

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .parse import DECIMAL, EPOCH_INTEGER, FLOATING, INTEGRAL, ISO_DATE, ISO_DATE_TIME, JDBC_TIMESTAMP, UnsupportedType, type_name

EPOCH = dt.datetime(1970, 1, 1)
BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
WIDE = Context(prec=2000)
#: Days of 400 years; Python's calendar has no year 0.
CYCLE_DAYS = 146097


class NotAccepted(ValueError):
    """The text is no value of the type."""


def _integer(text: str, bits: int, pattern: str) -> int:
    if not re.search(pattern, text):
        raise NotAccepted(text)
    value = int(text)
    if not -(1 << bits - 1) <= value < 1 << bits - 1:
        raise NotAccepted(text)
    return value


def boolean(text: str) -> bool:
    low = text.lower()
    if low not in ("true", "false"):
        raise NotAccepted(text)
    return low == "true"


def floating(text: str) -> float:
    trimmed = text.strip("".join(map(chr, range(33))))
    if not re.search(FLOATING, trimmed):
        raise NotAccepted(text)
    body = re.sub("[fFdD]$", "", trimmed)
    try:
        return float.fromhex(body) if "x" in body.lower() else float(body)
    except OverflowError:
        return float("-inf" if body.startswith("-") else "inf")


def decimal(text: str, precision: int, scale: int) -> Decimal | None:
    """None where the value does not fit: such a text is accepted."""
    if not re.search(DECIMAL, text):
        raise NotAccepted(text)
    try:
        value = Decimal(text).quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP, WIDE)
    except InvalidOperation:
        return None
    return value if len(value.as_tuple().digits) <= precision else None


def _days(year: int, month: int, day: int) -> int:
    try:
        return (dt.date(year or 400, month, day) - dt.date(1970, 1, 1)).days - (0 if year else CYCLE_DAYS)
    except ValueError as e:
        raise NotAccepted(str(e)) from None


def date_days(text: str) -> int:
    if re.search(EPOCH_INTEGER, text):
        return _integer(text, 32, EPOCH_INTEGER)
    if not re.search(ISO_DATE, text):
        raise NotAccepted(text)
    return _days(*map(int, text.strip().split("-")))


def timestamp_micros(text: str) -> int:
    """Epoch milliseconds, the ISO form or the JDBC form, to microseconds."""
    if re.search(EPOCH_INTEGER, text):
        return _integer(str(_integer(text, 64, EPOCH_INTEGER) * 1000), 64, EPOCH_INTEGER)
    if not (re.search(ISO_DATE_TIME, text) or re.search(JDBC_TIMESTAMP, text)):
        raise NotAccepted(text)
    day, clock = re.split("[T ]", text.strip(), maxsplit=1)
    clock, _, fraction = clock.partition(".")
    hour, minute, second = ([int(p) for p in clock.split(":")] + [0])[:3]
    if hour > 23 or minute > 59 or second > 59:
        raise NotAccepted(text)
    seconds = _days(*map(int, day.split("-"))) * 86400 + hour * 3600 + minute * 60 + second
    return seconds * 1000000 + int(fraction[:6].ljust(6, "0"))


def rule(dtype: T.DataType) -> tuple[Callable[[str], object], pa.DataType]:
    """The parser of ``dtype`` and the Arrow type that holds what it gives."""
    kind = type(dtype)
    if kind in BITS:
        return lambda text: _integer(text, BITS[kind], INTEGRAL), to_arrow_type(dtype)
    if kind is T.BooleanType:
        return boolean, pa.bool_()
    if kind in (T.FloatType, T.DoubleType):
        return floating, to_arrow_type(dtype)
    if kind is T.DecimalType:
        return lambda text: decimal(text, dtype.precision, dtype.scale), to_arrow_type(dtype)
    if kind is T.DateType:
        return date_days, pa.int32()
    if kind in (T.TimestampNTZType, T.TimestampType):
        return timestamp_micros, pa.int64()
    if kind is T.BinaryType:
        return lambda text: text.encode(), pa.binary()
    raise UnsupportedType(f"Unsupported field type {type_name(dtype)}")


def typed(text: pa.Array, dtype: T.DataType, field: str, strict: bool) -> pa.Array:
    """``text`` as ``dtype``.  A text that is not accepted raises, or gives
    null without ``strict``; null stays null."""
    target = to_arrow_type(dtype)
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return text.cast(target)
    parse, storage = rule(dtype)
    words = text.cast(pa.string()).dictionary_encode()
    values = []
    for word in words.dictionary.to_pylist():
        try:
            values.append(parse(word))
        except NotAccepted:
            if strict:
                raise ValueError(f"Failed to parse field '{field}' value '{word}' as {type_name(dtype)}") from None
            values.append(None)
    return pa.array(values, storage).cast(target).take(words.indices)


def _iso(micros: int) -> str:
    full = (EPOCH + dt.timedelta(microseconds=micros)).strftime("%Y-%m-%dT%H:%M:%S.%f").rjust(26, "0")
    for tail in (":00.000000", ".000000", "000"):
        if full.endswith(tail):
            return full[:-len(tail)]
    return full


def texts(column: pa.Array, dtype: T.DataType) -> list[str | None]:
    """The text written for each value (the rules of ``functions.text``).
    Floating point has none here: Spark's cast to STRING writes it."""
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return column.to_pylist()
    if isinstance(dtype, T.BooleanType):
        write = lambda v: "true" if v else "false"
    elif type(dtype) in BITS:
        write = str
    elif isinstance(dtype, T.DecimalType):
        write = lambda v: format(v, "f")
    elif isinstance(dtype, T.DateType):
        write = lambda v: v.isoformat()
    elif isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        column, write = column.cast(pa.int64()), _iso
    elif isinstance(dtype, T.BinaryType):
        write = lambda v: v.decode("utf-8", "replace")
    else:
        raise UnsupportedType(f"Unsupported SQL sink field type: {type_name(dtype)} (declare the column STRING: Spark casts it)")
    return [None if v is None else write(v) for v in column.to_pylist()]
