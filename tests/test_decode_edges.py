"""Decoder edge values (FIXTURES.md): the rules of the Java parsers."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shardlake.functions.parse import UnsupportedType
from shardlake.operators.decode import decode_logs, validate

# (declared type, text, expected value; INVALID = rejected by the parser)
INVALID = object()
CASES = [
    ("int", None, None),
    ("int", "", INVALID),
    ("int", " 12 ", INVALID),
    ("int", "+5", 5),
    ("int", "-", INVALID),
    ("int", "1.5", INVALID),
    ("int", "2147483648", INVALID),
    ("int", "-2147483648", -2147483648),
    ("tinyint", "128", INVALID),
    ("tinyint", "-128", -128),
    ("bigint", "9223372036854775807", 9223372036854775807),
    ("boolean", "yes", INVALID),
    ("boolean", "TRUE", True),
    ("boolean", "fAlSe", False),
    ("boolean", "1", INVALID),
    ("double", "NaN", "nan"),
    ("double", "nan", INVALID),
    ("double", "1e3", 1000.0),
    ("double", " 2.5 ", 2.5),
    ("double", "-Infinity", float("-inf")),
    ("double", "1.5f", 1.5),
    ("double", "abc", INVALID),
    ("decimal(5,2)", "1.005", Decimal("1.01")),
    ("decimal(5,2)", "1e3", None),          # valid text, precision overflow: NULL
    ("decimal(5,2)", "+5", Decimal("5.00")),
    ("decimal(5,2)", " 5", INVALID),
    ("date", "19723", dt.date(2024, 1, 1)),
    ("date", "2024-01-01", dt.date(2024, 1, 1)),
    ("date", "2024-1-1", INVALID),
    ("date", "2024", dt.date(1970, 1, 1) + dt.timedelta(days=2024)),  # an integer: epoch days
    ("date", "+5", INVALID),
    ("timestamp_ntz", "1704067200000", dt.datetime(2024, 1, 1)),
    ("timestamp_ntz", "2024-01-01T00:00", dt.datetime(2024, 1, 1)),
    ("timestamp_ntz", "2024-01-01 00:00:00.5", dt.datetime(2024, 1, 1, 0, 0, 0, 500000)),
    ("timestamp_ntz", "2024-1-2 3:04:05", dt.datetime(2024, 1, 2, 3, 4, 5)),
    ("timestamp_ntz", "2024-01-01T00:00:00Z", INVALID),
    ("timestamp_ntz", "2024-01-01", INVALID),
    ("string", "", ""),
    ("string", " 12 ", " 12 "),
    ("binary", "hé", "hé".encode()),
]


def _logs(spark, values):
    rows = [(i, [("v", v)] if v is not None else []) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, contents array<struct<key:string,value:string>>")
    return df.select("i", "contents", F.lit(1704067200).alias("time"), F.lit(123456789).alias("time_ns"),
                     F.lit("t").alias("topic"), F.lit("s").alias("source"), F.lit(0).alias("shard"),
                     F.lit("MA==").alias("cursor"))


def _norm(v):
    if isinstance(v, float) and v != v:
        return "nan"
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


@pytest.mark.parametrize("dtype", sorted({c[0] for c in CASES}))
def test_lenient_and_strict(spark, dtype):
    cases = [c for c in CASES if c[0] == dtype]
    logs = _logs(spark, [c[1] for c in cases])
    got = {r["i"]: _norm(r["v"]) for r in decode_logs(logs, f"v {dtype}", ignore_parse_errors=True, keep=("i",)).collect()}
    for i, (_, text, want) in enumerate(cases):
        expect = None if want is INVALID else want
        assert got[i] == expect, (dtype, text, got[i], expect)
    # strict: each rejected text raises and names field, value and type
    for i, (_, text, want) in enumerate(cases):
        one = _logs(spark, [text])
        d = decode_logs(one, f"v {dtype}", keep=("i",))
        if want is INVALID:
            with pytest.raises(Exception, match="Failed to parse field 'v'"):
                d.collect()
        else:
            assert _norm(d.collect()[0]["v"]) == want


def test_time_of_day(spark):
    logs = _logs(spark, ["45296789", "12:34", "12:34:56.123456", "25:00", "x"])
    d = decode_logs(logs, "v time(3)", ignore_parse_errors=True, keep=("i",))
    ms = d.select("i", F.time_diff(F.lit("MILLISECOND"), F.expr("TIME'00:00:00'"), "v").alias("ms"))
    got = {r["i"]: r["ms"] for r in ms.collect()}
    assert got == {0: 45296789, 1: 45240000, 2: 45296123, 3: None, 4: None}


def test_repeated_and_absent_keys(spark):
    df = spark.createDataFrame([([("a", "1"), ("b", "x"), ("a", "2")],)],
                               "contents array<struct<key:string,value:string>>")
    df = df.select("contents", F.lit(0).alias("time"), F.lit(0).alias("time_ns"))
    row = decode_logs(df, "a int, b string, c string, A int").first()
    assert (row["a"], row["b"], row["c"], row["A"]) == (2, "x", None, None)


def test_metadata_shadows_content(spark):
    df = _logs(spark, ["x"]).withColumn("contents", F.array(F.struct(F.lit("__topic__").alias("key"),
                                                                     F.lit("c").alias("value"))))
    row = decode_logs(df, "__topic__ string, __time__ timestamp_ntz, __shard__ int, __cursor__ string").first()
    assert row["__topic__"] == "t"
    assert row["__time__"] == dt.datetime(2024, 1, 1, 0, 0, 0, 123456)
    assert (row["__shard__"], row["__cursor__"]) == (0, "MA==")


def test_nested_types_rejected(spark):
    with pytest.raises(UnsupportedType):
        decode_logs(_logs(spark, ["1"]), "v array<int>")


def test_validate_touches_unused_columns(spark):
    d = decode_logs(_logs(spark, ["1", "x"]), "v int")
    assert d.select(F.lit(1)).count() == 2   # the pruned column is not checked
    with pytest.raises(Exception, match="Failed to parse"):
        validate(d)


def test_time_field_as_date_and_time(spark):
    # __time__ = 2024-01-01 00:00:00 UTC + 45296 s, ns part 789 ms
    logs = _logs(spark, ["x"]).withColumn("time", F.lit(1704067200 + 45296)).withColumn("time_ns", F.lit(789000000))
    d = decode_logs(logs, "__time__ date, __shard__ int")
    assert d.first()["__time__"] == dt.date(2024, 1, 1)
    t = decode_logs(logs, "__time__ time(3)").select(
        F.time_diff(F.lit("MILLISECOND"), F.expr("TIME'00:00:00'"), "__time__").alias("ms")).first()["ms"]
    assert t == 45296789
