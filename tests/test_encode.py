"""Encoding rows to log records (reference fixtures F1-F3 and types)."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardlake.operators.encode import encode_rows, json_to_group
from shardlake.operators.route import bucket_of_key, pack_groups, shard_by_hash_key, shard_key_ranges
from shardlake.sql import insert_only, sink_records


def _pairs(row):
    return [(kv["key"], kv["value"]) for kv in row["contents"]]


def test_f1_all_metadata(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2022, 4, 15, 5, 20, 0, 123000), "topic-a", "source-a", "logstore-a", "hash-a", "INFO", 200)],
        "__time__ timestamp_ntz, __topic__ string, __source__ string, __logstore__ string, "
        "__hash_key__ string, level string, status int")
    r = encode_rows(df, default_topic="default-topic", default_source="default-source").first()
    assert r["time"] == 1650000000
    assert (r["topic"], r["source"], r["logstore"], r["hash_key"]) == ("topic-a", "source-a", "logstore-a", "hash-a")
    assert _pairs(r) == [("level", "INFO"), ("status", "200")]


def test_f2_defaults(spark):
    df = spark.createDataFrame([("hello",)], "message string")
    r = encode_rows(df, default_topic="default-topic", default_source="default-source", now_seconds=42).first()
    assert (r["topic"], r["source"], r["time"]) == ("default-topic", "default-source", 42)
    assert _pairs(r) == [("message", "hello")]


def test_f3_non_insert_rejected(spark):
    df = spark.createDataFrame([("hello", "delete")], "message string, _change_type string")
    with pytest.raises(Exception, match="Only INSERT"):
        insert_only(df).collect()
    ok = spark.createDataFrame([("hello", "insert")], "message string, _change_type string")
    assert insert_only(ok).columns == ["message"]


def test_null_metadata_keeps_default_and_null_fields_skipped(spark):
    df = spark.createDataFrame([(None, None, None, "x")], "__topic__ string, __logstore__ string, a string, b string")
    r = encode_rows(df, default_topic="dt", default_logstore="ls", now_seconds=1).first()
    assert (r["topic"], r["logstore"]) == ("dt", "ls")
    assert _pairs(r) == [("b", "x")]


def test_blank_logstore_routes_to_default(spark):
    df = spark.createDataFrame([(" \t",), ("",), ("own",)], "__logstore__ string")
    got = [r["logstore"] for r in encode_rows(df, default_logstore="dflt", now_seconds=1).collect()]
    assert got == ["dflt", "dflt", "own"]


def test_value_text(spark):
    schema = T.StructType([
        T.StructField("b", T.BooleanType()), T.StructField("i", T.IntegerType()),
        T.StructField("d", T.DoubleType()), T.StructField("big", T.DoubleType()),
        T.StructField("dec", T.DecimalType(10, 3)), T.StructField("day", T.DateType()),
        T.StructField("ts0", T.TimestampNTZType()), T.StructField("ts1", T.TimestampNTZType()),
        T.StructField("ts2", T.TimestampNTZType()), T.StructField("ts3", T.TimestampNTZType()),
        T.StructField("bin", T.BinaryType())])
    row = (True, -7, 0.1, 1e10, Decimal("1.5"), dt.date(2024, 1, 2), dt.datetime(2024, 1, 1),
           dt.datetime(2024, 1, 1, 0, 0, 5), dt.datetime(2024, 1, 1, 0, 0, 0, 500000),
           dt.datetime(2024, 1, 1, 0, 0, 0, 123456), "hé".encode())
    r = encode_rows(spark.createDataFrame([row], schema), now_seconds=0).first()
    assert dict(_pairs(r)) == {
        "b": "true", "i": "-7", "d": "0.1", "big": "1.0E10", "dec": "1.500", "day": "2024-01-02",
        "ts0": "2024-01-01T00:00", "ts1": "2024-01-01T00:00:05", "ts2": "2024-01-01T00:00:00.500",
        "ts3": "2024-01-01T00:00:00.123456", "bin": "hé"}


def test_time_column_types(spark):
    df = spark.createDataFrame(
        [(dt.datetime(1969, 12, 31, 23, 59, 59, 500000), 2**32 + 5, 1e20, "17")],
        "a timestamp_ntz, b bigint, c double, d string")
    got = []
    for c in "abcd":
        got.append(encode_rows(df.select(F.col(c).alias("__time__")), now_seconds=0).first()["time"])
    # ms = -500 -> seconds toward zero = 0; long keeps its low 32 bits; double saturates
    assert got == [0, 5, 2**31 - 1, 17]
    bad = spark.createDataFrame([(" 17",)], "__time__ string")
    with pytest.raises(Exception, match="For input string"):
        encode_rows(bad, now_seconds=0).collect()


def test_json_line_to_group(spark):
    df = spark.createDataFrame([('{"__tag__:host": "h1", "a": "x", "n": 5}',)], "line string")
    g = df.select(json_to_group("line", now_seconds=9).alias("g")).first()["g"]
    assert g["tags"] == {"host": "h1"}
    assert sorted((kv["key"], kv["value"]) for kv in g["logs"][0]["contents"]) == [("a", "x"), ("n", "5")]


def test_hash_key_ranges(spark):
    shards = spark.createDataFrame([("s", i) for i in range(4)], "logstore string, shard int")
    ranges = shard_key_ranges(shards).orderBy("shard").collect()
    assert [r["begin_key"][:8] for r in ranges] == ["00000000", "40000000", "80000000", "c0000000"]
    rec = spark.createDataFrame([("s", k, 0, [("a", "1")]) for k in
                                 ["00" * 16, "3f" + "f" * 30, "40" + "0" * 30, "ff" * 16, None]],
                                "logstore string, hash_key string, time int, contents array<struct<key:string,value:string>>")
    got = shard_by_hash_key(rec, shard_key_ranges(shards)).orderBy("hash_key").collect()
    keyed = {r["hash_key"]: r["shard"] for r in got if r["hash_key"]}
    assert keyed == {"00" * 16: 0, "3f" + "f" * 30: 0, "40" + "0" * 30: 1, "ff" * 16: 3}
    assert [r["shard"] for r in got if r["hash_key"] is None][0] in range(4)
    b = spark.createDataFrame([("80" + "0" * 30,)], "k string").select(bucket_of_key(F.col("k"), 4)).first()[0]
    assert b == 2


def test_pack_groups_line_limit_exact(spark):
    n = 1000
    df = spark.range(n).select(F.lit("s").alias("logstore"), F.lit("t").alias("topic"), F.lit("x").alias("source"),
                               F.col("id"), F.array(F.struct(F.lit("k").alias("key"),
                                                             F.col("id").cast("string").alias("value"))).alias("contents"))
    packed = pack_groups(df, ["id"], max_lines=64, max_bytes=None)
    sizes = packed.groupBy("line_block").count().orderBy("line_block").collect()
    assert [r["count"] for r in sizes] == [64] * 15 + [40]
    first_ids = packed.groupBy("line_block").agg(F.min("id").alias("m")).orderBy("line_block").collect()
    assert [r["m"] for r in first_ids] == [64 * i for i in range(16)]


def test_sink_records_options(spark):
    df = spark.createDataFrame([("a",)], "m string")
    r = sink_records(df, {"logstore": "ls", "sink.topic": "tp", "sink.source": "src"}, now_seconds=3).first()
    assert (r["logstore"], r["topic"], r["source"], r["time"]) == ("ls", "tp", "src", 3)
    with pytest.raises(ValueError):
        sink_records(df, {"logstore": "ls", "no.such.option": "1"})


def test_parallelism_options(spark):
    from shardlake.sql import log_table
    from shardlake.sources.fixtures import events_log_groups
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "m string")
    out = sink_records(df, {"logstore": "ls", "sink.parallelism": "2"}, now_seconds=0)
    assert out.rdd.getNumPartitions() == 2
    g = events_log_groups(spark, "/root/testdata/sf0.001")
    t = log_table(spark, "event_id bigint", {"logstore": "events-click", "scan.parallelism": "3"}, groups=g)
    assert t.rdd.getNumPartitions() == 3


def test_adjusted_hash_keys(spark):
    df = spark.createDataFrame([("3fffffff" + "f" * 24,), ("40000001" + "0" * 24,), (None,)], "__hash_key__ string")
    got = [r["hash_key"] for r in sink_records(df, {"logstore": "ls", "producer.buckets": "4"}, now_seconds=0).collect()]
    assert got == ["00000000" + "0" * 24, "40000000" + "0" * 24, None]
    kept = sink_records(df, {"logstore": "ls", "producer.buckets": "4", "producer.adjust.shard.hash": "false"},
                        now_seconds=0).collect()
    assert kept[0]["hash_key"] == "3fffffff" + "f" * 24


def test_committer_from_options(scratch):
    from shardlake.streaming.stream import ProgressCommitter
    c = ProgressCommitter.from_options(scratch, {"logstore": "x", "consumer-group": "g", "checkpoint.mode": "periodic",
                                                 "commit.interval.ms": "500"})
    assert (c.consumer_group, c.mode, c.interval_ms) == ("g", "PERIODIC", 500)
    with pytest.raises(ValueError):
        ProgressCommitter.from_options(scratch, {"logstore": "x"})


def test_sink_needs_a_logstore(spark):
    df = spark.createDataFrame([("a",)], "m string")
    with pytest.raises(ValueError, match="logstore"):
        sink_records(df, {"sink.topic": "t"})


def test_route_short_and_upper_case_keys(spark):
    rec = spark.createDataFrame([("s", k, 0) for k in ("8", "0", "F", "3fffffffffffffffffffffffffffffff", "4", "BF", "c")],
                                "logstore string, hash_key string, time int").withColumn("contents", F.array().cast(
                                    "array<struct<key:string,value:string>>"))
    shards = spark.createDataFrame([("s", i) for i in range(4)], "logstore string, shard int")
    got = {r["hash_key"]: r["shard"] for r in shard_by_hash_key(rec, shard_key_ranges(shards)).collect()}
    assert got == {"8": 2, "0": 0, "F": 3, "3fffffffffffffffffffffffffffffff": 0, "4": 1, "BF": 2, "c": 3}
    assert all(got[k] == spark.range(1).select(bucket_of_key(F.lit(k), 4)).first()[0] for k in got)


def test_undeliverable_records_raise(spark, scratch):
    import pytest
    from shardlake.sources.logstore import append_records
    shards = spark.createDataFrame([("s", 0)], "logstore string, shard int")
    for row in (("s", "zz"), ("s", ""), ("s", "0" * 33), ("other", None), ("other", "8"), (None, None)):
        rec = spark.createDataFrame([(*row, "", "", 0, 0, [("k", "v")])],
                                    "logstore string, hash_key string, topic string, source string, time int, time_ns int, "
                                    "contents array<struct<key:string,value:string>>")
        with pytest.raises(Exception, match="hash key|No shard"):
            append_records(rec, scratch + "/store", shards)


def test_blank_log_store_names(spark):
    from shardlake.operators.encode import route_logstore
    blank = ["", " ", "\t\n", "　", "  ", "\x1c\x1f", "   ", None]
    full = ["a", " a", " ", " ", " ", "\n."]
    df = spark.createDataFrame([(x,) for x in blank + full], "x string")
    got = [r[0] for r in df.select(route_logstore(F.col("x"), "dflt")).collect()]
    assert got == ["dflt"] * len(blank) + full


def test_pack_groups_byte_limit_holds(spark):
    from shardlake.operators.route import record_bytes
    sizes = [70, 70, 30, 30, 30, 250, 10, 0, 95, 5, 100, 1, 99]
    df = spark.createDataFrame([(i, [("", "x" * n)]) for i, n in enumerate(sizes)], "id int, contents array<struct<key:string,value:string>>")
    df = df.withColumn("logstore", F.lit("s")).withColumn("topic", F.lit("")).withColumn("source", F.lit(""))
    packed = pack_groups(df, ["id"], max_lines=100, max_bytes=100)
    groups = packed.groupBy("line_block", "byte_block").agg(F.sum(record_bytes()).alias("n"), F.sort_array(F.collect_list("id")).alias("ids"))
    rows = groups.orderBy("line_block", "byte_block").collect()
    assert [i for r in rows for i in r["ids"]] == list(range(len(sizes)))
    assert all(r["n"] <= 100 or len(r["ids"]) == 1 for r in rows)


def test_json_lines_to_groups(spark):
    import pytest
    from shardlake.operators.encode import json_to_group
    df = spark.createDataFrame([('{"a":1,"b":"x","a":"last","__tag__:t":"v"}',), (None,)], "j string")
    got = df.select(json_to_group("j", 5).alias("g")).collect()
    assert [tuple(c) for c in got[0]["g"]["logs"][0]["contents"]] == [("b", "x"), ("a", "last")]
    assert got[0]["g"]["tags"] == {"t": "v"} and got[1]["g"] is None
    for bad in ("nope", "[1]", '{"a":'):
        line = spark.createDataFrame([(bad,)], "j string")
        assert line.select(json_to_group("j", 5, strict=False).alias("g")).first()["g"] is None
        with pytest.raises(Exception, match="JSON object"):
            line.select(json_to_group("j", 5)).collect()
