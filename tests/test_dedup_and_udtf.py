"""Stream dedup by intervals of positions; hooks as table functions."""
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shardlake.operators.udtf import register_deserializer, register_serializer
from shardlake.streaming.dedup import dedup_positions, inside, interval_state, merge


def test_intervals_hold_exactly_the_positions_added():
    rng, seen = random.Random(5), set()
    b = e = np.zeros(0, np.int64)
    for _ in range(200):
        new = np.array(sorted(set(rng.sample(range(300), rng.randint(0, 8))) - seen), np.int64)
        b, e = merge(b, e, new)
        seen |= set(new.tolist())
        assert inside(b, e, np.arange(300)).tolist() == [p in seen for p in range(300)]
        assert (b < e).all() and (b[1:] > e[:-1]).all()     # neither empty nor touching


def test_duplicates_of_any_age_are_dropped_across_restarts(spark, scratch):
    """Three runs of one query: overlapping, repeated and late positions; rows
    keep their values, nulls and microseconds."""
    schema = "logstore string, shard int, seq long, big bigint, t timestamp_ntz, m map<string,string>, l array<struct<k:string,v:double>>"

    def deliver(lo, hi, copies):
        rows = spark.range(lo, hi).crossJoin(spark.range(copies).select(F.col("id").alias("c"))).selectExpr(
            "'s' AS logstore", "CAST(id % 2 AS INT) AS shard", "id div 2 AS seq", "IF(id % 3 = 0, NULL, 9007199254740993 + id) AS big",
            "timestamp_ntz'2024-01-01 00:00:00.123456' AS t", "map('a', NULL, 'b', 'é') AS m", "array(struct('k' AS k, 0.1D AS v)) AS l")
        rows.write.mode("append").parquet(f"{scratch}/in")
        out = dedup_positions(spark.readStream.schema(schema).parquet(f"{scratch}/in"), lanes=4)
        assert out.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
        with interval_state(spark):
            q = (out.writeStream.format("parquet").option("path", f"{scratch}/out").option("checkpointLocation", f"{scratch}/checkpoint")
                 .trigger(availableNow=True).start())
        q.awaitTermination()

    for lo, hi, copies in ((0, 60, 2), (100, 160, 1), (0, 200, 3)):
        deliver(lo, hi, copies)
    out = spark.read.schema(schema).parquet(f"{scratch}/out")
    assert sorted((r["shard"], r["seq"]) for r in out.collect()) == sorted((i % 2, i // 2) for i in range(200))
    delivered = spark.read.schema(schema).parquet(f"{scratch}/in")
    text = lambda df: df.select(F.to_json(F.struct("*")).alias("r"), "t").distinct()
    assert text(out).exceptAll(text(delivered)).isEmpty() and out.count() == text(out).count()


def test_a_deserializer_in_sql_keeps_the_named_columns(spark):
    spark.sql("""CREATE OR REPLACE TEMPORARY VIEW udtf_groups AS SELECT * FROM VALUES
        ('a', 1, array(named_struct('contents', array(named_struct('key', 'k', 'value', 'v'))))),
        ('b', 2, array()), ('c', 3, NULL) AS t(logstore, shard, logs)""")

    def pairs(row):
        for log in row["logs"] or []:
            yield {"n": len(log["contents"]), "first": log["contents"][0]["key"]}

    register_deserializer(spark, "pairs_of", pairs, "n int, first string")
    got = spark.sql("SELECT * FROM pairs_of(TABLE(udtf_groups), 'shard', 'logstore')")
    assert got.columns == ["shard", "logstore", "n", "first"]
    assert [tuple(r) for r in got.collect()] == [(1, "a", 1, "k")]
    assert [tuple(r) for r in spark.sql("SELECT * FROM pairs_of(TABLE(udtf_groups))").collect()] == [(1, "k")]
    for bad in ("TABLE(udtf_groups), 'nothing'", "'no table'"):
        with pytest.raises(PySparkException):
            spark.sql(f"SELECT * FROM pairs_of({bad})").collect()


def test_a_serializer_in_sql_yields_records(spark):
    def halves(row):
        for part in ("left", "right"):
            if row[part] is not None:
                yield {"logstore": "s", "time": 5, "time_ns": 0, "contents": [(part, row[part])]}

    register_serializer(spark, "halves_of", halves)
    got = spark.sql("SELECT * FROM halves_of(TABLE(SELECT 'a' AS left, NULL AS right UNION ALL SELECT 'b', 'c'))").collect()
    assert sorted((r["logstore"], r["topic"], r["time"], r["contents"][0]["key"], r["contents"][0]["value"]) for r in got) == [
        ("s", None, 5, "left", "a"), ("s", None, 5, "left", "b"), ("s", None, 5, "right", "c")]
