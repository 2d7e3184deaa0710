"""User hooks (U1-U6), synthetic load (R17), watermark windows (W2) and the
streaming lag gauge (W7)."""
import os
import time

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from shardlake.operators.decode import decode, explode_logs
from shardlake.operators.encode import encode_rows
from shardlake.operators.hooks import (decode_value_with, deserialize_with, serialize_with, with_assigner,
                                       with_partitioner)
from shardlake.operators.route import hash_key_md5
from shardlake.sources.fixtures import events_log_groups, shards_of
from shardlake.sources.logstore import write_log_store
from shardlake.streaming.load import synthetic_load
from shardlake.streaming.stream import (LagListener, fetch_lag_seconds, stream_decoded, with_event_time,
                                       with_lag_metrics)

SF = "/root/testdata/sf0.001"


def test_row_generating_deserializer(spark):
    logs = explode_logs(events_log_groups(spark, SF)).select("logstore", "seq", "idx", F.size("contents").alias("n"))

    def twice_if_error(b: pd.DataFrame) -> pd.DataFrame:
        out = b[b["logstore"] == "events-error"]
        return pd.concat([out, out])[["seq", "idx", "n"]]
    got = deserialize_with(logs, twice_if_error, "seq long, idx int, n int")
    assert got.count() == 2 * logs.where("logstore = 'events-error'").count()


def test_value_deserializer_and_serializer(spark):
    upper = decode_value_with(lambda s: s.str.upper(), "string")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "m string, k int")
    assert [r[0] for r in df.select(upper("m")).orderBy(1).collect()] == ["A", "B"]

    def explode_k(b: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for m, k in zip(b["m"], b["k"]):
            for i in range(k):
                rows.append({"logstore": "ls", "topic": "t", "source": None, "hash_key": None, "time": 0,
                             "time_ns": 0, "contents": [{"key": "m", "value": f"{m}{i}"}]})
        return pd.DataFrame(rows, columns=["logstore", "topic", "source", "hash_key", "time", "time_ns", "contents"])
    rec = serialize_with(df, explode_k)
    assert sorted(r["contents"][0]["value"] for r in rec.collect()) == ["a0", "b0", "b1"]
    keyed = with_partitioner(rec, hash_key_md5(F.col("contents")[0]["value"]))
    assert keyed.where(F.length("hash_key") == 32).count() == 3


def test_custom_assigner(spark):
    shards = shards_of(events_log_groups(spark, SF))
    rank = F.dense_rank().over(Window.orderBy("logstore", "shard")) - 1
    t = with_assigner(shards, F.pmod(rank, F.lit(3)))
    assert sorted({r["task"] for r in t.collect()}) == [0, 1, 2]


def test_synthetic_load(spark, scratch):
    out = os.path.join(scratch, "load")
    q = (synthetic_load(spark, rows_per_batch=50).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(once=True).start())
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.count() == 50
    assert got.where(F.col("text").rlike("^[a-z]{12}$")).count() == 50
    rec = encode_rows(got, now_seconds=0)
    assert rec.where(F.size("contents") == 2).count() == 50


def test_watermark_windows_and_lag_gauge(spark, scratch):
    root = os.path.join(scratch, "store")
    write_log_store(events_log_groups(spark, SF), root)
    s = stream_decoded(spark, root, "event_id bigint, __time__ timestamp_ntz", max_files_per_trigger=8)
    s = with_lag_metrics(s, "lag")
    windows = (with_event_time(s, "__time__", "1 hour")
               .groupBy(F.window("event_time", "1 day")).agg(F.count(F.lit(1)).alias("n")))
    out = os.path.join(scratch, "windows")
    listener = LagListener("lag")
    handle = listener.listener()
    spark.streams.addListener(handle)
    q = (windows.writeStream.outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    metrics = [p["observedMetrics"].get("lag") for p in q.recentProgress if p.get("observedMetrics")]
    assert metrics and all(m["rows"] >= 0 for m in metrics)
    lags = [fetch_lag_seconds(p) for p in q.recentProgress]
    # the data was written in 2024: the lag is large and positive
    assert any(lag is not None and lag > 86400 for lag in lags)
    for _ in range(50):                      # listener events arrive asynchronously
        if listener.lag:
            break
        time.sleep(0.2)
    spark.streams.removeListener(handle)
    assert listener.lag and all(v > 86400 for v in listener.lag.values())
    emitted = spark.read.parquet(out).select(F.col("window.start").alias("d"), "n")
    assert emitted.count() > 0
    # every window emitted holds no more than the batch count of that day
    batch = (decode(events_log_groups(spark, SF), "__time__ timestamp_ntz")
             .groupBy(F.window("__time__", "1 day")).agg(F.count(F.lit(1)).alias("m"))
             .select(F.col("window.start").alias("d"), "m"))
    joined = emitted.join(batch.withColumn("d", F.col("d").cast("timestamp")), "d")
    assert joined.count() == emitted.count()
    assert joined.where(F.col("n") > F.col("m")).count() == 0
