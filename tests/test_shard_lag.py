"""The lag gauge of each shard, and when it vanishes."""
import datetime as dt
import time
import uuid

from pyspark.sql import functions as F

from shardlake.sources.fixtures import events_log_store
from shardlake.sources.logstore import read_log_store, write_log_store
from shardlake.sources.manifest import set_status
from shardlake.sources.positions_source import stream_groups
from shardlake.streaming.lag import ShardLag

SF = "/root/testdata/sf0.001"
NOW = dt.datetime(2025, 1, 1)


def store(spark, scratch):
    root = f"{scratch}/store"
    write_log_store(events_log_store(spark, SF).where("logstore = 'events-click' AND shard < 2"), root)
    return root


def written(spark, root, shard, seq):
    return read_log_store(spark, root).where((F.col("shard") == shard) & (F.col("seq") == seq)).first()["cursor_time"]


def test_each_shard_has_its_own_lag_until_it_is_finished(spark, scratch):
    root = store(spark, scratch)
    end = {r["shard"]: r["n"] for r in read_log_store(spark, root).groupBy("shard").agg(F.count("*").alias("n")).collect()}
    gauge = ShardLag({"project": root, "logstore": "events-click"})
    gauge.update({}, NOW)
    assert gauge.seconds == {}                              # nothing was read
    gauge.update({"events-click$0": 3, "events-click$1": end[1]}, NOW)
    assert gauge.seconds == {f"events-click${s}": (NOW - written(spark, root, s, n - 1)).total_seconds() for s, n in ((0, 3), (1, end[1]))}
    set_status(spark, root, spark.createDataFrame([("events-click", 1, "readonly")], "logstore string, shard int, status string"))
    gauge.update({"events-click$0": 3, "events-click$1": end[1]}, NOW)
    assert set(gauge.seconds) == {"events-click$0"}         # the closed shard was read to its end
    gauge.update({"events-click$0": 3, "events-click$1": end[1] - 1}, NOW)
    assert set(gauge.seconds) == {"events-click$0", "events-click$1"}


def test_the_gauges_vanish_with_the_query(spark, scratch):
    root, name = store(spark, scratch), f"lag_{uuid.uuid4().hex}"
    gauge = ShardLag({"project": root, "logstore": "events-click"}, name)
    listener = gauge.listener()
    spark.streams.addListener(listener)
    try:
        q = (stream_groups(spark, {"project": root, "logstore": "events-click"}).writeStream.queryName(name).foreachBatch(lambda b, i: None)
             .option("checkpointLocation", f"{scratch}/checkpoint").trigger(processingTime="0 seconds").start())
        try:
            q.processAllAvailable()
            wait_until(lambda: set(gauge.seconds) == {"events-click$0", "events-click$1"})
            assert all(v > 86400 for v in gauge.seconds.values())      # written in 2024
        finally:
            q.stop()
        wait_until(lambda: gauge.seconds == {})
    finally:
        spark.streams.removeListener(listener)


def wait_until(true, seconds=30):
    end = time.monotonic() + seconds
    while not true():
        assert time.monotonic() < end
        time.sleep(0.1)
