"""Streams that lose their process: INSERT exactly once, commits that survive."""
import pytest
from pyspark.sql import functions as F

from shardlake.sources import manifest
from shardlake.sources.fixtures import events_log_groups
from shardlake.sources.logstore import hadoop_fs, read_log_store, write_log_store
from shardlake.streaming.progress import current_positions
from shardlake.streaming.stream import ProgressCommitter, read_commits, start_insert, stream_decoded

SF = "/root/testdata/sf0.001"


class Lost(RuntimeError):
    pass


@pytest.mark.parametrize("where", ["before the commit", "after the commit"])
def test_insert_from_a_stream_is_exactly_once(spark, scratch, monkeypatch, where):
    """The process is lost at the second batch; the query starts again."""
    source, root = f"{scratch}/source", f"{scratch}/target"
    write_log_store(events_log_groups(spark, SF).where("logstore = 'events-click'"), source)
    targets = spark.range(2).select(F.lit("copy").alias("logstore"), F.col("id").cast("int").alias("shard"))
    rows = lambda: stream_decoded(spark, source, "event_id bigint, value double", keep=(), max_files_per_trigger=2)
    count, put, publish = [], manifest.Manifest.put, manifest._publish

    def run():
        q = start_insert(rows(), root, targets, {"logstore": "copy"}, f"{scratch}/checkpoint")
        q.awaitTermination()

    def once_more(f):
        def call(*a, **k):
            count.append(1)
            if len(count) == 2:
                raise Lost(where)
            return f(*a, **k)
        return call

    with monkeypatch.context() as m:
        if where == "before the commit":
            m.setattr(manifest.Manifest, "put", once_more(put))
        else:
            m.setattr(manifest, "_publish", once_more(publish))
        with pytest.raises(Exception, match=where):
            run()
    run()
    stored = read_log_store(spark, root)
    values = stored.select(F.explode("logs.contents").alias("c")).select(F.filter("c", lambda x: x["key"] == "event_id")[0]["value"].alias("id"))
    want = spark.read.parquet(f"{SF}/events.parquet").where("event_type = 'click'").count()
    assert values.count() == want == values.distinct().count()
    assert stored.select("shard", "seq").distinct().count() == stored.count()
    assert stored.groupBy("shard").agg((F.max("seq") + 1 - F.count("*")).alias("gap")).where("gap <> 0").count() == 0


def groups_of(spark, a, b):
    return spark.range(a, b).select(F.lit("s").alias("logstore"), F.lit(0).alias("shard"), F.col("id").alias("seq"))


def at(spark, folder):
    rows = current_positions(read_commits(spark, folder), "cg").collect()
    return rows[0]["seq"] if rows else None


def test_held_ranges_survive_the_process(spark, scratch):
    folder = f"{scratch}/commits"
    lost = ProgressCommitter(folder, "cg", mode="PERIODIC", interval_ms=3_600_000)
    lost.commit(groups_of(spark, 0, 5), 0)
    lost.commit(groups_of(spark, 5, 10), 1)
    assert at(spark, folder) == 5
    late = ProgressCommitter(folder, "cg", mode="PERIODIC", interval_ms=3_600_000)
    late.commit(groups_of(spark, 10, 15), 2)
    assert at(spark, folder) == 15
    late.commit(groups_of(spark, 15, 20), 3)
    assert at(spark, folder) == 15
    late.flush(spark)
    assert at(spark, folder) == 20
    late.flush(spark)
    fs, held = hadoop_fs(spark, late._held_folder())
    assert not fs.listStatus(held)


def test_lost_between_commit_and_cleanup(spark, scratch, monkeypatch):
    """Ranges committed twice change nothing; a half written one is left alone."""
    folder = f"{scratch}/commits"
    c = ProgressCommitter(folder, "cg", mode="PERIODIC", interval_ms=3_600_000)
    c.commit(groups_of(spark, 0, 4), 0)
    c.commit(groups_of(spark, 4, 8), 1)
    fs, held = hadoop_fs(spark, c._held_folder())
    kept = [f.getPath() for f in fs.listStatus(held)][0]
    _, copy = hadoop_fs(spark, f"{scratch}/kept")
    spark.read.parquet(kept.toString()).write.parquet(copy.toString())
    c.flush(spark)
    spark.read.parquet(copy.toString()).write.parquet(kept.toString())          # as if it had not been deleted
    _, half = hadoop_fs(spark, f"{c._held_folder()}/half")
    fs.mkdirs(half)
    again = ProgressCommitter(folder, "cg", mode="PERIODIC", interval_ms=3_600_000)
    again.commit(groups_of(spark, 8, 9), 2)
    assert at(spark, folder) == 9 and fs.exists(half)


def test_groups_hold_apart(spark, scratch):
    """Two consumer groups on one table hold back their own ranges."""
    folder = f"{scratch}/commits"
    for name in ("cg", "other/group"):
        c = ProgressCommitter(folder, name, mode="PERIODIC", interval_ms=3_600_000)
        c.commit(groups_of(spark, 0, 2), 0)
        c.commit(groups_of(spark, 2, 4), 1)
    ProgressCommitter(folder, "cg", mode="PERIODIC", interval_ms=3_600_000).flush(spark)
    rows = {r["consumer_group"]: r["seq"] for r in read_commits(spark, folder).collect()}
    assert rows == {"cg": 4, "other/group": 2}
