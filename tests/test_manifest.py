"""The store manifest: commits, races, lost writers, positions without a scan."""
import threading

import pytest
from pyspark.sql import functions as F

from shardlake.plans.positions import ScanIndex, resolve_positions
from shardlake.sources import manifest
from shardlake.sources.fixtures import events_index, events_log_groups, events_log_store, events_shards, shards_of
from shardlake.sources.logstore import append_records, hadoop_fs, read_log_store, write_log_store
from shardlake.streaming.progress import progress_time

SF = "/root/testdata/sf0.001"


def records(spark, n, tag="r"):
    return spark.range(n).select(
        F.lit("s").alias("logstore"), F.lit("t").alias("topic"), F.lit("src").alias("source"), F.lit(None).cast("string").alias("hash_key"),
        F.col("id").cast("int").alias("time"), F.lit(0).alias("time_ns"),
        F.array(F.struct(F.lit("k").alias("key"), F.concat(F.lit(tag), F.col("id").cast("string")).alias("value"))).alias("contents"))


def shards(spark, n=2):
    return spark.range(n).select(F.lit("s").alias("logstore"), F.col("id").cast("int").alias("shard"))


def assert_dense(spark, root):
    """Every position once, from 0 on without a gap, as the manifest says."""
    rows = read_log_store(spark, root).select("logstore", "shard", "seq").collect()
    ends = {(r["logstore"], r["shard"]): (r["begin_seq"], r["end_seq"]) for r in manifest.open_store(spark, root).ends().collect()}
    by = {}
    for r in rows:
        by.setdefault((r["logstore"], r["shard"]), []).append(r["seq"])
    assert {k: (0, len(v)) for k, v in by.items()} == ends
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def values(spark, root):
    return sorted(r["v"] for r in read_log_store(spark, root).select(F.explode("logs").alias("l")).select(F.col("l.contents")[0]["value"].alias("v")).collect())


def test_appends_follow_each_other_without_a_scan(spark, scratch, monkeypatch):
    """The second append's positions come from the manifest: with the data
    files of the first unreadable it still numbers behind them."""
    root = f"{scratch}/store"
    append_records(records(spark, 50, "a"), root, shards(spark), max_lines=7)
    read = []
    monkeypatch.setattr(manifest, "index_files", lambda s, p, f=manifest.index_files: read.append(p) or f(s, p))
    append_records(records(spark, 30, "b"), root, shards(spark), max_lines=7)
    assert len(read) == 1 and "/_staged/" in read[0]            # only its own files are indexed
    assert_dense(spark, root)
    assert values(spark, root) == sorted([f"a{i}" for i in range(50)] + [f"b{i}" for i in range(30)])


def test_concurrent_appends(spark, scratch):
    root = f"{scratch}/store"
    append_records(records(spark, 10, "first"), root, shards(spark), max_lines=3)
    errors = []

    def one(tag):
        try:
            append_records(records(spark, 40, tag), root, shards(spark), max_lines=5)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=one, args=(t,)) for t in ("x", "y", "z")]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    assert_dense(spark, root)
    assert len(values(spark, root)) == 130 and len(set(values(spark, root))) == 130


def test_a_lost_race_moves_the_staged_files(spark, scratch, monkeypatch):
    """Between reading the manifest and committing, another writer commits."""
    root = f"{scratch}/store"
    append_records(records(spark, 9, "a"), root, shards(spark), max_lines=2, write_time="2024-01-05 00:00:00")
    put, rival = manifest.Manifest.put, []

    def slow(self, rows, token, *key):
        if not rival:
            rival.append(1)
            append_records(records(spark, 11, "rival"), root, shards(spark), max_lines=2, write_time="2024-01-07 00:00:00")
        return put(self, rows, token, *key)

    monkeypatch.setattr(manifest.Manifest, "put", slow)
    append_records(records(spark, 13, "late"), root, shards(spark), max_lines=2, write_time="2024-01-06 00:00:00")
    assert_dense(spark, root)
    assert len(set(values(spark, root))) == 33
    groups = read_log_store(spark, root)
    first = groups.groupBy("shard").agg(F.max("cursor_time").alias("t"))
    assert all(str(r["t"]) == "2024-01-07 00:00:00" for r in first.collect())       # times never fall in a shard
    assert groups.where("cursor <> base64(cast(cast(seq as string) as binary))").count() == 0


def test_a_committed_append_survives_its_writer(spark, scratch, monkeypatch):
    """Lost between the commit and the move: the next one that opens the store moves the files."""
    root = f"{scratch}/store"
    append_records(records(spark, 6, "a"), root, shards(spark), max_lines=2)

    def lost(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(manifest, "_publish", lost)
        with pytest.raises(KeyboardInterrupt):
            append_records(records(spark, 6, "b"), root, shards(spark), max_lines=2, key=("q", 1))
    append_records(records(spark, 6, "b"), root, shards(spark), max_lines=2, key=("q", 1))       # again: nothing more
    append_records(records(spark, 6, "c"), root, shards(spark), max_lines=2, key=("q", 2))
    assert_dense(spark, root)
    assert values(spark, root) == sorted(f"{t}{i}" for t in "abc" for i in range(6))


def test_an_uncommitted_append_leaves_nothing(spark, scratch, monkeypatch):
    root = f"{scratch}/store"
    append_records(records(spark, 6, "a"), root, shards(spark), max_lines=2)

    def lost(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(manifest.Manifest, "put", lost)
        with pytest.raises(KeyboardInterrupt):
            append_records(records(spark, 6, "b"), root, shards(spark), max_lines=2, key=("q", 1))
    assert values(spark, root) == [f"a{i}" for i in range(6)]
    append_records(records(spark, 6, "b"), root, shards(spark), max_lines=2, key=("q", 1))
    assert_dense(spark, root)
    assert len(values(spark, root)) == 12


def test_many_versions_fold(spark, scratch, monkeypatch):
    """Snapshots keep files, the last status and each writer's last batch; old folders go."""
    root = f"{scratch}/store"
    monkeypatch.setattr(manifest, "FOLD_AFTER", 3)
    for b in range(8):
        append_records(records(spark, 4, f"{b}-"), root, shards(spark), max_lines=2, key=("w", b))
    manifest.set_status(spark, root, spark.createDataFrame([("s", 1, "readonly")], "logstore string, shard int, status string"))
    append_records(records(spark, 4, "0-"), root, shards(spark), max_lines=2, key=("w", 3))
    assert_dense(spark, root)
    assert len(values(spark, root)) == 32
    now = manifest.open_store(spark, root)
    assert now.version == 9 and now.has_batch("w", 7) and not now.has_batch("w", 8) and not now.has_batch("v", 0)
    assert {r["shard"]: r["status"] for r in now.shards().collect()} == {0: "readwrite", 1: "readonly"}
    fs, folder = hadoop_fs(spark, f"{root}/_manifest")
    assert len(fs.listStatus(folder)) < 9


def test_a_store_without_a_manifest_is_indexed(spark, scratch):
    """Files written by plain Spark, log store names with special characters included."""
    root = f"{scratch}/store"
    groups = events_log_groups(spark, SF).withColumn("logstore", F.concat(F.col("logstore"), F.lit(" +%[x]")))
    groups.write.partitionBy("logstore", "shard").parquet(root)
    index = manifest.FileIndex(spark, root)
    scan = ScanIndex(read_log_store(spark, root))
    assert sorted(map(tuple, index.shards().collect())) == sorted(map(tuple, scan.shards().collect()))
    for strict in (False, True):
        assert (sorted(map(tuple, index.first_seq_at(1705000000, strict).collect()))
                == sorted(map(tuple, scan.first_seq_at(1705000000, strict).collect())))
    extra = groups.where("seq < 2").withColumn("logstore", F.lit("new"))
    write_log_store(extra, root)
    assert manifest.FileIndex(spark, root).select("new").shards().where("end_seq <> 2").count() == 0


def test_index_agrees_with_a_scan(spark):
    index, groups = events_index(spark, SF), events_log_store(spark, SF)
    for second in (0, 1704499200, 1705708801, 2_000_000_000):
        for strict in (False, True):
            assert (sorted(map(tuple, index.first_seq_at(second, strict).collect()))
                    == sorted(map(tuple, ScanIndex(groups).first_seq_at(second, strict).collect()))), second
    ends = index.shards()
    for seq in (F.lit(0), F.expr("end_seq div 2"), F.col("end_seq"), F.col("end_seq") + 5):
        at = ends.select(F.lit("g").alias("consumer_group"), "logstore", "shard", seq.cast("long").alias("seq"))
        assert (sorted(map(tuple, progress_time(at, groups, index).collect()), key=str)
                == sorted(map(tuple, progress_time(at, groups).collect()), key=str))
    assert sorted(map(tuple, events_shards(spark, SF).collect())) == sorted(map(tuple, shards_of(events_log_groups(spark, SF)).collect()))


def test_positions_read_the_index(spark, monkeypatch):
    """Positions open the manifest, and one file of a shard at most."""
    index, groups = events_index(spark, SF), events_log_store(spark, SF)
    opened = []
    monkeypatch.setattr(manifest.FileIndex, "_opened", lambda self, paths, f=manifest.FileIndex._opened: opened.append(paths) or f(self, paths))
    for start, stop in (("earliest", None), ("latest", None), ("1704499200", "1705708800")):
        plan = resolve_positions(groups, start, stop, store=index)
        files = plan.inputFiles()
        data = [f for f in files if "/_manifest/" not in f]
        assert len(data) <= 2 * index.shards().count()
        if start != "1704499200":
            assert not data
    for paths in opened:
        folders = [p.rsplit("/", 1)[0] for p in paths]
        assert len(folders) == len(set(folders))


def test_events_are_dealt_before_they_become_logs(spark):
    """extract_field (F4): the store's build sorted, dealt and sampled logs ten
    times as large as the events."""
    plan = events_log_groups(spark, SF)._jdf.queryExecution().executedPlan().toString()
    above, _, below = plan.partition("Exchange rangepartitioning(logstore")
    assert below and "Exchange" not in above      # groups stay where their range is
    assert "date_format" in above and "date_format" not in below
