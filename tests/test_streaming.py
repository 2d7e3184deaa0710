"""Streaming read, restart from the checkpoint, progress commits (R2, R10,
R11, R13, W4, K15)."""
import os

from pyspark.sql import functions as F

from shardlake.sources.fixtures import events_log_groups
from shardlake.sources.logstore import read_log_store, write_log_store
from shardlake.plans.positions import shard_index
from shardlake.streaming.progress import current_positions
from shardlake.streaming.stream import ProgressCommitter, read_commits, start_copy

SF = "/root/testdata/sf0.001"
SCHEMA = "event_id bigint, value double"


def _write_half(groups, root, half):
    part = groups.where((F.col("seq") % 2) == half)
    write_log_store(part, root)


def test_restart_reads_everything_once(spark, scratch):
    root = os.path.join(scratch, "store")
    out = os.path.join(scratch, "out")
    ckpt = os.path.join(scratch, "ckpt")
    commits = os.path.join(scratch, "commits")
    groups = events_log_groups(spark, SF)
    expected = {r[0] for r in spark.read.parquet(f"{SF}/events.parquet").select("event_id").collect()}

    _write_half(groups, root, 0)
    committer = ProgressCommitter(commits, "cg")
    q = start_copy(spark, root, SCHEMA, out, ckpt, committer=committer, max_files_per_trigger=3)
    q.awaitTermination(300)
    first = spark.read.parquet(out).count()
    assert 0 < first < len(expected)
    # At most 3 files per trigger, so the first read takes several batches
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) >= 2

    # new files (and a restart of the query) pick up only what is new
    _write_half(groups, root, 1)
    q = start_copy(spark, root, SCHEMA, out, ckpt, committer=ProgressCommitter(commits, "cg"),
                   max_files_per_trigger=3)
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    ids = [r[0] for r in got.select("event_id").collect()]
    assert set(ids) == expected
    assert len(ids) == len(expected)          # no duplicates

    # committed positions reach the end of every shard
    pos = current_positions(read_commits(spark, commits), "cg")
    end = shard_index(read_log_store(spark, root))
    behind = pos.join(end, ["logstore", "shard"]).where(F.col("seq") != F.col("end_seq"))
    assert behind.count() == 0
    assert pos.count() == end.count()


def test_failed_batch_is_retried_without_duplicates(spark, scratch):
    root = os.path.join(scratch, "store")
    out = os.path.join(scratch, "out")
    ckpt = os.path.join(scratch, "ckpt")
    groups = events_log_groups(spark, SF)
    write_log_store(groups, root)
    from shardlake.streaming.stream import batch_sink, stream_decoded
    sink = batch_sink(out)
    state = {"failed": False}

    def flaky(batch, batch_id):
        sink(batch, batch_id)
        if batch_id == 1 and not state["failed"]:
            state["failed"] = True
            raise RuntimeError("injected failure after the write")

    def run():
        s = stream_decoded(spark, root, SCHEMA, max_files_per_trigger=4)
        return (s.writeStream.foreachBatch(flaky).option("checkpointLocation", ckpt)
                 .trigger(availableNow=True).start())

    q = run()
    try:
        q.awaitTermination(300)
    except Exception:  # noqa: BLE001  the injected failure
        pass
    assert state["failed"]
    run().awaitTermination(300)
    got = spark.read.parquet(out)
    assert got.count() == got.select("event_id").distinct().count() == groups.select(F.sum(F.size("logs"))).first()[0]


def test_stream_log_table_with_start_and_stop(spark, scratch):
    from shardlake.plans.positions import bounded, resolve_positions
    from shardlake.sql import stream_log_table
    root = os.path.join(scratch, "store")
    out = os.path.join(scratch, "out")
    groups = events_log_groups(spark, SF)
    write_log_store(groups, root)
    opts = {"project": root, "logstore": "events-.*", "logstore.pattern": "true",
            "scan.startup.mode": "1704499200", "stop.time": "1705708800", "max.number.per.fetch": "5"}
    s = stream_log_table(spark, "event_id bigint", opts)
    q = (s.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    stored = read_log_store(spark, root)
    want = bounded(stored, resolve_positions(stored, "1704499200", "1705708800")) \
        .select(F.sum(F.size("logs"))).first()[0]
    got = spark.read.parquet(out)
    assert got.count() == want > 0
    assert got.select("event_id").distinct().count() == want


def test_group_writer_splits_large_elements(spark):
    from shardlake.operators.encode import encode_group, encode_rows
    df = spark.range(0, 20).select((F.col("id") % 2).alias("k"), "id")
    rec = encode_rows(df, default_logstore="ls", now_seconds=0, keep=("k",))
    g = encode_group(rec, ["k"], max_logs=3)
    sizes = sorted((r["k"], r["block"], len(r["logs"])) for r in g.collect())
    assert sizes == [(k, b, 3 if b < 3 else 1) for k in (0, 1) for b in range(4)]


def test_commit_modes(spark, scratch):
    groups = spark.createDataFrame([*(("s", 0, i) for i in range(5)), ("s", 1, 0)], "logstore string, shard int, seq long")
    later = spark.createDataFrame([("s", 0, i) for i in range(5, 10)], "logstore string, shard int, seq long")
    periodic = os.path.join(scratch, "periodic")
    c = ProgressCommitter(periodic, "cg", mode="periodic", interval_ms=3_600_000)
    c.commit(groups, 0)          # first commit goes out at once
    c.commit(later, 1)           # within the interval: held back
    pos = {r["shard"]: r["seq"] for r in current_positions(read_commits(spark, periodic), "cg").collect()}
    assert pos == {0: 5, 1: 1}
    c.interval_ms = 0
    c.commit(groups, 2)          # interval over: the held rows go out too
    pos = {r["shard"]: r["seq"] for r in current_positions(read_commits(spark, periodic), "cg").collect()}
    assert pos == {0: 10, 1: 1}
    disabled = os.path.join(scratch, "disabled")
    ProgressCommitter(disabled, "cg", mode="DISABLED").commit(groups, 0)
    assert not os.path.exists(disabled)


def test_append_records_round_trip(spark, scratch):
    """Rows -> records -> log store on disk -> decoded rows; a second
    append continues each shard's positions."""
    from shardlake.operators.audit import duplicate_summary
    from shardlake.operators.decode import decode
    from shardlake.operators.encode import encode_rows
    from shardlake.sources.logstore import append_records
    root = os.path.join(scratch, "sink")
    rows = spark.range(0, 3000).select(F.format_string("sink-msg-%05d", "id").alias("id"),
                                       F.concat(F.lit("sink integration "), F.col("id").cast("string")).alias("message"))
    shards = spark.createDataFrame([("sink", i) for i in range(4)], "logstore string, shard int")
    rec = encode_rows(rows, default_logstore="sink", now_seconds=1700000000)
    append_records(rec, root, shards, max_lines=100, write_time="2024-01-01 00:00:00")
    back = decode(read_log_store(spark, root), "id string, message string")
    assert back.count() == 3000
    assert back.exceptAll(rows).count() == 0
    idx = shard_index(read_log_store(spark, root)).collect()
    assert len(idx) == 4 and all(r["begin_seq"] == 0 for r in idx)
    # a repeated append (a retry) lands after the end; the checks see the copies
    append_records(rec, root, shards, max_lines=100, write_time="2024-01-01 00:01:00")
    g = read_log_store(spark, root)
    dup = duplicate_summary(decode(g, "id string"), "id").first()
    assert (dup["reads"], dup["distinct_ids"], dup["duplicates"]) == (6000, 3000, 3000)
    dense = shard_index(g).join(g.groupBy("logstore", "shard").count(), ["logstore", "shard"])
    assert dense.where(F.col("end_seq") - F.col("begin_seq") != F.col("count")).count() == 0


def test_streaming_insert_into_log_store(spark, scratch):
    from shardlake.operators.decode import decode
    from shardlake.streaming.load import synthetic_load
    from shardlake.streaming.stream import start_insert
    root = os.path.join(scratch, "sink")
    shards = spark.createDataFrame([("load", i) for i in range(2)], "logstore string, shard int")
    q = start_insert(synthetic_load(spark, rows_per_batch=200), root, shards,
                     {"logstore": "load", "sink.topic": "synthetic"}, os.path.join(scratch, "ck"), once=True)
    q.awaitTermination(300)
    g = read_log_store(spark, root)
    back = decode(g, "seq bigint, text string, __topic__ string")
    assert back.count() == 200
    assert back.select("seq").distinct().count() == 200
    assert back.where("__topic__ = 'synthetic'").count() == 200


def test_store_build_race_keeps_one_store(spark, scratch):
    from shardlake.sources.logstore import materialize_log_store
    root = os.path.join(scratch, "store")
    groups = events_log_groups(spark, SF)

    def losing_build():
        # another builder finishes first, while this one is still building
        materialize_log_store(spark, root, lambda: groups)
        return groups

    materialize_log_store(spark, root, losing_build)
    entries = sorted(os.listdir(root))
    assert "_SUCCESS" in entries
    assert all(e.startswith(("logstore=", "_", ".")) for e in entries), entries
    assert not [e for e in os.listdir(scratch) if ".tmp-" in e]
    assert read_log_store(spark, root).count() == groups.count()


def test_stream_dedup_by_sequence_number(spark, scratch):
    from shardlake.functions.parse import ntz_to_ltz
    from shardlake.operators.audit import dedup_stream
    from shardlake.operators.decode import sequence_number
    from shardlake.streaming.stream import stream_decoded
    root, out = os.path.join(scratch, "store"), os.path.join(scratch, "out")
    groups = events_log_groups(spark, SF)
    write_log_store(groups, root)
    write_log_store(groups, root)                      # every group delivered twice
    s = stream_decoded(spark, root, "event_id bigint",
                       keep=("logstore", "shard", "seq", "idx", "cursor_time"), max_files_per_trigger=4)
    s = s.withColumn("seq_no", sequence_number()).withColumn("event_time", ntz_to_ltz(F.col("cursor_time")))
    q = (dedup_stream(s, "seq_no", delay="3650 days").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    total = groups.select(F.sum(F.size("logs"))).first()[0]
    assert got.count() == total == got.select("event_id").distinct().count()


def test_text_and_console_sinks(spark, scratch):
    from shardlake.operators.decode import log_to_json
    from shardlake.streaming.stream import batch_sink, console_sink, stream_decoded
    root = os.path.join(scratch, "store")
    write_log_store(events_log_groups(spark, SF), root)
    s = stream_decoded(spark, root, "event_id bigint", keep=("contents",))
    lines = s.select(log_to_json().alias("value"))
    q = (lines.writeStream.foreachBatch(batch_sink(os.path.join(scratch, "text"), fmt="text"))
         .option("checkpointLocation", os.path.join(scratch, "ck1")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    text = spark.read.text(os.path.join(scratch, "text"))
    assert text.count() == events_log_groups(spark, SF).select(F.sum(F.size("logs"))).first()[0]
    assert text.where(F.col("value").startswith('{"event_id":')).count() == text.count()
    c = console_sink(s.select("event_id"), os.path.join(scratch, "ck2"), rows=2)
    c.awaitTermination(300)
    assert c.exception() is None


def test_stream_log_table_from_checkpoint(spark, scratch):
    from shardlake.plans.positions import bounded, resolve_positions
    from shardlake.queries.reads import CONSUMER_GROUP, checkpoint_table
    from shardlake.sql import stream_log_table
    root, out = os.path.join(scratch, "store"), os.path.join(scratch, "out")
    write_log_store(events_log_groups(spark, SF), root)
    stored = read_log_store(spark, root)
    cp = checkpoint_table(stored)
    opts = {"project": root, "logstore": "events-view,events-click", "consumer-group": CONSUMER_GROUP,
            "scan.startup.mode": "checkpoint", "scan.startup.default-position": "earliest"}
    s = stream_log_table(spark, "event_id bigint", opts, checkpoints=cp, state=os.path.join(scratch, "state"))
    q = (s.writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    sel = stored.where(F.col("logstore").isin("events-view", "events-click"))
    want = bounded(sel, resolve_positions(sel, "checkpoint", checkpoints=cp, consumer_group=CONSUMER_GROUP,
                                          fallback="earliest")).select(F.sum(F.size("logs"))).first()[0]
    got = spark.read.parquet(out).count()
    assert got == want
    assert got < sel.select(F.sum(F.size("logs"))).first()[0]    # the checkpoint skipped some


GROUP = ("logstore string, shard int, seq long, cursor string, next_cursor string, cursor_time timestamp_ntz, topic string, "
         "source string, tags map<string,string>, logs array<struct<time:int,time_ns:int,contents:array<struct<key:string,value:string>>>>")


def _put(spark, root, shard, seqs, second):
    """Groups of one log each, as another process would write them: files
    that the session's own caches know nothing of."""
    import datetime as dt
    import shutil
    import tempfile
    at = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=second)
    rows = [("s", shard, i, "c", "n", at, "", "", {}, [(second, 0, [("event_id", str(100 * shard + i))])]) for i in seqs]
    aside = tempfile.mkdtemp(prefix="shardlake-put-")
    spark.createDataFrame(rows, GROUP).drop("logstore", "shard").coalesce(1).write.mode("overwrite").parquet(aside)
    folder = os.path.join(root, "logstore=s", f"shard={shard}")
    os.makedirs(folder, exist_ok=True)
    for name in os.listdir(aside):
        if name.endswith(".parquet"):
            shutil.copy(os.path.join(aside, name), os.path.join(folder, f"{shard}-{min(seqs)}-{name}"))


def _run(spark, root, out, ck, options, **more):
    from shardlake.sql import stream_log_table
    s = stream_log_table(spark, "event_id bigint", {"project": root, "logstore": "s", **options}, **more)
    q = (s.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination(300)
    read = sum(p["numInputRows"] for p in q.recentProgress)
    got = spark.read.schema("event_id bigint, logstore string, shard int, seq long").parquet(out)
    return {s: sorted(r["seq"] for r in got.collect() if r["shard"] == s) for s in {r["shard"] for r in got.collect()}}, read


def test_latest_keeps_its_start_over_a_restart(spark, scratch):
    root, out, ck, state = (os.path.join(scratch, n) for n in ("store", "out", "ck", "state"))
    _put(spark, root, 0, range(0, 5), 100)
    assert _run(spark, root, out, ck, {"scan.startup.mode": "latest"}, state=state)[0] == {}
    _put(spark, root, 0, range(5, 10), 200)
    _put(spark, root, 1, range(0, 3), 200)
    assert _run(spark, root, out, ck, {"scan.startup.mode": "latest"}, state=state)[0] == {0: [5, 6, 7, 8, 9], 1: [0, 1, 2]}


def test_latest_needs_a_state_folder(spark, scratch):
    import pytest
    from shardlake.sql import stream_log_table
    for mode in ("latest", "checkpoint"):
        with pytest.raises(ValueError, match="state folder"):
            stream_log_table(spark, "event_id bigint", {"project": scratch, "logstore": "s", "scan.startup.mode": mode, "consumer-group": "g"})


def test_groups_appended_by_the_same_session_after_the_start(spark, scratch):
    from shardlake.sources.logstore import write_log_store
    root, out, ck, state = (os.path.join(scratch, n) for n in ("store", "out", "ck", "state"))
    _put(spark, root, 0, range(0, 5), 100)
    _run(spark, root, out, ck, {"scan.startup.mode": "latest"}, state=state)
    more = read_log_store(spark, root).withColumn("seq", F.col("seq") + 5)
    write_log_store(spark.createDataFrame(more.collect(), more.schema), root)
    assert _run(spark, root, out, ck, {"scan.startup.mode": "latest"}, state=state)[0] == {0: [5, 6, 7, 8, 9]}


def test_stop_time_holds_for_later_groups_and_new_shards(spark, scratch):
    root, out, ck = (os.path.join(scratch, n) for n in ("store", "out", "ck"))
    options = {"stop.time": "1000"}
    _put(spark, root, 0, range(0, 10), 100)
    assert _run(spark, root, out, ck, options)[0] == {0: list(range(10))}
    _put(spark, root, 0, range(10, 15), 900)      # known shard, before the stop time
    _put(spark, root, 1, range(0, 5), 900)        # new shard, half before it
    _put(spark, root, 1, range(5, 10), 1000)
    got, read = _run(spark, root, out, ck, options)
    assert got == {0: list(range(15)), 1: list(range(5))}
    assert read <= 15                             # every file once


def test_start_time_holds_for_new_shards(spark, scratch):
    root, out, ck = (os.path.join(scratch, n) for n in ("store", "out", "ck"))
    _put(spark, root, 0, range(0, 2), 100)
    _put(spark, root, 0, range(2, 4), 500)
    assert _run(spark, root, out, ck, {"scan.startup.mode": "500"})[0] == {0: [2, 3]}
    _put(spark, root, 1, range(0, 2), 400)
    _put(spark, root, 1, range(2, 4), 600)
    assert _run(spark, root, out, ck, {"scan.startup.mode": "500"})[0] == {0: [2, 3], 1: [2, 3]}


SEQS = "logstore string, shard int, seq long"


def _positions(spark, path):
    return {r["shard"]: r["seq"] for r in current_positions(read_commits(spark, path), "cg").collect()}


def test_commit_of_ranges_read_out_of_order(spark, scratch):
    path = os.path.join(scratch, "commits")
    c = ProgressCommitter(path, "cg")
    c.commit(spark.createDataFrame([("s", 0, i) for i in range(5, 10)], SEQS), 0)
    assert _positions(spark, path) == {0: 0}      # 0-4 is still to come
    c.commit(spark.createDataFrame([("s", 0, i) for i in (0, 1, 2, 4)], SEQS), 1)
    assert _positions(spark, path) == {0: 3}
    c.commit(spark.createDataFrame([("s", 0, 3)], SEQS), 2)
    c.commit(spark.createDataFrame([("s", 0, 3)], SEQS), 2)      # a retried batch
    assert _positions(spark, path) == {0: 10}


def test_commit_from_a_start(spark, scratch):
    path = os.path.join(scratch, "commits")
    start = spark.createDataFrame([("s", 0, 7, None), ("s", 1, 2, None)], "logstore string, shard int, start_seq long, stop_seq long")
    c = ProgressCommitter(path, "cg", start=start)
    c.commit(spark.createDataFrame([("s", 0, 7), ("s", 0, 8)], SEQS), 0)
    assert _positions(spark, path) == {0: 9, 1: 2}


def test_periodic_commits_are_flushed_and_small(spark, scratch):
    path = os.path.join(scratch, "commits")
    c = ProgressCommitter(path, "cg", mode="PERIODIC", interval_ms=100_000)
    for b in range(4):
        c.commit(spark.createDataFrame([("s", 0, 5 * b + i) for i in range(5)], SEQS), b)
        # held back on disk, a row for each shard and run of a batch
        held = [os.path.join(d, f) for d, _, names in os.walk(c._held_folder()) for f in names if f.endswith(".parquet")]
        assert len(held) == b and (not b or spark.read.parquet(*held).count() == b)
    assert _positions(spark, path) == {0: 5}      # the first goes out whatever the clock says
    c.flush(spark)
    assert _positions(spark, path) == {0: 20}
    c.flush(spark)
    assert _positions(spark, path) == {0: 20}


def test_commits_are_compacted(spark, scratch):
    path = os.path.join(scratch, "commits")
    c = ProgressCommitter(path, "cg", compact_every=3)
    for b in (0, 1, 3, 4, 2, 5, 6):
        c.commit(spark.createDataFrame([("s", 0, b)], SEQS), b)
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert _positions(spark, path) == {0: 7} and len(files) <= 3


def test_two_queries_on_one_output_folder(spark, scratch):
    root, out = os.path.join(scratch, "store"), os.path.join(scratch, "out")
    _put(spark, root, 0, range(0, 3), 100)
    for k in range(2):
        start_copy(spark, root, "event_id bigint", out, os.path.join(scratch, f"ck{k}"), logstore="s").awaitTermination(300)
    assert spark.read.parquet(out).count() == 6
