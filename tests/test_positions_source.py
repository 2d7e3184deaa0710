"""A stream with a position for each shard: caps, restarts, ends."""
import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from shardlake.sources.fixtures import events_index, events_log_root, events_log_store
from shardlake.sources.logstore import read_log_store, write_log_store
from shardlake.sources.manifest import set_status
from shardlake.sources.positions_source import EPOCH, GroupStreamReader, Store, end_when_finished, offset_of, stream_groups

SF = "/root/testdata/sf0.001"
STORES = {"logstore": "events-.*", "logstore.pattern": "true"}


def copy(spark, root, cond="true", **columns):
    write_log_store(events_log_store(spark, SF).where("logstore = 'events-click'").where(cond).withColumns(columns), root)


def run(spark, options, folder, batches, timeout=120, **more):
    """Run to the end; ``batches`` takes (batch, shard, positions)."""
    def keep(batch, batch_id):
        for r in batch.groupBy("shard").agg(F.sort_array(F.collect_list("seq")).alias("s")).collect():
            batches.append((batch_id, r["shard"], r["s"]))

    q = (stream_groups(spark, options, **more).writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/checkpoint")
         .trigger(processingTime="0 seconds").start())
    try:
        return end_when_finished(q, options, timeout=timeout)
    finally:
        q.stop()


def of_shard(batches, shard):
    return [s for _, k, s in batches if k == shard]


def test_groups_of_a_batch_are_capped(spark, scratch):
    """At most three groups of each shard in a batch, in order, every group once."""
    root, batches = f"{scratch}/store", []
    copy(spark, root)
    ends = {r["shard"]: r["end_seq"] for r in events_index(spark, SF).select("events-click").shards().collect()}
    assert run(spark, {"project": root, "logstore": "events-click", "max.number.per.fetch": "3", "stop.time": "1750000000"}, scratch, batches)
    assert max(len(s) for _, _, s in batches) == 3
    for shard, end in ends.items():
        assert [x for s in of_shard(batches, shard) for x in s] == list(range(end))


def test_a_closed_shard_ends_and_a_new_one_begins_at_its_beginning(spark, scratch):
    """Without a stop time the stream ends when all shards are read-only; one
    written while the stream runs is read whole."""
    root, batches = f"{scratch}/store", []
    copy(spark, root, "shard < 2")
    options = {"project": root, "logstore": "events-click", "max.number.per.fetch": "4", "scan.startup.mode": "latest"}
    close = lambda: set_status(spark, root, events_index(spark, SF).select("events-click").shards().select("logstore", "shard", F.lit("readonly").alias("status")))
    started = stream_groups(spark, options)
    q = (started.writeStream.foreachBatch(lambda b, i: batches.extend((i, r["shard"], [r["seq"]]) for r in b.select("shard", "seq").collect()))
         .option("checkpointLocation", f"{scratch}/checkpoint").trigger(processingTime="0 seconds").start())
    try:
        while q.lastProgress is None:
            time.sleep(0.1)
        assert not end_when_finished(q, options, timeout=2)      # nothing is closed
        copy(spark, root, "shard = 2")
        close()
        assert end_when_finished(q, options, timeout=120)
    finally:
        q.stop()
    end = events_index(spark, SF).select("events-click").shards().where("shard = 2").first()["end_seq"]
    assert sorted(x for s in of_shard(batches, 2) for x in s) == list(range(end)) and {k for _, k, _ in batches} == {2}


def test_a_stream_goes_on_from_its_checkpoint(spark, scratch):
    root, batches = f"{scratch}/store", []
    copy(spark, root, "seq < 3")
    options = {"project": root, "logstore": "events-click", "max.number.per.fetch": "2", "stop.time": "1750000000"}
    assert run(spark, options, scratch, batches)
    copy(spark, root, "seq >= 3")
    again = []
    assert run(spark, options, scratch, again)
    assert again and min(b for b, _, _ in again) > max(b for b, _, _ in batches)
    for shard in range(4):
        got = [x for s in of_shard(batches, shard) + of_shard(again, shard) for x in s]
        assert got == list(range(len(got)))


def test_a_failed_batch_is_read_again(spark, scratch):
    """The batch whose sink failed comes again with the same groups."""
    root, batches, failed = f"{scratch}/store", [], []
    copy(spark, root)
    options = {"project": root, "logstore": "events-click", "max.number.per.fetch": "3", "stop.time": "1750000000"}

    def broken(batch, batch_id):
        if batch_id == 1:
            failed.extend((r["shard"], r["seq"]) for r in batch.collect())
            raise RuntimeError("broken sink")

    q = (stream_groups(spark, options).writeStream.foreachBatch(broken).option("checkpointLocation", f"{scratch}/checkpoint")
         .trigger(processingTime="0 seconds").start())
    with pytest.raises(Exception, match="broken sink"):
        end_when_finished(q, options, timeout=120)
    assert run(spark, options, scratch, batches)
    first = sorted((k, x) for b, k, s in batches for x in s if b == 1)
    assert first == sorted(failed) and min(b for b, _, _ in batches) == 1


def test_a_start_from_a_checkpoint(spark, scratch):
    root, batches = f"{scratch}/store", []
    copy(spark, root)
    cp = spark.createDataFrame([("cg", "events-click", 1, None, 2, None)],
                               "consumer_group string, logstore string, shard int, cursor string, seq long, updated_at timestamp_ntz")
    options = {"project": root, "logstore": "events-click", "consumer-group": "cg", "scan.startup.mode": "checkpoint",
               "scan.startup.default-position": "latest", "stop.time": "1750000000"}
    assert run(spark, options, scratch, batches, checkpoints=cp)
    assert {k for _, k, _ in batches} == {1} and min(x for s in of_shard(batches, 1) for x in s) == 2
    with pytest.raises(ValueError):
        GroupStreamReader({**options, "consumer-group": "cg"})


def test_when_a_shard_is_finished(spark):
    """Stop positions from the manifest; a stop time to come keeps a shard open."""
    root = events_log_root(spark, SF)
    store = Store(root)
    shards = store.shards(lambda n: True)
    index = events_index(spark, SF)
    for second in (0, 1704499200, 1705708800, 1900000000):
        want = {f"{r['logstore']}${r['shard']}": r["at_seq"] for r in index.first_seq_at(second).collect()}
        assert {k: v for k, s in shards.items() if (v := store.first_at(s, EPOCH + dt.timedelta(seconds=second))) is not None} == want
    ends = {k: s["end"] for k, s in shards.items()}
    reader = GroupStreamReader({"project": root, **STORES, "stop.time": "1900000000"})
    soon, late = EPOCH + dt.timedelta(seconds=1_800_000_000), EPOCH + dt.timedelta(seconds=1_900_000_001)
    assert {k: v for k, v in reader.finished(ends, soon).items() if v} == {k: True for k, s in shards.items() if s["readonly"]}
    assert all(reader.finished(ends, late).values())
    short = {k: e - 1 for k, e in ends.items()}
    assert not any(reader.finished(short, late).values())
    assert not any(GroupStreamReader({"project": root, "logstore": "none"}).finished({}, late).values())


def test_rows_are_those_of_a_scan(spark, scratch):
    """Every column as Spark's own reader gives it."""
    root, got = f"{scratch}/store", []
    copy(spark, root)
    options = {"project": root, "logstore": "events-click", "stop.time": "1750000000"}
    q = (stream_groups(spark, options).writeStream.foreachBatch(lambda b, i: got.extend(map(str, b.collect())))
         .option("checkpointLocation", f"{scratch}/checkpoint").trigger(processingTime="0 seconds").start())
    assert end_when_finished(q, options, timeout=120) and offset_of(q)
    assert sorted(got) == sorted(map(str, read_log_store(spark, root).collect()))


def test_few_positions_of_a_large_file_are_read_in_bounded_batches(spark, scratch, monkeypatch):
    """stream_stops_itself (F3): a batch of a shard's groups decoded its whole file."""
    from shardlake.sources import positions_source
    from shardlake.sources.manifest import ROW_GROUP
    root, n = f"{scratch}/store", 3 * ROW_GROUP - 500
    one = events_log_store(spark, SF).where("logstore = 'events-click' AND shard = 0 AND seq = 0")
    write_log_store(one.drop("seq").crossJoin(spark.range(n).withColumnRenamed("id", "seq")).select(one.columns).coalesce(1), root)
    store = Store(root)
    s = store.shards(lambda name: True)["events-click$0"]
    parts = [p for p in (positions_source.file_partition(s, f, ROW_GROUP + 10, ROW_GROUP + 50) for f in s["files"]) if p]
    asked, whole = [], positions_source.pq.ParquetFile.iter_batches
    monkeypatch.setattr(positions_source.pq.ParquetFile, "iter_batches",
                        lambda self, **kw: asked.append(sum(self.metadata.row_group(g).num_rows for g in kw["row_groups"])) or whole(self, **kw))
    monkeypatch.setattr(positions_source, "READ_BYTES", 1)
    got = [b for p in parts for b in positions_source.read_groups(store, p, ["seq", "logs"])]
    assert [q for b in got for q in b.column("seq").to_pylist()] == list(range(ROW_GROUP + 10, ROW_GROUP + 50))
    assert 0 < sum(asked) <= ROW_GROUP * len(parts) and max(b.num_rows for b in got) == 1


def test_a_stream_that_moves_is_not_given_up_and_few_groups_share_a_task(spark, scratch):
    """stream_group_cap (F2): batches grow with the store, the time for all did not."""
    class Query:
        isActive, at = True, 0

        @property
        def lastProgress(self):
            self.at += 1
            return {"sources": [{"endOffset": {"events-click$0": min(self.at, 8)}}]}

    root = f"{scratch}/store"
    copy(spark, root)
    options = {"project": root, "logstore": "events-click"}
    start = time.monotonic()
    assert not end_when_finished(Query(), options, poll=0.2, idle=1.0)
    assert time.monotonic() - start >= 7 * 0.2 + 1.0       # it moved for seven polls
    reader = GroupStreamReader({**options, "max.number.per.fetch": "1"})
    begin, parts = reader.initialOffset(), reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert len(begin) > 1 and len(parts) == 1 and len(parts[0].parts) == len(begin)
