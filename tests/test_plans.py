"""Plans that must keep their shape: what the scan prunes, how often a
content is extracted, and linear last-per-key maps."""
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from shardlake.operators import packing
from shardlake.operators.decode import contents_map, decode
from shardlake.plans.positions import bounded, resolve_positions
from shardlake.sources.fixtures import events_log_groups
from shardlake.sources.logstore import read_log_store, write_log_store
from shardlake.sql import insert_into, log_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans") / "store")
    write_log_store(events_log_groups(spark, SF), root)
    return root


def plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()




def test_bounds_reach_the_scan(spark, store):
    groups = read_log_store(spark, store)
    latest = bounded(groups, resolve_positions(groups, "latest"))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(seq", plan(latest)) and latest.count() == 0
    options = {"project": store, "logstore": "events-click", "scan.startup.mode": "1704499200", "stop.time": "1705708800"}
    timed = plan(log_table(spark, "event_id bigint", options))
    assert "GreaterThanOrEqual(cursor_time" in timed and "LessThan(cursor_time" in timed
    assert "Join" not in timed and re.search(r"PartitionFilters: \[.*logstore.* = events-click", timed)


def test_times_and_positions_select_the_same_groups(spark, store):
    groups = read_log_store(spark, store)
    for start, stop in (("1704499200", None), ("earliest", "1705708800"), ("1704499200", "1705708800")):
        options = {"project": store, "logstore": "events-.*", "logstore.pattern": "true", "scan.startup.mode": start}
        if stop:
            options["stop.time"] = stop
        by_time = log_table(spark, "event_id bigint", options)
        by_position = decode(bounded(groups, resolve_positions(groups, start, stop)), "event_id bigint")
        assert by_time.exceptAll(by_position).count() == by_position.exceptAll(by_time).count() == 0


def test_each_content_is_extracted_once(spark, store):
    schema = "event_id bigint, user_id int, value double, ok boolean, day date, at timestamp_ntz, clock string, attempt int"
    text = plan(decode(read_log_store(spark, store), schema), "optimizedPlan")
    assert 0 < text.count("filter(") <= 8


def test_map_of_many_keys_is_linear(spark):
    def seconds(keys):
        pairs = F.transform(F.sequence(F.lit(1), F.lit(keys)), lambda i: F.struct(
            i.cast("string").alias("key"), i.cast("string").alias("value")))
        df = spark.range(200).select(F.size(contents_map(F.concat(pairs, pairs))).alias("n"))
        df.agg(F.sum("n")).collect()
        t = time.perf_counter()
        assert df.agg(F.sum("n")).first()[0] == 200 * keys
        return time.perf_counter() - t

    assert seconds(4000) < 40 * max(seconds(400), 0.05)


def test_insert_loses_no_row_as_time_goes_on(spark, scratch, monkeypatch):
    """A row without a time is dealt by the time it gets: the same in all jobs
    of the insert, also where they begin in different seconds."""
    persist = packing.persist_fresh

    def slow(df):
        kept = persist(df)
        time.sleep(1.1)
        return kept

    monkeypatch.setattr(packing, "persist_fresh", slow)
    root = os.path.join(scratch, "slow")
    insert_into(spark.range(8).selectExpr("concat('r', id) AS x"), {"project": root, "logstore": "new", "sink.shards": "64"})
    got = read_log_store(spark, root, "new").selectExpr("inline(logs)").collect()
    assert len(got) == 8 and len({r["time"] for r in got}) == 1


def test_insert_creates_its_store_only(spark, scratch):
    root = os.path.join(scratch, "store")
    rows = spark.createDataFrame([("a", None), ("b", "")], "x string, __logstore__ string")
    insert_into(rows, {"project": root, "logstore": "new", "sink.shards": "2"})
    insert_into(rows, {"project": root, "logstore": "new"})
    assert decode(read_log_store(spark, root, "new"), "x string").count() == 4
    with pytest.raises(Exception, match="No shard"):
        insert_into(spark.createDataFrame([("c", "other")], "x string, __logstore__ string"), {"project": root, "logstore": "new"})
    assert decode(read_log_store(spark, root), "x string").count() == 4
