"""Positions, log store selection, assignment and skew-safe numbering."""
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shardlake.model import consumer_group_present, cursor_of, seq_of
from shardlake.plans.assign import balanced_tasks, modulo_task, writable_rank_tasks
from shardlake.plans.numbering import position_within
from shardlake.plans.positions import bounded, parse_start_position, parse_stop_time, resolve_positions
from shardlake.sources.logstore import full_match, select_logstores
from shardlake.sql import LogTableOptions, parse_checkpoint_mode


def test_f4_pattern_is_full_match(spark):
    df = spark.createDataFrame([("logstore-1",), ("logstore-perf-1",)], "logstore string")
    got = [r[0] for r in df.where(full_match(F.col("logstore"), "logstore-perf-.*")).collect()]
    assert got == ["logstore-perf-1"]
    assert df.where(full_match(F.col("logstore"), "perf")).count() == 0
    assert select_logstores(df, ["logstore-1"]).count() == 1
    with pytest.raises(ValueError):
        select_logstores(df, [])


def test_f9_consumer_group_present():
    assert [consumer_group_present(x) for x in ("consumer-group", None, "")] == [True, False, False]


def test_start_positions_parse():
    assert parse_start_position(None).kind == "earliest"
    assert parse_start_position("").kind == "earliest"
    assert parse_start_position("BEGIN_CURSOR").kind == "earliest"
    assert parse_start_position(" end_cursor ").kind == "latest"
    assert parse_start_position("consumer_from_checkpoint").kind == "checkpoint"
    p = parse_start_position("1704067200")
    assert (p.kind, p.timestamp) == ("timestamp", 1704067200)
    for bad in ("timestamp", "soon", "99999999999"):
        with pytest.raises(ValueError):
            parse_start_position(bad)
    assert parse_stop_time(None) is None
    with pytest.raises(ValueError):
        parse_stop_time("tomorrow")
    assert parse_checkpoint_mode("on-checkpoints") == "ON_CHECKPOINTS"
    with pytest.raises(ValueError):
        parse_checkpoint_mode("sometimes")
    with pytest.raises(ValueError):
        LogTableOptions.from_options({"logstore": "x", "endpoint": "y"})


def test_cursor_round_trip(spark):
    df = spark.range(0, 1000, 37).select(cursor_of(F.col("id")).alias("c"), "id")
    assert df.where(seq_of("c") != F.col("id")).count() == 0
    assert spark.range(1).select(seq_of(F.lit("not a cursor"))).first()[0] is None


def _groups(spark):
    # two shards; shard 0 written from t=0, shard 1 from t=100; 10 groups each
    rows = [("s", sh, q, 100 * sh + 10 * q) for sh in (0, 1) for q in range(10)]
    df = spark.createDataFrame(rows, "logstore string, shard int, seq long, t long")
    return df.select("logstore", "shard", "seq",
                     F.timestamp_seconds("t").cast("timestamp_ntz").alias("cursor_time"),
                     F.array(F.struct(F.lit(0).alias("time"))).alias("logs"))


def test_resolve_positions(spark):
    g = _groups(spark)

    def pos(**kw):
        p = resolve_positions(g, **kw).orderBy("shard").collect()
        return [(r["start_seq"], r["stop_seq"]) for r in p]

    assert pos(start="earliest") == [(0, None), (0, None)]
    assert pos(start="latest") == [(10, None), (10, None)]
    assert pos(start="latest", as_of=150) == [(10, None), (6, None)]
    assert pos(start=50) == [(5, None), (0, None)]
    assert pos(start="earliest", stop_time=120) == [(0, 10), (0, 2)]
    cp = spark.createDataFrame([("g", "s", 0, cursor_of_text(7), None, None)],
                               "consumer_group string, logstore string, shard int, cursor string, seq long, "
                               "updated_at timestamp_ntz")
    assert pos(start="checkpoint", checkpoints=cp, consumer_group="g", fallback=150) == [(7, None), (5, None)]
    with pytest.raises(ValueError):
        resolve_positions(g, "checkpoint", checkpoints=cp, consumer_group="g", fallback="checkpoint")
    read = bounded(g, resolve_positions(g, "earliest", stop_time=120))
    assert read.count() == 12


def cursor_of_text(n):
    import base64
    return base64.b64encode(str(n).encode()).decode()


def test_assignment(spark):
    shards = spark.createDataFrame([("a", i, "readonly" if i == 3 else "readwrite") for i in range(5)]
                                   + [("b", -3, "readwrite")], "logstore string, shard int, status string")
    m = {(r[0], r[1]): r[2] for r in shards.select("logstore", "shard", modulo_task("shard", 4)).collect()}
    assert m[("b", -3)] == 1 and m[("a", 4)] == 0
    b = [r["task"] for r in balanced_tasks(shards, 4).orderBy("logstore", "shard").collect()]
    assert b == [0, 0, 1, 1, 2, 2]   # ceil(6/4) = 2 shards per reader
    w = {r["shard"]: r["task"] for r in writable_rank_tasks(shards.where("logstore = 'a'"), 2).collect()}
    assert w == {0: 0, 1: 1, 2: 0, 3: 1, 4: 0}


def test_position_within_is_exact_under_skew(spark):
    # one hot key holds most rows; numbering must equal row_number()
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string")))
        .alias("key"), (F.col("id") * 7919 % 30011).alias("o"), "id")
    got = position_within(df, ["key"], ["o", "id"], partitions=16, hot_key_rows=1000)
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("key").orderBy("o", "id")) - 1)
    assert got.select("key", "id", "pos").exceptAll(want.select("key", "id", "pos")).count() == 0
    assert got.count() == want.count()
    # the hot key is cut over several partitions, not funnelled into one
    parts = (df.repartitionByRange(16, "key", "o", "id").where(F.col("key") == "hot")
               .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 4


def test_broadcast_fallback_gives_same_results(spark):
    g = _groups(spark)
    want = sorted(bounded(g, resolve_positions(g, "earliest", stop_time=120)).select("shard", "seq").collect())
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("key"), "id")
    want_pos = sorted(position_within(df, ["key"], ["id"], partitions=8, hot_key_rows=0).collect())
    spark.catalog.clearCache()   # the small sides are re-materialised below
    spark.conf.set("shardlake.broadcast.maxRows", "0")
    # also no automatic broadcast by Spark's own size estimate
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        read = bounded(g, resolve_positions(g, "earliest", stop_time=120))
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastExchange" not in plan and "SortMergeJoin" in plan
        assert sorted(read.select("shard", "seq").collect()) == want
        assert sorted(position_within(df, ["key"], ["id"], partitions=8, hot_key_rows=0).collect()) == want_pos
    finally:
        for k in ("shardlake.broadcast.maxRows", "spark.sql.autoBroadcastJoinThreshold",
                  "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(k)


def test_finished_shards(spark):
    from shardlake.plans.positions import finished_shards
    shards = spark.createDataFrame([("s", 0, "readonly", 5), ("s", 1, "readonly", 5), ("s", 2, "readwrite", 5)],
                                   "logstore string, shard int, status string, end_seq long")
    progress = spark.createDataFrame([("s", 0, 5), ("s", 1, 4), ("s", 2, 5), ("s", 9, 3)],
                                     "logstore string, shard int, next_seq long")
    got = {r["shard"]: r["finished"] for r in finished_shards(shards, progress).collect()}
    assert got == {0: True, 1: False, 2: False, 9: True}


def test_position_within_window_and_range_paths_agree(spark):
    df = spark.range(0, 20000).select((F.col("id") % 5).alias("key"), (F.col("id") * 31 % 20011).alias("o"), "id")
    a = position_within(df, ["key"], ["o", "id"], hot_key_rows=10**9)   # window path
    b = position_within(df, ["key"], ["o", "id"], hot_key_rows=0)       # range path
    assert "Window" in a._jdf.queryExecution().executedPlan().toString()
    assert a.select("id", "pos").exceptAll(b.select("id", "pos")).count() == 0


def test_delivery_checks(spark):
    from shardlake.operators.audit import dedup_by, duplicate_summary, missing_and_unexpected
    expected = spark.createDataFrame([(i,) for i in range(10)], "id long")
    delivered = spark.createDataFrame([(i,) for i in [1, 2, 2, 3, 3, 3, 11, 11]], "id long")
    got = sorted((r["kind"], r["id"]) for r in missing_and_unexpected(expected, delivered, "id").collect())
    assert got == [("missing", i) for i in (0, 4, 5, 6, 7, 8, 9)] + [("unexpected", 11)]
    s = duplicate_summary(delivered, "id").first()
    assert (s["reads"], s["distinct_ids"], s["duplicates"]) == (8, 4, 4)
    assert dedup_by(delivered.withColumn("logstore", F.lit("a")), "id").count() == 4


def test_with_task_keeps_a_shard_in_one_partition(spark):
    from shardlake.plans.assign import with_task
    from shardlake.sources.fixtures import events_log_groups, shards_of
    g = events_log_groups(spark, "/root/testdata/sf0.001")
    tasks = balanced_tasks(shards_of(g), 3)
    placed = with_task(g, tasks, 3).withColumn("_p", F.spark_partition_id())
    assert placed.count() == g.count()
    spread = placed.groupBy("logstore", "shard").agg(F.countDistinct("_p").alias("parts"))
    assert spread.where(F.col("parts") != 1).count() == 0
