"""Queries over encoding and routing."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.decode import content
from ..operators.encode import encode_flatmap, encode_group, encode_rows, json_to_group, time_seconds
from ..operators.packing import pack_greedy
from ..operators.udtf import register_deserializer, register_serializer
from ..operators.route import (bucket_of_key, hash_key_md5, pack_groups, record_bytes, shard_by_hash_key,
                               shard_key_ranges)
from ..sources.fixtures import events_log_store, table
from .base import with_events
from .registry import register

# Fixed query parameter: the "now" of the default record time (epoch seconds).
T_NOW = 1704067200
INT_WRAP_SQL = "CAST(((({v}) % 4294967296) + 4294967296) % 4294967296 AS BIGINT)"


def _int_wrap_sql(v: str) -> str:
    low = INT_WRAP_SQL.format(v=v)
    return f"CAST(CASE WHEN {low} >= 2147483648 THEN {low} - 4294967296 ELSE {low} END AS INTEGER)"


def iso_text_sql(ts: str) -> str:
    """DuckDB text of a timestamp in the shortest ISO form (T separator,
    seconds only when not zero, 3 or 6 fraction digits)."""
    us = f"epoch_us({ts})"
    sub = f"(({us} % 1000000) + 1000000) % 1000000"
    sec = f"((({us} // 1000000) % 60) + 60) % 60"
    return (f"(strftime({ts}, '%Y-%m-%dT%H:%M') || CASE WHEN {sec} = 0 AND {sub} = 0 THEN '' ELSE "
            f"':' || lpad(CAST({sec} AS VARCHAR), 2, '0') || CASE WHEN {sub} = 0 THEN '' "
            f"WHEN {sub} % 1000 = 0 THEN '.' || lpad(CAST({sub} // 1000 AS VARCHAR), 3, '0') "
            f"ELSE '.' || lpad(CAST({sub} AS VARCHAR), 6, '0') END END)")


def iso_time_sql(ms: str) -> str:
    """DuckDB text of a time of day in milliseconds, shortest ISO form."""
    h, m = f"lpad(CAST({ms} // 3600000 AS VARCHAR), 2, '0')", f"lpad(CAST(({ms} // 60000) % 60 AS VARCHAR), 2, '0')"
    s, f = f"lpad(CAST(({ms} // 1000) % 60 AS VARCHAR), 2, '0')", f"lpad(CAST({ms} % 1000 AS VARCHAR), 3, '0')"
    return (f"({h} || ':' || {m} || CASE WHEN ({ms} // 1000) % 60 = 0 AND {ms} % 1000 = 0 THEN '' "
            f"WHEN {ms} % 1000 = 0 THEN ':' || {s} ELSE ':' || {s} || '.' || {f} END)")


def contents_text(contents="contents"):
    """``k=v;k=v`` of a contents array, in order."""
    return F.array_join(F.transform(contents, lambda kv: F.concat(kv["key"], F.lit("="), kv["value"])), ";")


def orders_rows(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    note = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority"))
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", note.alias("note"))


ORDERS_TEXT_SQL = f"""concat_ws(';', 'o_orderkey=' || CAST(o_orderkey AS VARCHAR),
  'o_custkey=' || CAST(o_custkey AS VARCHAR), 'o_orderstatus=' || o_orderstatus,
  'o_totalprice=' || CAST(o_totalprice AS VARCHAR), 'o_orderdate=' || {iso_text_sql('o_orderdate')},
  CASE WHEN o_orderkey % 7 <> 0 THEN 'note=' || o_orderpriority END)"""


# ---------------------------------------------------------------- K1 K3 K5
@register("encode_contents", f"""
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey,
       CAST(CASE WHEN o_orderkey % 7 <> 0 THEN 6 ELSE 5 END AS INTEGER) AS n_contents,
       {ORDERS_TEXT_SQL} AS text
FROM orders""")
def encode_contents(spark, sf_dir):
    rec = encode_rows(orders_rows(spark, sf_dir), now_seconds=T_NOW, keep=("o_orderkey",))
    return rec.select("o_orderkey", F.size("contents").alias("n_contents"), contents_text().alias("text"))


@register("encode_defaults", f"""
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, '' AS topic, CAST(NULL AS VARCHAR) AS source,
       'customers' AS logstore, {T_NOW} AS time, CAST(5 AS INTEGER) AS n_contents
FROM customer""")
def encode_defaults(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    rec = encode_rows(c, default_logstore="customers", now_seconds=T_NOW, keep=("c_custkey",))
    return rec.select("c_custkey", "topic", "source", "logstore", "time", F.size("contents").alias("n_contents"))


TEXT_ROWS_SQL = f"""
SELECT CAST(event_id AS BIGINT) AS event_id, CAST(value AS VARCHAR) AS t_value,
       CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS t_flag,
       CAST(CAST(value AS DECIMAL(12,3)) AS VARCHAR) AS t_price,
       {iso_text_sql('ts')} AS t_ts, CAST(CAST(ts AS DATE) AS VARCHAR) AS t_day,
       CAST(user_id AS VARCHAR) AS t_user, props AS t_props,
       {iso_time_sql('((epoch_us(ts) % 86400000000) // 1000)')} AS t_clock
FROM events"""


@register("encode_text", TEXT_ROWS_SQL)
def encode_text(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    rows = ev.select(
        "event_id", "value", (F.col("event_id") % 2 == 0).alias("flag"),
        F.col("value").cast("decimal(12,3)").alias("price"), "ts", F.to_date("ts").alias("day"),
        F.col("user_id").cast("int").alias("user"), F.encode("props", "UTF-8").alias("props"),
        F.try_to_time(F.date_format("ts", "HH:mm:ss.SSSSSS")).alias("clock"))
    rec = encode_rows(rows, now_seconds=T_NOW)
    c = F.col("contents")
    return rec.select(content("event_id", c).cast("long").alias("event_id"),
                      *[content(n, c).alias(f"t_{n}") for n in
                        ("value", "flag", "price", "ts", "day", "user", "props", "clock")])


# ---------------------------------------------------------------- K2 K4 K6
@register("encode_metadata", f"""
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey,
       CASE WHEN o_orderkey % 3 = 2 THEN 'orders-' || o_orderstatus ELSE 'orders-sink' END AS logstore,
       o_orderpriority AS topic, o_orderstatus AS source, md5(CAST(o_orderkey AS VARCHAR)) AS hash_key,
       CAST(epoch_us(o_orderdate) // 1000000 AS INTEGER) AS time, 'o_totalprice=' || CAST(o_totalprice AS VARCHAR) AS text
FROM orders""")
def encode_metadata(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    rows = o.select(
        k.alias("__id"), F.col("o_orderdate").alias("__time__"), F.col("o_orderpriority").alias("__topic__"),
        F.col("o_orderstatus").alias("__source__"),
        F.when(k % 3 == 0, F.lit(None)).when(k % 3 == 1, F.lit(" \t"))
         .otherwise(F.concat(F.lit("orders-"), F.col("o_orderstatus"))).alias("__logstore__"),
        hash_key_md5(k).alias("__hash_key__"), "o_totalprice")
    rec = encode_rows(rows.select("__time__", "__topic__", "__source__", "__logstore__", "__hash_key__",
                                  "o_totalprice", "__id"),
                      default_topic="orders", default_logstore="orders-sink", now_seconds=T_NOW, keep=("__id",))
    # ``__id`` is an ordinary column: drop its content, keep it as the row key
    rest = F.filter("contents", lambda kv: kv["key"] != "__id")
    return rec.select(F.col("__id").alias("o_orderkey"), "logstore", "topic", "source", "hash_key", "time",
                      contents_text(rest).alias("text"))


@register("encode_time", f"""
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey,
       CAST(epoch_us(o_orderdate) // 1000000 AS INTEGER) AS t_ts,
       {_int_wrap_sql('o_orderkey * 100000007')} AS t_long,
       CAST(CASE WHEN o_totalprice * 10000 >= 2147483647 THEN 2147483647
                 ELSE trunc(o_totalprice * 10000) END AS INTEGER) AS t_double,
       CAST(o_custkey AS INTEGER) AS t_text
FROM orders""")
def encode_time(spark, sf_dir):
    """K4 for each type a ``__time__`` column can have, in one projection."""
    o = table(spark, sf_dir, "orders")
    variants = {
        "t_ts": F.col("o_orderdate"),
        "t_long": F.col("o_orderkey") * F.lit(100000007),
        "t_double": F.col("o_totalprice") * F.lit(10000.0),
        "t_text": F.col("o_custkey").cast("string"),
    }
    typed = o.select("o_orderkey", *[e.alias(n) for n, e in variants.items()])
    dtypes = {f.name: f.dataType for f in typed.schema.fields}
    return typed.select("o_orderkey", *[time_seconds(F.col(n), dtypes[n]).alias(n) for n in variants])


@register("route_logstore", """
SELECT CASE WHEN role = 'user' THEN 'conv-user' ELSE 'conversations' END AS logstore,
       CAST(count(*) AS BIGINT) AS n_records
FROM conversations GROUP BY 1""")
def route_logstore(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    ls = (F.when(F.col("role") == "system", F.lit("")).when(F.col("role") == "assistant", F.lit("   "))
           .otherwise(F.lit("conv-user")))
    rec = encode_rows(c.select("conv_id", "turn", "text", ls.alias("__logstore__")),
                      default_logstore="conversations", now_seconds=T_NOW)
    return rec.groupBy("logstore").agg(F.count(F.lit(1)).alias("n_records"))


# ---------------------------------------------------------------- K7-K9
def page_shards(pages):
    """The target store's shards, derived from the pages: ``pmod(page_id, 4)``."""
    return pages.select(F.lit("pages").alias("logstore"),
                        F.pmod(F.col("page_id"), F.lit(4)).cast("int").alias("shard")).distinct()


PREFIX_SQL = "CAST('0x' || substr(md5(url), 1, 8) AS BIGINT)"


@register("route_hash_key", f"""
SELECT CAST(page_id AS BIGINT) AS page_id, md5(url) AS hash_key,
       CAST(({PREFIX_SQL} * (SELECT count(DISTINCT page_id % 4) FROM pages)) // 4294967296 AS INTEGER) AS shard
FROM pages""")
def route_hash_key(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    rec = encode_rows(p.select("page_id", "url", hash_key_md5("url").alias("__hash_key__")),
                      default_logstore="pages", now_seconds=T_NOW, keep=("page_id",))
    routed = shard_by_hash_key(rec, shard_key_ranges(page_shards(p)))
    return routed.select("page_id", "hash_key", "shard")


@register("hash_key_md5", """
SELECT CAST(page_id AS BIGINT) AS page_id, md5(url) AS hash_key, md5(html) AS body_key FROM pages""")
def hash_key_md5_q(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", hash_key_md5("url").alias("hash_key"), hash_key_md5("html").alias("body_key"))


@register("hash_bucket", f"""
SELECT CAST(page_id AS BIGINT) AS page_id, CAST(({PREFIX_SQL} * 16) // 4294967296 AS INTEGER) AS bucket
FROM pages""")
def hash_bucket(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", bucket_of_key(hash_key_md5("url"), 16).alias("bucket"))


# ---------------------------------------------------------------- K10-K14
CONV_CONTENTS_SQL = ("(CASE WHEN conv_id IS NULL THEN 0 ELSE 1 END + CASE WHEN turn > 0 THEN 1 ELSE 0 END"
                     " + CASE WHEN role IS NULL THEN 0 ELSE 1 END + CASE WHEN text IS NULL THEN 0 ELSE 1 END)")


@register("encode_skips", f"""
SELECT CAST(conv_id AS VARCHAR) AS source, CAST(count(*) AS INTEGER) AS n_logs,
       CAST(sum({CONV_CONTENTS_SQL}) AS INTEGER) AS n_contents
FROM conversations WHERE role <> 'system'
GROUP BY conv_id""")
def encode_skips(spark, sf_dir):
    """K10 on the group writer: system turns have no log item (skipped);
    the content of turn 0 gets a NULL key (dropped); conversations left
    without logs are not written."""
    c = table(spark, sf_dir, "conversations")
    rec = encode_rows(c, now_seconds=T_NOW, keep=("conv_id", "turn", "role"))
    nulled = F.transform("contents", lambda kv: F.struct(
        F.when((kv["key"] != "turn") | (F.col("turn") > 0), kv["key"]).alias("key"), kv["value"].alias("value")))
    rec = rec.withColumn("contents", F.when(F.col("role") != "system", nulled))
    grouped = encode_group(rec.withColumn("source", F.col("conv_id").cast("string")), ["conv_id"])
    return grouped.select("source", F.size("logs").alias("n_logs"),
                          F.aggregate("logs", F.lit(0), lambda acc, lg: acc + F.size(lg["contents"])).alias("n_contents"))


PACK_LINES, PACK_BYTES = 4, 20000
DOC_BYTES_SQL = ("(6 + strlen(CAST(doc_id AS VARCHAR)) + coalesce(4 + strlen(text), 0)"
                 " + 7 + strlen(CAST(n_chars AS VARCHAR)))")


@register("pack_groups", f"""
WITH r AS (
  SELECT lang, source, doc_id, {DOC_BYTES_SQL} AS bytes,
         (row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) - 1) // {PACK_LINES} AS line_block
  FROM documents),
c AS (
  SELECT *, coalesce(sum(bytes) OVER (PARTITION BY lang, source, line_block ORDER BY doc_id
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM r),
b AS (
  SELECT *, 2 * (before // {PACK_BYTES})
            + CASE WHEN (before + bytes - 1) // {PACK_BYTES} > before // {PACK_BYTES} THEN 1 ELSE 0 END AS byte_block
  FROM c)
SELECT lang AS topic, source, CAST(line_block AS BIGINT) AS line_block, CAST(byte_block AS BIGINT) AS byte_block,
       CAST(count(*) AS BIGINT) AS n_records, CAST(sum(bytes) AS BIGINT) AS n_bytes, min(doc_id) AS first_doc
FROM b GROUP BY ALL""")
def pack_groups_q(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    rows = d.select("doc_id", "text", "n_chars", F.col("lang").alias("__topic__"), F.col("source").alias("__source__"))
    rec = encode_rows(rows, default_logstore="documents", now_seconds=T_NOW, keep=("doc_id",))
    packed = pack_groups(rec, ["doc_id"], max_lines=PACK_LINES, max_bytes=PACK_BYTES)
    return (packed.groupBy("topic", "source", "line_block", "byte_block")
                  .agg(F.count(F.lit(1)).alias("n_records"), F.sum(record_bytes()).alias("n_bytes"),
                       F.min("doc_id").alias("first_doc")))


# A group that starts at a record ends before the first record with which it
# would pass a limit; the recursion walks from start to start.
@register("pack_groups_greedy", f"""
WITH RECURSIVE r AS (
  SELECT lang, source, doc_id, {DOC_BYTES_SQL} AS bytes, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY lang, source) AS n,
         sum({DOC_BYTES_SQL}) OVER (PARTITION BY lang, source ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS through
  FROM documents WINDOW w AS (PARTITION BY lang, source ORDER BY doc_id)),
a AS (
  SELECT r.*, greatest(r.pos + 1, least(r.pos + {PACK_LINES}, r.n, coalesce(e.pos + 1, 0))) AS next
  FROM r ASOF LEFT JOIN r AS e
    ON r.lang IS NOT DISTINCT FROM e.lang AND r.source IS NOT DISTINCT FROM e.source
       AND r.through - r.bytes + {PACK_BYTES} >= e.through),
walk AS (
  SELECT lang, source, pos, next FROM a WHERE pos = 0
  UNION ALL
  SELECT a.lang, a.source, a.pos, a.next FROM walk JOIN a
    ON walk.lang IS NOT DISTINCT FROM a.lang AND walk.source IS NOT DISTINCT FROM a.source AND walk.next = a.pos)
SELECT w.lang AS topic, w.source, CAST(w.next AS BIGINT) AS group_end, CAST(count(*) AS BIGINT) AS n_records,
       CAST(sum(r.bytes) AS BIGINT) AS n_bytes, min(r.doc_id) AS first_doc, max(r.doc_id) AS last_doc
FROM walk w JOIN r ON w.lang IS NOT DISTINCT FROM r.lang AND w.source IS NOT DISTINCT FROM r.source
                  AND r.pos >= w.pos AND r.pos < w.next
GROUP BY ALL""")
def pack_groups_greedy_q(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    rows = d.select("doc_id", "text", "n_chars", F.col("lang").alias("__topic__"), F.col("source").alias("__source__"))
    rec = encode_rows(rows, default_logstore="documents", now_seconds=T_NOW, keep=("doc_id",))
    packed = pack_greedy(rec, ["doc_id"], max_lines=PACK_LINES, max_bytes=PACK_BYTES)
    return (packed.groupBy("topic", "source", "group_end")
                  .agg(F.count(F.lit(1)).alias("n_records"), F.sum(record_bytes()).alias("n_bytes"),
                       F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")))


@register("encode_group", """
SELECT CAST(conv_id AS BIGINT) AS conv_id, 'conversations' AS logstore, CAST(count(*) AS INTEGER) AS n_logs,
       CAST(sum(3 + CASE WHEN text IS NULL THEN 0 ELSE 1 END) AS INTEGER) AS n_contents,
       'conv-' || CAST(conv_id AS VARCHAR) AS tag_conv
FROM conversations GROUP BY conv_id""")
def encode_group_q(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    rec = encode_rows(c.select("conv_id", "turn", "role", "text"), default_logstore="conversations",
                      now_seconds=T_NOW, keep=("conv_id",))
    tags = F.create_map(F.lit("conv"), F.concat(F.lit("conv-"), F.col("conv_id").cast("string")))
    g = encode_group(rec, ["conv_id"], tags=tags)
    return g.select("conv_id", "logstore", F.size("logs").alias("n_logs"),
                    F.aggregate("logs", F.lit(0), lambda acc, lg: acc + F.size(lg["contents"])).alias("n_contents"),
                    F.col("tags")["conv"].alias("tag_conv"))


@register("encode_flatmap", """
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(count(*) AS BIGINT) AS n_records,
       CAST(sum(strlen(line)) AS BIGINT) AS n_bytes
FROM lines WHERE line <> '' GROUP BY doc_id""")
def encode_flatmap_q(spark, sf_dir):
    """One record per non-empty line of each whole document."""
    d = table(spark, sf_dir, "documents")
    lines = F.filter(F.split(F.col("text"), "\n", -1), lambda x: x != "")
    records = F.transform(lines, lambda x: F.struct(
        F.lit("documents").alias("logstore"), F.col("lang").alias("topic"), F.col("source").alias("source"),
        F.lit(None).cast("string").alias("hash_key"), F.lit(T_NOW).alias("time"), F.lit(0).alias("time_ns"),
        F.array(F.struct(F.lit("line").alias("key"), x.alias("value")),
                F.struct(F.lit("doc_id").alias("key"), F.col("doc_id").cast("string").alias("value")))
        .alias("contents")))
    rec = encode_flatmap(d, records)
    line = content("line")
    return (rec.groupBy(content("doc_id").cast("long").alias("doc_id"))
               .agg(F.count(F.lit(1)).alias("n_records"), F.sum(F.octet_length(line)).cast("long").alias("n_bytes")))


@register("json_to_group", """
SELECT CAST(event_id AS BIGINT) AS event_id, event_type AS tag_type, CAST(1 AS INTEGER) AS n_tags,
       CAST(1 AS INTEGER) AS n_contents, CAST(json_extract(props, '$.k') AS VARCHAR) AS k
FROM events""")
def json_to_group_q(spark, sf_dir):
    """A JSON line per event with a ``__tag__:type`` key; tags and
    contents split by the prefix."""
    ev = table(spark, sf_dir, "events")
    line = F.concat(F.lit('{"__tag__:type": "'), F.col("event_type"), F.lit('", '), F.expr("substr(props, 2)"))
    g = ev.select("event_id", json_to_group(line, now_seconds=T_NOW).alias("g"))
    contents = F.col("g.logs")[0]["contents"]
    return g.select("event_id", F.col("g.tags")["type"].alias("tag_type"), F.size("g.tags").alias("n_tags"),
                    F.size(contents).alias("n_contents"), content("k", contents).alias("k"))


@register("sink_round_trip", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_totalprice, o_orderdate, o_orderstatus,
       CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS note
FROM orders""")
def sink_round_trip(spark, sf_dir):
    """Rows -> records -> log groups (at most 100 logs each) -> decoded rows:
    the rows come back (the sink integration check, by value)."""
    rec = encode_rows(orders_rows(spark, sf_dir), default_logstore="orders", now_seconds=T_NOW)
    groups = encode_group(rec, ["logstore"], order=("time",), max_logs=100)
    from ..operators.decode import decode
    return decode(groups, "o_orderkey bigint, o_totalprice double, o_orderdate timestamp_ntz, "
                          "o_orderstatus string, note string")


SINK_LINES = 50


@register("sink_groups", f"""
WITH r AS (
  SELECT o_orderpriority AS topic, o_orderstatus AS source,
         CAST(({PREFIX_SQL.replace('url', 'CAST(o_orderkey AS VARCHAR)')} * 4) // 4294967296 AS INTEGER) AS shard
  FROM orders),
k AS (SELECT shard, topic, source, count(*) AS n FROM r GROUP BY ALL)
SELECT 'orders' AS logstore, shard, CAST(sum((n + {SINK_LINES} - 1) // {SINK_LINES}) AS BIGINT) AS n_groups,
       CAST(sum(n) AS BIGINT) AS n_logs,
       CAST(sum((n + {SINK_LINES} - 1) // {SINK_LINES}) - 1 AS BIGINT) AS last_seq,
       CAST(max(least(n, {SINK_LINES})) AS INTEGER) AS max_logs_per_group
FROM k GROUP BY shard""")
def sink_groups(spark, sf_dir):
    """Rows -> records routed by hash key to 4 shards -> groups of at most
    50 logs per (shard, topic, source) with dense positions per shard."""
    from ..sources.logstore import records_to_groups
    o = table(spark, sf_dir, "orders")
    rows = o.select("o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("__topic__"),
                    F.col("o_orderstatus").alias("__source__"), hash_key_md5("o_orderkey").alias("__hash_key__"))
    rec = encode_rows(rows, default_logstore="orders", now_seconds=T_NOW)
    shards = rec.select("logstore", F.pmod(F.xxhash64("contents"), F.lit(4)).cast("int").alias("shard")).distinct()
    g = records_to_groups(rec, shards, max_lines=SINK_LINES, max_bytes=None, write_time="2024-01-01 00:00:00")
    return g.groupBy("logstore", "shard").agg(
        F.count(F.lit(1)).alias("n_groups"), F.sum(F.size("logs")).cast("long").alias("n_logs"),
        F.max("seq").alias("last_seq"), F.max(F.size("logs")).alias("max_logs_per_group"))


def numbered_contents(group: dict):
    """A row for each content of each log of a group."""
    for idx, log in enumerate(group["logs"]):
        for place, pair in enumerate(log["contents"]):
            yield {"idx": idx, "place": place, "key": pair["key"], "size": len(pair["value"])}


@register("udtf_deserialize", with_events("""
SELECT logstore, shard, key, CAST(count(*) AS BIGINT) AS n, CAST(sum(size) AS BIGINT) AS size, CAST(count(DISTINCT idx) AS BIGINT) AS n_idx
FROM (SELECT logstore, shard, idx, unnest(['event_id', 'user_id', 'value', 'props']) AS key,
             length(unnest([c_event_id, c_user_id, c_value, c_props])) AS size FROM logs)
WHERE size IS NOT NULL AND key <> 'value' GROUP BY ALL"""))
def udtf_deserialize(spark, sf_dir):
    """U1 in SQL: a user's function over the groups as a table function that
    yields a row for each content; three keys are counted and measured."""
    register_deserializer(spark, "numbered_contents", numbered_contents, "idx int, place int, key string, size int")
    events_log_store(spark, sf_dir).createOrReplaceTempView("_groups_to_deserialize")
    return spark.sql("""SELECT logstore, shard, key, count(*) AS n, sum(size) AS size, count(DISTINCT idx) AS n_idx
                        FROM numbered_contents(TABLE(_groups_to_deserialize), 'logstore', 'shard')
                        WHERE key IN ('event_id', 'user_id', 'props') GROUP BY ALL""")


def price_records(order: dict):
    """A record for each order, and one more for a dear one."""
    for topic in ("all", "dear") if order["o_totalprice"] >= 250000 else ("all",):
        yield {"logstore": "orders", "topic": topic, "time": 1704067200, "time_ns": 0,
               "contents": [("order", str(order["o_orderkey"])), ("status", order["o_orderstatus"])]}


@register("udtf_serialize", """
SELECT topic, CAST(o_orderkey AS VARCHAR) AS order_key, o_orderstatus AS status, CAST(2 AS INTEGER) AS n_contents
FROM orders, (VALUES ('all', -1), ('dear', 250000)) AS t(topic, least) WHERE least < 0 OR o_totalprice >= least""")
def udtf_serialize(spark, sf_dir):
    """U3 in SQL: a user's function over rows as a table function that yields
    records."""
    register_serializer(spark, "price_records", price_records)
    spark.read.parquet(f"{sf_dir}/orders.parquet").createOrReplaceTempView("_orders_to_serialize")
    records = spark.sql("SELECT * FROM price_records(TABLE(_orders_to_serialize))")
    return records.select("topic", content("order").alias("order_key"), content("status").alias("status"), F.size("contents").alias("n_contents"))
