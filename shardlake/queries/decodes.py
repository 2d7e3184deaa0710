"""Queries over decoding: flatten, projection, typed parse, nested outputs
(D1-D16)."""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parse import parse_value
from ..operators.decode import (content, content_map_record, decode, decode_logs, explode_logs,
                                extract_field, fast_group, log_to_json, raw_group, sequence_number,
                                tag)
from ..sources.fixtures import events_log_store
from .base import with_events
from .registry import register


def logs_of(spark, sf_dir):
    return explode_logs(events_log_store(spark, sf_dir))


# ---------------------------------------------------------------- D1-D3
@register("explode_groups", with_events("""
SELECT logstore, shard, seq, idx, time, time_ns, CAST(n_contents AS INTEGER) AS n_contents FROM logs"""))
def explode_groups(spark, sf_dir):
    return logs_of(spark, sf_dir).select("logstore", "shard", "seq", "idx", "time", "time_ns",
                                         F.size("contents").alias("n_contents"))


@register("project_contents", with_events("""
SELECT logstore, seq, idx, c_event_id AS event_id, c_props AS props, c_value AS value,
       CAST(NULL AS VARCHAR) AS missing, CAST(NULL AS VARCHAR) AS upper_event_id FROM logs"""))
def project_contents(spark, sf_dir):
    lg = logs_of(spark, sf_dir)
    # exact and case-sensitive: 'EVENT_ID' is another (absent) key
    return lg.select("logstore", "seq", "idx", content("event_id").alias("event_id"),
                     content("props").alias("props"), content("value").alias("value"),
                     content("missing").alias("missing"), content("EVENT_ID").alias("upper_event_id"))


@register("last_duplicate_wins", with_events("""
SELECT CAST(event_id AS BIGINT) AS event_id, CAST(c_attempt AS INTEGER) AS attempt,
       CAST(n_contents AS INTEGER) AS n_contents
FROM logs"""))
def last_duplicate_wins(spark, sf_dir):
    lg = explode_logs(events_log_store(spark, sf_dir)).withColumn("n_contents", F.size("contents"))
    return decode_logs(lg, "event_id bigint, attempt int", keep=("n_contents",))


META_SCHEMA = "__time__ int, __topic__ string, __source__ string, __shard__ string, __cursor__ string"


@register("metadata_columns", with_events("""
SELECT logstore, seq, idx, time AS __time__, topic AS __topic__, source AS __source__,
       CAST(shard AS VARCHAR) AS __shard__, cursor AS __cursor__ FROM logs"""))
def metadata_columns(spark, sf_dir):
    return decode(events_log_store(spark, sf_dir), META_SCHEMA, keep=("logstore", "seq", "idx"))


# ---------------------------------------------------------------- D4-D9
TYPED_SCHEMA = ("event_id bigint, user_id int, value double, ok boolean, day date, "
                "at timestamp_ntz, attempt int, props string")

# ``at`` is ISO text with whole seconds for even ids, epoch milliseconds for
# odd ids; ``day`` a date or epoch days; both decode to the event's own time.
AT_SQL = ("CASE WHEN event_id % 2 = 0 THEN date_trunc('second', ts) "
          "ELSE date_trunc('millisecond', ts) END")


@register("typed_parse_strict", with_events(f"""
SELECT CAST(event_id AS BIGINT) AS event_id, CAST(user_id AS INTEGER) AS user_id, value,
       lower(c_ok) = 'true' AS ok, CAST(ts AS DATE) AS day, {AT_SQL} AS at,
       CAST(c_attempt AS INTEGER) AS attempt, props
FROM logs"""))
def typed_parse_strict(spark, sf_dir):
    return decode(events_log_store(spark, sf_dir), TYPED_SCHEMA)


LENIENT_SCHEMA = "event_id bigint, props int, value bigint, ok boolean, clock int, user_id tinyint"


@register("typed_parse_lenient", with_events("""
SELECT CAST(event_id AS BIGINT) AS event_id, CAST(NULL AS INTEGER) AS props, CAST(NULL AS BIGINT) AS value,
       lower(c_ok) = 'true' AS ok,
       CASE WHEN event_id % 2 = 1 THEN CAST(c_clock AS INTEGER) END AS clock,
       CASE WHEN user_id <= 127 THEN CAST(user_id AS TINYINT) END AS user_id
FROM logs"""))
def typed_parse_lenient(spark, sf_dir):
    return decode(events_log_store(spark, sf_dir), LENIENT_SCHEMA, ignore_parse_errors=True)


@register("parse_numeric", with_events("""
SELECT CAST(event_id AS BIGINT) AS event_id, CAST(c_value AS DECIMAL(10,2)) AS value_dec,
       CAST(CAST(c_value AS FLOAT) AS DOUBLE) AS value_float,
       CASE WHEN event_id <= 32767 THEN CAST(event_id AS SMALLINT) END AS id_small,
       CASE WHEN event_id <= 127 THEN CAST(event_id AS TINYINT) END AS id_tiny
FROM logs"""))
def parse_numeric(spark, sf_dir):
    lg = logs_of(spark, sf_dir)
    raw_v, raw_id = content("value"), content("event_id")
    return lg.select(
        parse_value(raw_id, T.LongType(), "event_id", True).alias("event_id"),
        parse_value(raw_v, T.DecimalType(10, 2), "value", True).alias("value_dec"),
        parse_value(raw_v, T.FloatType(), "value", True).cast("double").alias("value_float"),
        # ids above 32767 do not fit: NULL on error
        parse_value(raw_id, T.ShortType(), "event_id", False).alias("id_small"),
        # ids above 127 do not fit: NULL on error
        parse_value(raw_id, T.ByteType(), "event_id", False).alias("id_tiny"))


@register("parse_boolean", with_events("""
SELECT CAST(event_id AS BIGINT) AS event_id, c_ok AS ok_text, lower(c_ok) = 'true' AS ok,
       CAST(NULL AS BOOLEAN) AS props_bool FROM logs"""))
def parse_boolean(spark, sf_dir):
    d = decode(events_log_store(spark, sf_dir), "event_id bigint, ok boolean, props boolean",
               ignore_parse_errors=True, keep=("contents",))
    return d.select("event_id", content("ok").alias("ok_text"), "ok", F.col("props").alias("props_bool"))


@register("parse_date", with_events("""
SELECT CAST(event_id AS BIGINT) AS event_id, c_day AS day_text, CAST(ts AS DATE) AS day FROM logs"""))
def parse_date(spark, sf_dir):
    d = decode(events_log_store(spark, sf_dir), "event_id bigint, day date", keep=("contents",))
    return d.select("event_id", content("day").alias("day_text"), "day")


@register("parse_timestamp", with_events(f"""
SELECT CAST(event_id AS BIGINT) AS event_id, c_at AS at_text, {AT_SQL} AS at FROM logs"""))
def parse_timestamp(spark, sf_dir):
    d = decode(events_log_store(spark, sf_dir), "event_id bigint, at timestamp_ntz", keep=("contents",))
    return d.select("event_id", content("at").alias("at_text"), "at")


@register("parse_time", with_events("""
SELECT CAST(event_id AS BIGINT) AS event_id, c_clock AS clock_text,
       CAST(CASE WHEN event_id % 2 = 0 THEN (us % 86400000000) // 1000000 * 1000
                 ELSE (us % 86400000000) // 1000 END AS INTEGER) AS clock_ms
FROM logs"""))
def parse_time(spark, sf_dir):
    d = decode(events_log_store(spark, sf_dir), "event_id bigint, clock time(3)", keep=("contents",))
    millis = F.time_diff(F.lit("MILLISECOND"), F.expr("TIME'00:00:00'"), F.col("clock"))
    return d.select("event_id", content("clock").alias("clock_text"), millis.cast("int").alias("clock_ms"))


@register("event_time_ns", with_events("""
SELECT CAST(event_id AS BIGINT) AS event_id, ts AS event_time, time_ns FROM logs"""))
def event_time_ns(spark, sf_dir):
    lg = logs_of(spark, sf_dir)
    return decode_logs(lg, "event_id bigint, __time__ timestamp_ntz", keep=("time_ns",)) \
        .select("event_id", F.col("__time__").alias("event_time"), "time_ns")


@register("binary_content", with_events("""
SELECT CAST(event_id AS BIGINT) AS event_id, hex(encode(c_props)) AS props_hex,
       CAST(octet_length(encode(c_props)) AS INTEGER) AS props_bytes FROM logs"""))
def binary_content(spark, sf_dir):
    d = decode(events_log_store(spark, sf_dir), "event_id bigint, props binary")
    return d.select("event_id", F.hex("props").alias("props_hex"),
                    F.octet_length("props").alias("props_bytes"))


# ---------------------------------------------------------------- D10-D16
@register("raw_group_nested", with_events("""
SELECT l.logstore, l.shard, l.seq, CAST(count(*) AS INTEGER) AS n_logs,
       CAST(count(*) * 9 AS INTEGER) AS n_keys,
       CAST(arg_max(l.c_attempt, l.idx) AS VARCHAR) AS last_attempt,
       any_value(g.tag_hostname) AS hostname, any_value(l.source) AS source
FROM logs l JOIN groups g USING (logstore, shard, seq)
GROUP BY l.logstore, l.shard, l.seq"""))
def raw_group_nested(spark, sf_dir):
    r = raw_group(events_log_store(spark, sf_dir))
    logs = F.col("group.logs")
    n_keys = F.aggregate(logs, F.lit(0), lambda acc, lg: acc + F.size(lg["contents"]))
    return r.select("logstore", "shard", "seq", F.size(logs).alias("n_logs"), n_keys.alias("n_keys"),
                    F.element_at(logs, -1)["contents"]["attempt"].alias("last_attempt"),
                    F.col("group.tags")["hostname"].alias("hostname"),
                    F.col("group.source").alias("source"))


@register("fast_group_nested", with_events("""
SELECT logstore, shard, seq, CAST(count(*) AS INTEGER) AS n_logs,
       CAST(sum(n_contents) AS INTEGER) AS n_pairs, arg_min(c_event_id, idx) AS first_key_value
FROM logs GROUP BY logstore, shard, seq"""))
def fast_group_nested(spark, sf_dir):
    r = fast_group(events_log_store(spark, sf_dir))
    logs = F.col("group.logs")
    n_pairs = F.aggregate(logs, F.lit(0), lambda acc, lg: acc + F.size(lg["contents"]))
    return r.select("logstore", "shard", "seq", F.size(logs).alias("n_logs"), n_pairs.alias("n_pairs"),
                    logs[0]["contents"][0]["value"].alias("first_key_value"))


@register("sequence_number", with_events("""
SELECT logstore, CAST(event_id AS BIGINT) AS event_id,
       CAST(shard AS VARCHAR) || '|' || cursor || '|' || CAST(idx AS VARCHAR) AS seq_no FROM logs"""))
def sequence_number_q(spark, sf_dir):
    lg = logs_of(spark, sf_dir)
    return lg.select("logstore", content("event_id").cast("long").alias("event_id"),
                     sequence_number().alias("seq_no"))


@register("tags_to_columns", with_events("""
SELECT l.logstore, l.seq, l.idx, g.tag_hostname AS hostname, g.tag_day AS day, CAST(NULL AS VARCHAR) AS absent
FROM logs l JOIN groups g USING (logstore, shard, seq)"""))
def tags_to_columns(spark, sf_dir):
    lg = logs_of(spark, sf_dir)
    return lg.select("logstore", "seq", "idx", tag("hostname").alias("hostname"), tag("day").alias("day"),
                     tag("absent").alias("absent"))


@register("content_map", with_events("""
SELECT time, topic, source, shard, cursor, c_event_id AS f_event_id, c_attempt AS f_attempt,
       9 AS n_fields FROM logs"""))
def content_map(spark, sf_dir):
    rec = content_map_record(logs_of(spark, sf_dir))
    return rec.select("time", "topic", "source", "shard", "cursor",
                      F.col("fields")["event_id"].alias("f_event_id"),
                      F.col("fields")["attempt"].alias("f_attempt"), F.size("fields").alias("n_fields"))


JSON_SQL = """'{' || '"event_id":' || to_json(c_event_id) || ',"user_id":' || to_json(c_user_id)
       || ',"value":' || to_json(c_value) || ',"props":' || to_json(c_props) || ',"ok":' || to_json(c_ok)
       || ',"day":' || to_json(c_day) || ',"at":' || to_json(c_at) || ',"clock":' || to_json(c_clock)
       || ',"attempt":' || to_json(c_attempt) || '}'"""


@register("log_to_json", with_events(f"""
SELECT logstore, seq, idx, CAST({JSON_SQL} AS VARCHAR) AS json FROM logs"""))
def log_to_json_q(spark, sf_dir):
    lg = logs_of(spark, sf_dir)
    return lg.select("logstore", "seq", "idx", log_to_json().alias("json"))


@register("extract_field", with_events("""
SELECT logstore, seq, idx, '1' AS attempt FROM logs
UNION ALL
SELECT logstore, seq, idx, c_attempt AS attempt FROM logs WHERE logstore = 'events-error'"""))
def extract_field_q(spark, sf_dir):
    return extract_field(logs_of(spark, sf_dir), "attempt", keep=("logstore", "seq", "idx"))
