"""The derived log stores restated in DuckDB SQL (oracle side).

``LOGS`` has one row per log of the ``events`` store family with its group
position (``seq``, ``idx``), time parts and each content as a ``c_<key>``
text column; ``GROUPS`` one row per log group.  Must agree with
``sources.fixtures``.
"""
from __future__ import annotations

EVENTS_CTE = """
ev AS (
  SELECT 'events-' || event_type AS logstore,
         CAST(((user_id % 4) + 4) % 4 AS INTEGER) AS shard,
         event_id, ts, user_id, event_type, value, props,
         epoch_us(ts) AS us,
         row_number() OVER (PARTITION BY 'events-' || event_type, ((user_id % 4) + 4) % 4
                            ORDER BY ts, event_id) - 1 AS pos
  FROM events
),
logs AS (
  SELECT logstore, shard, CAST(pos // 10 AS BIGINT) AS seq, CAST(pos % 10 AS INTEGER) AS idx,
         event_id, ts, user_id, event_type, value, props, us,
         CAST(us // 1000000 AS INTEGER) AS time,
         CAST((us % 1000000) * 1000 AS INTEGER) AS time_ns,
         CAST(event_id AS VARCHAR) AS c_event_id,
         CAST(user_id AS VARCHAR) AS c_user_id,
         CAST(value AS VARCHAR) AS c_value,
         props AS c_props,
         CASE WHEN event_id % 3 = 0 THEN 'TRUE' WHEN event_id % 3 = 1 THEN 'false' ELSE 'True' END AS c_ok,
         CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%d')
              ELSE CAST(us // 86400000000 AS VARCHAR) END AS c_day,
         CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
              ELSE CAST(us // 1000 AS VARCHAR) END AS c_at,
         CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%H:%M:%S')
              ELSE CAST((us % 86400000000) // 1000 AS VARCHAR) END AS c_clock,
         CASE WHEN event_type = 'error' THEN CAST(event_id % 3 + 2 AS VARCHAR) ELSE '1' END AS c_attempt,
         CASE WHEN event_type = 'error' THEN 10 ELSE 9 END AS n_contents,
         CASE WHEN shard % 2 = 0 THEN 'web' ELSE 'app' END AS topic,
         '10.0.' || CAST(shard AS VARCHAR) || '.1' AS source,
         to_base64(encode(CAST(pos // 10 AS VARCHAR))) AS cursor
  FROM ev
),
groups AS (
  SELECT logstore, shard, seq, any_value(cursor) AS cursor,
         to_base64(encode(CAST(seq + 1 AS VARCHAR))) AS next_cursor,
         max(ts) AS cursor_time, min(ts) AS first_ts, count(*) AS n_logs,
         any_value(topic) AS topic, any_value(source) AS source,
         'host-' || CAST(shard AS VARCHAR) AS tag_hostname,
         strftime(min(ts), '%Y-%m-%d') AS tag_day
  FROM logs GROUP BY logstore, shard, seq
),
shards AS (
  SELECT logstore, shard, CASE WHEN shard = 3 THEN 'readonly' ELSE 'readwrite' END AS status,
         min(seq) AS begin_seq, max(seq) + 1 AS end_seq
  FROM groups GROUP BY logstore, shard
)"""


def with_events(body: str, *more_ctes: str) -> str:
    """SQL = the events CTEs (+ more) then ``body``."""
    extra = "".join(",\n" + c for c in more_ctes)
    return f"WITH {EVENTS_CTE}{extra}\n{body}"

