"""W7 for each shard: a gauge of how far a stream of groups lags.

The positions a batch has come to are in its progress report (the offset of
``sources.positions_source``); their write times come from the store's
manifest, with at most one file of a shard opened.  So the stream itself
carries no extra aggregate.  A shard's gauge vanishes when the shard is
finished, and all of them when the query ends.
"""
from __future__ import annotations

import datetime as dt

import pyarrow as pa
import pyarrow.compute as pc

from ..sources.positions_source import GroupStreamReader, Groups, parsed_offset, read_groups, utc_now


class ShardLag:
    """``seconds``: shard (``logstore$shard``) -> trigger time minus the write
    time of the last group read.  ``options`` are those of ``stream_groups``;
    register ``listener()`` with ``spark.streams``, for the query named
    ``query_name`` (for every query without one)."""

    def __init__(self, options: dict, query_name: str | None = None):
        self.reader = GroupStreamReader({k: str(v) for k, v in options.items() if v is not None} | {"start.positions": "{}"})
        self.query_name = query_name
        self.seconds: dict[str, float] = {}
        self._queries: set[str] = set()

    def update(self, offset: dict, now: dt.datetime) -> None:
        """Set the gauges from the positions of a batch that was triggered at
        ``now`` (UTC, without a zone)."""
        store = self.reader.store
        shards, finished = store.shards(self.reader._wanted), self.reader.finished(offset, utc_now())
        gauges = {}
        for key, s in shards.items():
            at = offset.get(key, s["begin"])
            if not finished[key] and at > s["begin"]:
                gauges[key] = (now - self._written(s, at - 1)).total_seconds()
        self.seconds = gauges

    def _written(self, shard: dict, seq: int) -> dt.datetime:
        """The write time of a group."""
        f = next(f for f in shard["files"] if f["begin_seq"] <= seq < f["end_seq"])
        if seq == f["end_seq"] - 1 or f["min_time"] == f["max_time"]:
            return f["max_time"]        # write times never fall within a shard
        one = Groups(f["path"], shard["logstore"], shard["shard"], seq, seq + 1, f["begin_seq"], f["token"], f["max_time"])
        rows = pa.Table.from_batches(read_groups(self.reader.store, one, ["seq", "cursor_time"]))
        return pc.max(rows["cursor_time"]).as_py()

    def clear(self) -> None:
        self.seconds = {}

    def listener(self):
        from pyspark.sql.streaming import StreamingQueryListener
        outer = self

        class Listener(StreamingQueryListener):
            def onQueryStarted(self, event):
                if outer.query_name in (None, event.name):
                    outer._queries.add(str(event.runId))

            def onQueryProgress(self, event):
                p = event.progress
                if outer.query_name in (None, p.name) and p.sources:
                    offset = parsed_offset(p.sources[0].endOffset)
                    if offset:
                        outer.update(offset, dt.datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).replace(tzinfo=None))

            def onQueryIdle(self, event):
                pass

            def onQueryTerminated(self, event):
                if str(event.runId) in outer._queries:
                    outer._queries.discard(str(event.runId))
                    outer.clear()

        return Listener()
