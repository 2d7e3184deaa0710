"""Log groups as a stream whose offset is a position for each shard.

``spark.readStream.format("shardlake-groups")`` plans from the store's manifest:
an offset is a map from shard (``logstore$shard``) to its next ``seq``, a batch
takes at most ``max.number.per.fetch`` groups of each shard, and a partition
holds the groups of one file, or of several where they are few.  Executors read their row groups as Arrow
batches.  Shards found later start at their beginning.

``stop.time`` ends each shard before its first group written at or after that
time.  A shard is finished there, or, where nothing was written that late, at
its end once it is read-only or the clock has passed the stop time.  A shard
without a stop time is finished at its end once it is read-only.  The query
ends when all shards are finished: ``end_when_finished``.

Planning runs in a Python process without Spark, so the root must be a path
that ``pyarrow.fs`` reads (local, HDFS, S3).
"""
from __future__ import annotations

import ast
import base64
import datetime as dt
import json
import re
import time
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pads
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from ..model import LOG_GROUP
from .manifest import FOLDER, READONLY, STAGED

FORMAT = "shardlake-groups"
#: Groups of a shard in a batch where no option says otherwise.
GROUPS_PER_FETCH = 100
#: A task for each of a few dozen groups costs more than reading them.
GROUPS_PER_TASK = 200
#: Bytes of groups that a batch of a reading task holds, and of a column chunk
#: that it reads at once.
READ_BYTES, READ_BUFFER = 8 * 1024 * 1024, 1024 * 1024
EPOCH = dt.datetime(1970, 1, 1)


def shard_key(logstore: str, shard: int) -> str:
    return f"{logstore}${shard}"


class Store:
    """The manifest of a store as rows of files, read through ``pyarrow.fs``.
    A version once read is kept."""

    def __init__(self, root: str):
        self.fs, self.root = pafs.FileSystem.from_uri(root if "://" in root else re.sub("^file:/*", "/", root))
        self.root = self.root.rstrip("/")
        self.read: dict[str, list[dict]] = {}
        self.edges: dict[tuple, int] = {}

    def _folders(self) -> list[str]:
        found = self.fs.get_file_info(pafs.FileSelector(f"{self.root}/{FOLDER}", allow_not_found=True))
        names = sorted(f.base_name for f in found)
        snapshots = [n for n in names if n.startswith("s-")]
        base = snapshots[-1][2:] if snapshots else ""
        return snapshots[-1:] + [n for n in names if n.startswith("v-") and n[2:] > base]

    def entries(self) -> list[dict]:
        rows, folders = [], self._folders()
        self.read = {n: r for n, r in self.read.items() if n in folders}
        for name in folders:
            if name not in self.read:
                files = self.fs.get_file_info(pafs.FileSelector(f"{self.root}/{FOLDER}/{name}"))
                parts = [pq.read_table(f.path, filesystem=self.fs, partitioning=None).to_pylist() for f in files if f.base_name.endswith(".parquet")]
                self.read[name] = [r for p in parts for r in p]
            rows += self.read[name]
        return rows

    def shards(self, wanted) -> dict[str, dict]:
        """Per shard its files by position, and whether it is read-only."""
        out: dict[str, dict] = {}
        for r in sorted(self.entries(), key=lambda r: (r["version"], r["begin_seq"] or 0)):
            if r["logstore"] is None or not wanted(r["logstore"]):
                continue
            s = out.setdefault(shard_key(r["logstore"], r["shard"]), {"logstore": r["logstore"], "shard": r["shard"], "files": [], "readonly": False})
            if r["kind"] == "file":
                s["files"].append(r)
            elif r["kind"] == "status":
                s["readonly"] = r["status"] == READONLY
        for s in out.values():
            s["files"].sort(key=lambda r: r["begin_seq"])
            s["begin"] = s["files"][0]["begin_seq"] if s["files"] else 0
            s["end"] = max((r["end_seq"] for r in s["files"]), default=0)
        return out

    def first_at(self, shard: dict, when: dt.datetime) -> int | None:
        """The first position written at or after a time: None if there is none.
        At most one file is opened, and only where the time lies inside it."""
        for f in shard["files"]:
            if f["max_time"] >= when:
                if f["min_time"] >= when:
                    return f["begin_seq"]
                if (f["path"], when) not in self.edges:
                    rows = pq.read_table(f"{self.root}/{f['path']}", filesystem=self.fs, partitioning=None, columns=["seq", "cursor_time"],
                                         filters=pc.field("cursor_time") >= pa.scalar(when, pa.timestamp("us")))
                    self.edges[f["path"], when] = pc.min(rows["seq"]).as_py()
                return self.edges[f["path"], when]
        return None


def seconds(text) -> dt.datetime:
    return EPOCH + dt.timedelta(seconds=int(text))


@dataclass
class Groups(InputPartition):
    """The groups ``[lo, hi)`` of one file.  A file with a ``token`` was
    inserted by SQL and may still be staged, numbered from 0 (``sources.using``):
    its positions begin at ``begin`` and its groups were written at ``when``."""
    path: str
    logstore: str
    shard: int
    lo: int
    hi: int
    begin: int = 0
    token: str | None = None
    when: dt.datetime | None = None


@dataclass
class Several(InputPartition):
    """What one task reads: parts of files one after the other."""
    parts: list[Groups]


def in_tasks(parts: list[Groups]) -> list[Several]:
    """The parts dealt to tasks, in order: a task takes more as long as it has
    at most ``GROUPS_PER_TASK`` groups."""
    out: list[Several] = []
    held = 0
    for p in parts:
        n = p.hi - p.lo
        if not out or held + n > GROUPS_PER_TASK:
            out.append(Several([]))
            held = 0
        out[-1].parts.append(p)
        held += n
    return out


def file_partition(s: dict, f: dict, lo: int, hi: int) -> Groups | None:
    """What of a shard's positions ``[lo, hi)`` lies in its file ``f``."""
    a, z = max(lo, f["begin_seq"]), min(hi, f["end_seq"])
    return Groups(f["path"], s["logstore"], s["shard"], a, z, f["begin_seq"], f["token"], f["max_time"]) if a < z else None


def cursor_texts(positions) -> list[str]:
    return [base64.b64encode(str(p).encode()).decode() for p in positions]


def rebased(groups: pa.RecordBatch, begin: int, when: dt.datetime) -> pa.RecordBatch:
    """Groups numbered from 0 with positions from ``begin`` and a write time;
    columns that are not there are left out."""
    seq = [p + begin for p in groups.column("seq").to_pylist()]
    new = {"seq": pa.array(seq, pa.int64()), "cursor": pa.array(cursor_texts(seq)), "next_cursor": pa.array(cursor_texts(p + 1 for p in seq)),
           "cursor_time": pa.array([when] * len(seq), pa.timestamp("us"))}
    names = groups.schema.names
    return pa.RecordBatch.from_arrays([new[n] if n in new else groups.column(n) for n in names], names)


def read_groups(store: Store, p: Groups, columns: list[str], where: pc.Expression | None = None):
    """Batches of the groups of a partition (``columns`` has ``seq``)."""
    path, staged = f"{store.root}/{p.path}", False
    if p.token is not None and store.fs.get_file_info(path).type == pafs.FileType.NotFound:
        path, staged = f"{store.root}/{STAGED}/{p.token}/{p.path}", True
        if store.fs.get_file_info(path).type == pafs.FileType.NotFound:
            path, staged = f"{store.root}/{p.path}", False      # moved into place meanwhile
    base = p.begin if staged else 0
    within = (pc.field("seq") >= p.lo - base) & (pc.field("seq") < p.hi - base)
    if where is not None:
        within = within & where
    # only the row groups that may hold them, and of each no more than a batch at once:
    # the dataset's scanner decodes whole row groups, several ahead
    file = pads.ParquetFileFormat().make_fragment(path, filesystem=store.fs)
    hits = file.subset(within).row_groups
    if not hits:
        return
    rows = sum(g.num_rows for g in hits)
    size = max(1, min(1000, READ_BYTES * rows // max(1, sum(g.total_byte_size for g in hits))))
    with pq.ParquetFile(path, filesystem=store.fs, metadata=file.metadata, buffer_size=READ_BUFFER) as data:
        for b in data.iter_batches(batch_size=size, row_groups=[g.id for g in hits], columns=columns, use_threads=False):
            b = b.filter(within)
            if b.num_rows:
                b = b.select(columns)
                yield rebased(b, p.begin, p.when) if staged else b


class GroupStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        from ..sql import LogTableOptions
        from ..plans.positions import parse_start_position, parse_stop_time
        own = {k: v for k, v in options.items() if k not in ("path", "start.positions")}
        self.options = LogTableOptions.from_options(own)
        self.cap = self.options.max_number_per_fetch
        self.start = parse_start_position(self.options.scan_startup_mode)
        self.given = json.loads(options["start.positions"]) if options.get("start.positions") else None
        if self.start.kind == "checkpoint" and self.given is None:
            raise ValueError("a start from 'checkpoint' needs its positions: use stream_groups(checkpoints=...)")
        stop = parse_stop_time(self.options.stop_time)
        self.stop = None if stop is None else seconds(stop)
        self.store = Store(self.options.project)
        self.current: dict | None = None

    def _wanted(self, name: str) -> bool:
        sel = self.options.selection()
        if "pattern" in sel:
            return re.fullmatch(sel["pattern"], name) is not None
        names = sel["logstore"]
        return name in ([names] if isinstance(names, str) else names)

    def _begin(self, s: dict) -> int:
        if self.start.kind == "timestamp":
            at = self.store.first_at(s, seconds(self.start.timestamp))
            return s["end"] if at is None else at
        return s["begin"]

    def initialOffset(self) -> dict:
        shards = self.store.shards(self._wanted)
        if self.given is not None:
            return {k: self.given.get(k, self._begin(s)) for k, s in sorted(shards.items())}
        return {k: s["end"] if self.start.kind == "latest" else self._begin(s) for k, s in sorted(shards.items())}

    def latestOffset(self) -> dict:
        if self.current is None:
            self.current = self.initialOffset()
        now = {}
        for k, s in sorted(self.store.shards(self._wanted).items()):
            at = self.current.get(k, self._begin(s))
            stop = None if self.stop is None else self.store.first_at(s, self.stop)
            now[k] = max(at, min(at + self.cap, s["end"] if stop is None else stop))
        self.current = {**self.current, **now}
        return self.current

    def partitions(self, start: dict, end: dict):
        if self.current is None:    # the last batch of a query that starts again
            self.current = end
        out = []
        for k, s in sorted(self.store.shards(self._wanted).items()):
            lo, hi = start.get(k, self._begin(s)), end.get(k, 0)
            out += [p for p in (file_partition(s, f, lo, hi) for f in s["files"]) if p is not None]
        return in_tasks(out)

    def read(self, partition: Several):
        for part in partition.parts:
            yield from self._read(part)

    def _read(self, partition: Groups):
        schema = to_arrow_schema(LOG_GROUP)
        stored = pa.schema([f for f in schema if f.name not in ("logstore", "shard")])
        for b in read_groups(self.store, partition, stored.names):
            b = b.cast(stored)
            n = b.num_rows
            columns = {"logstore": pa.array([partition.logstore] * n, pa.string()), "shard": pa.array([partition.shard] * n, pa.int32()),
                       **{name: b.column(name) for name in stored.names}}
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema], schema=schema)

    def finished(self, at: dict, now: dt.datetime) -> dict[str, bool]:
        """Per shard, whether a read that has come to ``at`` is at its end."""
        out = {}
        for k, s in self.store.shards(self._wanted).items():
            here = at.get(k, self._begin(s))
            stop = None if self.stop is None else self.store.first_at(s, self.stop)
            closed = s["readonly"] or (self.stop is not None and now >= self.stop)
            out[k] = here >= stop if stop is not None else closed and here >= s["end"]
        return out


class GroupSource(DataSource):
    """Format ``shardlake-groups``: rows of ``model.LOG_GROUP``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return LOG_GROUP

    def streamReader(self, schema) -> GroupStreamReader:
        return GroupStreamReader(dict(self.options))


def stream_groups(spark: SparkSession, options: dict, checkpoints: DataFrame | None = None) -> DataFrame:
    """The groups of the log table described by ``options`` as a stream with a
    position for each shard.  A start from a checkpoint resolves the positions
    of the consumer group (``checkpoints``) when the query is made; a query
    that starts again goes on from its own checkpoint."""
    from ..plans.positions import CHECKPOINT, parse_start_position, resolve_positions
    from ..session import workers_find_library
    from ..sql import LogTableOptions
    from .logstore import read_log_store
    from .manifest import FileIndex, open_store
    opts = LogTableOptions.from_options(options)
    open_store(spark, opts.project)     # indexes a store that has no manifest yet
    workers_find_library(spark)
    spark.dataSource.register(GroupSource)
    reader = spark.readStream.format(FORMAT).options(**{k: str(v) for k, v in options.items() if v is not None})
    if parse_start_position(opts.scan_startup_mode).kind == CHECKPOINT:
        sel = opts.selection()
        at = resolve_positions(read_log_store(spark, opts.project, **sel), opts.scan_startup_mode, None, checkpoints, opts.consumer_group,
                               opts.scan_startup_default_position, store=FileIndex(spark, opts.project).select(**sel))
        found = {shard_key(r["logstore"], r["shard"]): r["start_seq"] for r in at.collect()}    # a row per shard
        reader = reader.option("start.positions", json.dumps(found))
    return reader.load()


def offset_of(query) -> dict:
    """The positions that a query's last finished batch has come to."""
    progress = query.lastProgress
    return parsed_offset(progress["sources"][0]["endOffset"]) if progress else {}


def parsed_offset(end) -> dict:
    """An offset as a progress report has it: parsed, its text, or its JSON."""
    if isinstance(end, str):
        end = ast.literal_eval(end) if "'" in end or end == "None" else json.loads(end)
    return end or {}


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def end_when_finished(query, options: dict, poll: float = 0.5, timeout: float | None = None,
                      idle: float | None = None) -> bool:
    """Stop ``query`` (over ``stream_groups``) once every shard is finished and
    delivered; False if it was not within ``timeout`` seconds, or if no shard
    has moved for ``idle`` seconds.  Raises what the query raises."""
    reader = GroupStreamReader({k: str(v) for k, v in options.items() if v is not None} | {"start.positions": "{}"})
    deadline = None if timeout is None else time.monotonic() + timeout
    seen, moved = None, time.monotonic()
    while query.isActive:
        at = offset_of(query)
        if at != seen:
            seen, moved = at, time.monotonic()
        done = reader.finished(at, utc_now()) if at else {}
        if done and all(done.values()):
            query.stop()
            break
        now = time.monotonic()
        if (deadline is not None and now > deadline) or (idle is not None and now - moved > idle):
            return False
        time.sleep(poll)
    if query.exception() is not None:
        raise query.exception()
    return True
