"""Log tables declared by SQL text alone (T1, T2, T4): format ``shardlake``.

    CREATE TEMPORARY VIEW access (level STRING, status INT, `__shard__` INT, `__time__` TIMESTAMP_NTZ)
    USING shardlake OPTIONS (project '/data/logstores', logstore 'access-.*', logstore.pattern 'true');
    SELECT level, count(*) FROM access WHERE `__shard__` = 2 GROUP BY level;
    INSERT INTO access_sink SELECT level, status FROM somewhere

The options are those of ``sql.LogTableOptions``.  Register the format once in
a session: :func:`register_format`.

Reading plans from the store's manifest: a partition is the part of one file
inside its shard's start and stop positions.  Conditions on ``__shard__`` and
``__cursor__`` leave out files, those on ``__topic__`` and ``__source__`` reach
the Parquet reader; Spark applies all of them again.

Inserting: tasks write their records as groups numbered from 0 into staged
files.  The commit gives each file its positions behind its shard's end by one
version of the manifest, so rows are readable and their positions fixed from
then on.  The next Spark job that opens the store rewrites those files with
their positions, one task for each (:func:`place_inserted`); until then readers
of this module and of ``positions_source`` add them.  A failed statement leaves
nothing; one repeated by its user inserts again.

Differences from ``register_log_table``: a start from ``checkpoint`` and the
type TIME are not available here, and an insert takes floating point through
columns declared STRING (Spark casts them).
"""
from __future__ import annotations

import base64
import binascii
import datetime as dt
import re
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
                                    LessThan, LessThanOrEqual, WriterCommitMessage)
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from ..functions.parse import UnsupportedType
from ..functions.values import BITS, rule, texts, typed
from ..model import (ENCODE_METADATA, FIELD_CURSOR, FIELD_HASH_KEY, FIELD_LOGSTORE, FIELD_SHARD, FIELD_SOURCE, FIELD_TIME, FIELD_TOPIC,
                     LOG_GROUP)
from ..operators.encode import BLANK
from ..session import workers_find_library
from .manifest import ATTEMPTS, ENTRY, FOLDER, STAGED, ManifestConflict
from .positions_source import Groups, GroupStreamReader, Store, cursor_texts, file_partition, read_groups, rebased

FORMAT = "shardlake"
MAX_LINES, MAX_BYTES = 4096, 3 * 1024 * 1024
#: Bytes of records that a writing task holds before it closes its groups.
HELD_BYTES = 64 * 1024 * 1024
STORED = pa.schema([f for f in to_arrow_schema(LOG_GROUP) if f.name not in ("logstore", "shard")])
COMPARE = {EqualTo: lambda x, v: x == v, In: lambda x, v: x in v, GreaterThan: lambda x, v: x > v, GreaterThanOrEqual: lambda x, v: x >= v,
           LessThan: lambda x, v: x < v, LessThanOrEqual: lambda x, v: x <= v}
TIMES = (T.TimestampNTZType, T.TimestampType)


def register_format(spark: SparkSession) -> None:
    """Make ``USING shardlake`` known to this session."""
    workers_find_library(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LogTable)


class LogTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        raise ValueError("declare the columns: CREATE TEMPORARY VIEW name (column TYPE, ...) USING shardlake OPTIONS (...)")

    def reader(self, schema: T.StructType) -> "LogTableReader":
        return LogTableReader(schema, dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> "LogTableWriter":
        if overwrite:
            raise ValueError("Only INSERT rows can be written to a log store: it cannot be overwritten")
        return LogTableWriter(schema, dict(self.options))


def _known(store: Store) -> None:
    """A store must have a manifest: without one its files have no positions."""
    found = store.fs.get_file_info(pafs.FileSelector(store.root, allow_not_found=True))
    if any("=" in f.base_name for f in found) and not any(f.base_name == FOLDER for f in found):
        raise ValueError(f"{store.root} has no manifest yet: open it once by shardlake.sources.manifest.open_store")


class LogTableReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.declared = schema
        for f in schema.fields:
            if not isinstance(f.dataType, (T.StringType, T.CharType, T.VarcharType)):
                rule(f.dataType)
        self.scan = GroupStreamReader({k: v for k, v in options.items() if k != "path"})
        if not self.scan.options.project:
            raise ValueError("option 'project' is required")
        self.strict = not self.scan.options.ignore_parse_errors
        self.shard_filters: list[Filter] = []
        self.positions: set[int] | None = None
        self.where: pc.Expression | None = None

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            self._narrow(f)
            yield f     # Spark applies it again

    def _narrow(self, f: Filter) -> None:
        if type(f) not in COMPARE or len(f.attribute) != 1:
            return
        column, values = f.attribute[0], f.value if isinstance(f, In) else (f.value,)
        if column == FIELD_SHARD and all(isinstance(v, int) for v in values):
            self.shard_filters.append(f)
        elif isinstance(f, (EqualTo, In)) and all(isinstance(v, str) for v in values):
            if column == FIELD_CURSOR:
                found = {p for p in map(position_of, values) if p is not None}
                self.positions = found if self.positions is None else self.positions & found
            elif column in (FIELD_TOPIC, FIELD_SOURCE):
                part = pc.field(column.strip("_")).isin(list(values))
                self.where = part if self.where is None else self.where & part

    def partitions(self) -> list[Groups]:
        scan, out = self.scan, []
        _known(scan.store)
        for _, s in sorted(scan.store.shards(scan._wanted).items()):
            if not all(COMPARE[type(f)](s["shard"], f.value) for f in self.shard_filters):
                continue
            lo = s["end"] if scan.start.kind == "latest" else scan._begin(s)
            stop = None if scan.stop is None else scan.store.first_at(s, scan.stop)
            hi = s["end"] if stop is None else stop
            if self.positions is not None:
                inside = [p for p in self.positions if lo <= p < hi]
                lo, hi = (min(inside), max(inside) + 1) if inside else (0, 0)
            out += [p for p in (file_partition(s, f, lo, hi) for f in s["files"]) if p is not None]
        return out

    def read(self, partition: Groups | None) -> Iterator[pa.RecordBatch]:
        if partition is None:       # how Spark reads a table without partitions
            return
        for b in read_groups(self.scan.store, partition, ["seq", "cursor", "topic", "source", "logs"], self.where):
            yield decoded(b, partition.shard, self.declared, self.strict)


def position_of(cursor: str) -> int | None:
    """The position that has this cursor text; None where none has."""
    try:
        seq = int(base64.b64decode(cursor, validate=True))
    except (binascii.Error, ValueError):
        return None
    return seq if cursor_texts([seq])[0] == cursor else None


def decoded(groups: pa.RecordBatch, shard: int, schema: T.StructType, strict: bool) -> pa.RecordBatch:
    """D1-D9 on a batch of groups: one row per log, typed declared columns."""
    logs = groups.column("logs")
    of, flat = pc.list_parent_indices(logs), pc.list_flatten(logs)
    time, nanos, contents = (pc.struct_field(flat, [name]) for name in ("time", "time_ns", "contents"))
    at, pairs = pc.list_parent_indices(contents).to_numpy(), pc.list_flatten(contents)
    keys, values = pc.struct_field(pairs, ["key"]), pc.struct_field(pairs, ["value"])
    n = len(flat)

    def content(name: str) -> pa.Array:
        places = np.flatnonzero(pc.fill_null(pc.equal(keys, name), False).to_numpy(zero_copy_only=False))
        last = np.full(n, -1, np.int64)
        last[at[places]] = places       # places rise: the last of repeated keys stays
        return values.take(pa.array(last, mask=last < 0))

    def column(name: str, dtype: T.DataType) -> pa.Array:
        if name == FIELD_TIME and isinstance(dtype, (*TIMES, T.DateType)):
            seconds = pc.cast(time, pa.int64()).to_pylist()
            parts = zip(seconds, nanos.to_pylist())
            if isinstance(dtype, T.DateType):
                return pa.array([None if s is None else s // 86400 for s in seconds], pa.int32()).cast(pa.date32())
            micros = [None if s is None or ns is None else s * 1000000 + ns // 1000 for s, ns in parts]
            return pa.array(micros, pa.int64()).cast(to_arrow_type(dtype))
        if name == FIELD_TIME:
            text = time.cast(pa.string())
        elif name == FIELD_SHARD:
            text = pa.array([str(shard)] * n, pa.string())
        elif name in (FIELD_TOPIC, FIELD_SOURCE, FIELD_CURSOR):
            text = groups.column(name.strip("_")).take(of)
        else:
            text = content(name)
        return typed(text, dtype, name, strict)

    return pa.RecordBatch.from_arrays([column(f.name, f.dataType) for f in schema.fields], schema=to_arrow_schema(schema))


@dataclass
class Inserted(WriterCommitMessage):
    """The staged files of a task: (log store, shard, path, groups)."""
    files: list


class LogTableWriter(DataSourceArrowWriter):
    def __init__(self, schema: T.StructType, options: dict):
        from ..sql import LogTableOptions
        self.options = opts = LogTableOptions.from_options({k: v for k, v in options.items() if k != "path"})
        if not opts.project:
            raise ValueError("option 'project' is required")
        if opts.logstore_pattern or "," in opts.logstore:
            raise ValueError("a sink writes to one default log store, not to a list or a pattern")
        self.declared, self.store, self.token = schema, Store(opts.project), uuid.uuid4().hex
        for f in schema.fields:
            if f.name == FIELD_TIME and not isinstance(f.dataType, (*TIMES, *BITS, T.StringType)):
                raise UnsupportedType(f"{FIELD_TIME} must be a timestamp, an integer or text")
            texts(pa.array([], to_arrow_type(f.dataType)), f.dataType)
        _known(self.store)
        have = self.store.shards(lambda name: True).values()
        self.shards = defaultdict(list)
        for s in sorted(have, key=lambda s: (s["logstore"], s["shard"])):
            if not s["readonly"]:
                self.shards[s["logstore"]].append(s["shard"])
        if not any(s["logstore"] == opts.logstore for s in have):
            self.shards[opts.logstore] = list(range(opts.sink_shards))

    def write(self, batches: Iterator[pa.RecordBatch]) -> Inserted:
        out, now = StagedGroups(self.store, self.token), int(dt.datetime.now(dt.timezone.utc).timestamp())
        for b in batches:
            for r in records(b, self.declared, self.options, now):
                out.add(r["logstore"], self._shard(r), r)
        return Inserted(out.close())

    def _shard(self, r: dict) -> int:
        """K7, K9: the shard whose range of keys holds the record's key; by a
        hash of its contents where it has none."""
        shards = self.shards.get(r["logstore"])
        if not shards:
            raise ValueError(f"No shard for a record of log store {r['logstore']}")
        if r["hash_key"] is None:
            return shards[zlib.crc32(repr((r["time"], r["contents"])).encode()) % len(shards)]
        if not re.fullmatch("[0-9a-fA-F]{1,32}", r["hash_key"]):
            raise ValueError(f"Not a hash key of 1 to 32 hex digits: {r['hash_key']}")
        prefix, buckets = int(r["hash_key"].ljust(32, "0")[:8], 16), self.options.producer_buckets
        if buckets and self.options.producer_adjust_shard_hash:
            prefix = -(-((prefix * buckets >> 32) << 32) // buckets)
        return shards[prefix * len(shards) >> 32]

    def commit(self, messages: list) -> None:
        files = [f for m in messages if m is not None for f in m.files]
        if not files:
            self.abort(messages)
            return
        for _ in range(ATTEMPTS):
            try:
                return self._put(files)
            except ManifestConflict:
                continue
        raise ManifestConflict(f"{ATTEMPTS} attempts on {self.store.root}")

    def _put(self, files: list) -> None:
        """The files behind the ends of their shards as the next version."""
        fs, folders = self.store.fs, self.store._folders()
        version = int(folders[-1].split("-")[1]) + 1 if folders else 1
        ends, now, rows = {}, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), []
        for r in self.store.entries():
            if r["kind"] == "file":
                end, when = ends.get((r["logstore"], r["shard"]), (0, now))
                ends[r["logstore"], r["shard"]] = max(end, r["end_seq"]), max(when, r["max_time"])
        for logstore, shard, path, groups in files:
            begin, when = ends.get((logstore, shard), (0, now))
            ends[logstore, shard] = begin + groups, when
            rows.append({"kind": "file", "logstore": logstore, "shard": shard, "path": path, "begin_seq": begin, "end_seq": begin + groups,
                         "min_time": when, "max_time": when, "token": self.token, "version": version})
        rows.append({"kind": "commit", "token": self.token, "version": version})
        final, aside = (f"{self.store.root}/{FOLDER}/{name}" for name in (f"v-{version:012d}", f".aside-{self.token}"))
        fs.create_dir(aside, recursive=True)
        pq.write_table(pa.Table.from_pylist(rows, schema=to_arrow_schema(ENTRY)), f"{aside}/part-0.parquet", filesystem=fs)
        fs.open_output_stream(f"{aside}/_token-{self.token}").close()
        if fs.get_file_info(final).type == pafs.FileType.NotFound:
            try:
                fs.move(aside, final)
            except OSError:
                pass    # another writer's version is in place: seen below
        if fs.get_file_info(f"{final}/_token-{self.token}").type == pafs.FileType.NotFound:
            for left in (aside, f"{final}/.aside-{self.token}"):
                fs.delete_dir_contents(left, missing_dir_ok=True)
            raise ManifestConflict(final)

    def abort(self, messages: list) -> None:
        self.store.fs.delete_dir_contents(f"{self.store.root}/{STAGED}/{self.token}", missing_dir_ok=True)


def records(batch: pa.RecordBatch, schema: T.StructType, opts, now: int) -> Iterator[dict]:
    """K1-K6 on a batch of rows."""
    written = {f.name: texts(c, f.dataType) for f, c in zip(schema.fields, batch.columns)}
    blank = re.compile(re.sub(r"\\x\{(\w+)\}", r"\\u\1", BLANK).replace(r"\z", r"\Z"))
    none = [None] * batch.num_rows
    meta = [written.get(name, none) for name in (FIELD_TOPIC, FIELD_SOURCE, FIELD_LOGSTORE, FIELD_HASH_KEY)]
    times = none
    if FIELD_TIME in written:
        i = schema.fieldNames().index(FIELD_TIME)
        times = [None if v is None else seconds_of(v, schema.fields[i].dataType) for v in raw_times(batch.column(i), schema.fields[i].dataType)]
    fields = [(name, column) for name, column in written.items() if name not in ENCODE_METADATA]
    for i in range(batch.num_rows):
        topic, source, logstore, key = (column[i] for column in meta)
        seconds, nanos = times[i] or (now, 0)
        yield {"logstore": opts.logstore if logstore is None or blank.match(logstore) else logstore,
               "topic": opts.sink_topic if topic is None else topic, "source": opts.sink_source if source is None else source,
               "hash_key": key, "time": seconds, "time_ns": nanos,
               "contents": [{"key": name, "value": column[i]} for name, column in fields if column[i] is not None]}


def raw_times(column: pa.Array, dtype: T.DataType) -> list:
    return (column.cast(pa.int64()) if isinstance(dtype, TIMES) else column).to_pylist()


def seconds_of(value, dtype: T.DataType) -> tuple[int, int]:
    """K4: seconds and nanoseconds of a ``__time__`` value."""
    if isinstance(dtype, TIMES):
        millis = value // 1000
        return (millis // 1000 if millis >= 0 else -(-millis // 1000)), value % 1000000 * 1000
    if isinstance(value, str):
        if not re.search("^[+-]?[0-9]+$", value) or not -2**31 <= int(value) < 2**31:
            raise ValueError(f"For input string: {value}")
    return (int(value) + 2**31) % 2**32 - 2**31, 0


class StagedGroups:
    """Records of a task as groups of at most ``MAX_LINES`` and ``MAX_BYTES``
    in one staged file for each shard, numbered from 0 there."""

    def __init__(self, store: Store, token: str):
        self.store, self.folder, self.name = store, f"{store.root}/{STAGED}/{token}", f"part-{uuid.uuid4().hex}.parquet"
        self.open: dict[tuple, list] = {}       # (log store, shard, topic, source) -> [bytes, logs]
        self.files: dict[tuple, list] = {}      # (log store, shard) -> [writer, path, groups]
        self.held = 0

    def add(self, logstore: str, shard: int, r: dict) -> None:
        size = sum(len(p["key"].encode()) + len(p["value"].encode()) for p in r["contents"])
        key = (logstore, shard, r["topic"], r["source"])
        group = self.open.setdefault(key, [0, []])
        if group[1] and (len(group[1]) >= MAX_LINES or group[0] + size > MAX_BYTES):
            self._write(key)
            group = self.open.setdefault(key, [0, []])
        group[0] += size
        group[1].append({"time": r["time"], "time_ns": r["time_ns"], "contents": r["contents"]})
        self.held += size
        if self.held > HELD_BYTES:
            for key in list(self.open):
                self._write(key)

    def _write(self, key: tuple) -> None:
        size, logs = self.open.pop(key)
        self.held -= size
        logstore, shard, topic, source = key
        if (logstore, shard) not in self.files:
            below = f"logstore={escaped(logstore)}/shard={shard}"
            self.store.fs.create_dir(f"{self.folder}/{below}", recursive=True)
            writer = pq.ParquetWriter(f"{self.folder}/{below}/{self.name}", STORED, filesystem=self.store.fs)
            self.files[logstore, shard] = [writer, f"{below}/{self.name}", 0]
        file = self.files[logstore, shard]
        cursor, following = cursor_texts([file[2], file[2] + 1])
        group = {"seq": file[2], "cursor": cursor, "next_cursor": following, "cursor_time": None, "topic": topic, "source": source,
                 "tags": [], "logs": logs}
        file[0].write_table(pa.Table.from_pylist([group], schema=STORED))
        file[2] += 1

    def close(self) -> list:
        for key in sorted(self.open, key=repr):
            self._write(key)
        for writer, _, _ in self.files.values():
            writer.close()
        return [(logstore, shard, path, groups) for (logstore, shard), (_, path, groups) in sorted(self.files.items())]


def escaped(name: str) -> str:
    """A log store's name as Spark writes it in a folder's name."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 0x20 or c in "\"#%'*/:=?\\{[]^\x7f" else c for c in name)


def place_inserted(files: DataFrame, root: str) -> None:
    """Rewrite committed staged files (``path, token, begin_seq, max_time``)
    with their positions, each in a task of its own; may be repeated."""
    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Store(root)
        for b in batches:
            for r in b.to_pylist():
                place_file(store, r)
            yield b.select(["path"])

    workers_find_library(files.sparkSession)
    todo = files.select("path", "token", "begin_seq", "max_time").repartition("path")
    todo.mapInArrow(move, "path string").foreach(lambda r: None)


def place_file(store: Store, r: dict) -> None:
    fs, staged, final = store.fs, f"{store.root}/{STAGED}/{r['token']}/{r['path']}", f"{store.root}/{r['path']}"
    if fs.get_file_info(final).type == pafs.FileType.File:
        return
    folder, _, name = final.rpartition("/")
    aside = f"{folder}/.{uuid.uuid4().hex}-{name}"
    fs.create_dir(folder, recursive=True)
    with fs.open_input_file(staged) as source, pq.ParquetWriter(aside, STORED, filesystem=fs) as out:
        for b in pq.ParquetFile(source).iter_batches(batch_size=64):
            out.write_batch(rebased(b, r["begin_seq"], r["max_time"]).cast(STORED))
    fs.move(aside, final)
