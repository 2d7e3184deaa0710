"""The manifest of a log store: which files hold which positions and times.

A store keeps its versions beside its data, in ``<root>/_manifest``.  A version
is a folder of rows: one for each file it adds (log store, shard, ``[begin_seq,
end_seq)``, least and greatest write time), one for a changed shard status and
one that names the commit.  Versions are numbered without a gap and each is put
into place by one rename that fails where the version exists: of two writers
that read the same version one wins, the other reads the new one and moves its
positions behind it (optimistic concurrency).  Many versions are folded into a
snapshot.

Data goes to ``<root>/_staged/<token>`` first, which no reader lists.  The
version that names its files makes them part of the store; then they are
renamed into place.  A writer lost between the two leaves a committed version
with staged files: whoever opens the store next moves them (``settle``).  A
commit may carry a key (writer, batch): a batch that comes again finds its key
and writes nothing.

Rows of the manifest are few (one for each file), so ends of shards, positions
of times and times of positions come from it, with at most one file of a shard
opened.  The file system must have an atomic rename of folders.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import LOG_GROUP, cursor_of

ENTRY = T.StructType([
    T.StructField("kind", T.StringType()),          # file, status or commit
    T.StructField("logstore", T.StringType()),
    T.StructField("shard", T.IntegerType()),
    T.StructField("path", T.StringType()),          # below the root
    T.StructField("begin_seq", T.LongType()),
    T.StructField("end_seq", T.LongType()),
    T.StructField("min_time", T.TimestampNTZType()),
    T.StructField("max_time", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    T.StructField("token", T.StringType()),
    T.StructField("writer", T.StringType()),
    T.StructField("batch", T.LongType()),
    T.StructField("version", T.LongType()),
])
FOLDER, STAGED = "_manifest", "_staged"
#: Versions since the last snapshot that are folded into a new one.
FOLD_AFTER = 32
#: A writer that loses this many races in a row gives up.
ATTEMPTS = 50
READONLY, READWRITE = "readonly", "readwrite"


def _entries(rows: DataFrame) -> DataFrame:
    """``rows`` with all columns of ``ENTRY``, those it lacks null."""
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in ENTRY.fields])


class ManifestConflict(Exception):
    """Another writer has put this version into place."""


def _fs(spark: SparkSession, path: str):
    from .logstore import hadoop_fs
    return hadoop_fs(spark, path)


def _number(name: str) -> int:
    return int(name.split("-")[1])


class Manifest:
    """One state of a store's manifest."""

    def __init__(self, spark: SparkSession, root: str, version: int, folders: list[str]):
        self.spark, self.root, self.version, self._folders = spark, root.rstrip("/"), version, folders

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> "Manifest":
        """The newest version (0 where the store has none)."""
        fs, path = _fs(spark, f"{root.rstrip('/')}/{FOLDER}")
        names = sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []
        snapshots = [n for n in names if n.startswith("s-")]
        base = _number(snapshots[-1]) if snapshots else 0
        later = [n for n in names if n.startswith("v-") and _number(n) > base]
        return cls(spark, root, _number(later[-1]) if later else base, snapshots[-1:] + later)

    def entries(self) -> DataFrame:
        if not self._folders:
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).parquet(*[f"{self.root}/{FOLDER}/{n}" for n in self._folders])

    def files(self) -> DataFrame:
        return self.entries().where("kind = 'file'").select("logstore", "shard", "path", "begin_seq", "end_seq", "min_time", "max_time")

    def ends(self) -> DataFrame:
        """(logstore, shard, begin_seq, end_seq, end_time), one row per shard."""
        return shard_ends(self.files())

    def shards(self) -> DataFrame:
        """The shard table (``model.SHARDS``); the status set last holds."""
        state = (self.entries().where("kind = 'status'").groupBy("logstore", "shard")
                 .agg(F.max_by("status", "version").alias("status")))
        return (self.ends().join(state, ["logstore", "shard"], "full")
                .select("logstore", "shard", F.coalesce("status", F.lit(READWRITE)).alias("status"),
                        F.coalesce("begin_seq", F.lit(0)).cast("long").alias("begin_seq"),
                        F.coalesce("end_seq", F.lit(0)).cast("long").alias("end_seq")))

    def has_batch(self, writer: str, batch: int) -> bool:
        """Whether a writer's batch is committed; its batches come in order."""
        last = self.entries().where((F.col("kind") == "commit") & (F.col("writer") == writer)).agg(F.max("batch")).first()[0]
        return last is not None and batch <= last

    def put(self, rows: DataFrame, token: str, writer: str | None = None, batch: int | None = None) -> "Manifest":
        """Put ``rows`` (of ``ENTRY``) into place as the next version, or raise
        ``ManifestConflict``."""
        version = self.version + 1
        commit = self.spark.createDataFrame([("commit", token, writer, batch)], "kind string, token string, writer string, batch long")
        out = _entries(commit).unionByName(_entries(rows)).withColumn("version", F.lit(version).cast("long"))
        self._place(out, f"v-{version:012d}", token)
        now = Manifest(self.spark, self.root, version, [*self._folders, f"v-{version:012d}"])
        if sum(n.startswith("v-") for n in now._folders) >= FOLD_AFTER:
            now._fold()
        return now

    def _place(self, rows: DataFrame, name: str, token: str) -> None:
        folder = f"{self.root}/{FOLDER}"
        fs, final = _fs(self.spark, f"{folder}/{name}")
        _, aside = _fs(self.spark, f"{folder}/.aside-{token}")
        rows.coalesce(1).write.mode("overwrite").parquet(aside.toString())
        fs.create(aside.suffix(f"/_token-{token}")).close()
        if not fs.exists(final):
            fs.rename(aside, final)
        # a folder in place is not replaced: the loser's stays aside, or lands inside, hidden
        if not fs.exists(final.suffix(f"/_token-{token}")):
            for left in (aside, final.suffix("/" + aside.getName())):
                if fs.exists(left):
                    fs.delete(left, True)
            raise ManifestConflict(name)

    def _fold(self) -> None:
        """All rows as one snapshot.  A shard keeps its last status and a writer
        its last batch.  What the snapshot before has replaced goes now, so a
        reader that lists folders and reads them has a whole snapshot's time."""
        rows = self.entries()
        status = rows.where("kind = 'status'").groupBy("kind", "logstore", "shard").agg(
            F.max_by("status", "version").alias("status"), F.max("version").alias("version"))
        commits = rows.where("kind = 'commit' AND writer IS NOT NULL").groupBy("kind", "writer").agg(
            F.max("batch").alias("batch"), F.max("version").alias("version"))
        out = rows.where("kind = 'file'").unionByName(_entries(status)).unionByName(_entries(commits))
        try:
            self._place(out, f"s-{self.version:012d}", uuid.uuid4().hex)
        except ManifestConflict:
            return
        fs, folder = _fs(self.spark, f"{self.root}/{FOLDER}")
        older = [n for n in self._folders if n.startswith("s-")]
        limit = _number(older[-1]) if older else 0
        for f in fs.listStatus(folder):
            name = f.getPath().getName()
            if name[:2] in ("v-", "s-") and _number(name) < limit + (name[0] == "v"):
                fs.delete(f.getPath(), True)


def shard_ends(files: DataFrame) -> DataFrame:
    return files.groupBy("logstore", "shard").agg(
        F.min("begin_seq").alias("begin_seq"), F.max("end_seq").alias("end_seq"), F.max("max_time").alias("end_time"))


#: Groups and bytes of a row group: a reader of few positions (a stream's batch,
#: the edge of a time) decodes whole row groups, however large the file.
ROW_GROUP, ROW_GROUP_BYTES = 1000, 16 * 1024 * 1024


def by_position(rows: DataFrame) -> DataFrame:
    """Rows in range partitions on their position.  A hot shard is cut into
    many ranges."""
    return rows.repartitionByRange("logstore", "shard", "seq")


def _write_files(groups: DataFrame, path: str, placed: bool = False) -> None:
    """Files of one narrow range of positions each, written by different tasks.
    ``placed``: the groups lie in range partitions already (:func:`by_position`)."""
    ranged = groups if placed else by_position(groups)
    (ranged.sortWithinPartitions("logstore", "shard", "seq").write.mode("overwrite").partitionBy("logstore", "shard")
     .option("parquet.block.row.count.limit", ROW_GROUP).option("parquet.block.size", ROW_GROUP_BYTES).parquet(path))


def index_files(spark: SparkSession, path: str) -> DataFrame:
    """The ``file`` rows of the Parquet files below ``path`` (only their
    positions and times are read)."""
    groups = spark.read.schema(LOG_GROUP).parquet(path)
    name = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    below = F.regexp_extract(name, r"/(logstore=[^/]*/shard=[^/]*/[^/]+)$", 1)
    return (groups.select("logstore", "shard", below.alias("path"), "seq", "cursor_time").groupBy("logstore", "shard", "path")
            .agg(F.min("seq").alias("begin_seq"), (F.max("seq") + 1).alias("end_seq"),
                 F.min("cursor_time").alias("min_time"), F.max("cursor_time").alias("max_time"))
            .withColumn("kind", F.lit("file")))


def _leaves(fs, path) -> list:
    found, it = [], fs.listFiles(path, True)
    while it.hasNext():
        p = it.next().getPath()
        if p.getName()[0] not in "._":
            found.append(p)
    return found


def _publish(spark: SparkSession, root: str, token: str) -> None:
    """Move a committed append's files into place; may be repeated."""
    fs, staged = _fs(spark, f"{root}/{STAGED}/{token}")
    if not fs.exists(staged):
        return
    made = set()
    for p in _leaves(fs, staged):
        parent = f"{root}/{p.getParent().getParent().getName()}/{p.getParent().getName()}"
        _, target = _fs(spark, f"{parent}/{p.getName()}")
        if parent not in made:
            fs.mkdirs(target.getParent())
            made.add(parent)
        if not fs.rename(p, target) and not fs.exists(target):
            raise OSError(f"could not move {p} to {target}")
    fs.delete(staged, True)


def settle(spark: SparkSession, root: str) -> None:
    """Finish what a lost writer has committed, but not moved into place."""
    fs, staged = _fs(spark, f"{root.rstrip('/')}/{STAGED}")
    if not fs.exists(staged):
        return
    tokens = [f.getPath().getName() for f in fs.listStatus(staged)]
    if tokens:
        entries = Manifest.open(spark, root).entries().where(F.col("token").isin(tokens))
        # files with a token were inserted by SQL: they get their positions as they are moved
        inserted = entries.where("kind = 'file'").select("token").distinct().collect()
        for token in [r["token"] for r in inserted]:
            from .using import place_inserted
            place_inserted(entries.where((F.col("kind") == "file") & (F.col("token") == token)), root)
            _discard(spark, root.rstrip("/"), token)
        done = entries.where("kind = 'commit'").select("token").collect()
        for r in done:
            _publish(spark, root.rstrip("/"), r["token"])


def open_store(spark: SparkSession, root: str) -> Manifest:
    """The manifest of a store; a store written without one is indexed first
    (its positions and times are read once)."""
    settle(spark, root)
    manifest = Manifest.open(spark, root)
    fs, path = _fs(spark, root)
    if manifest.version == 0 and fs.exists(path) and any("=" in f.getPath().getName() for f in fs.listStatus(path)):
        try:
            return manifest.put(index_files(spark, root), uuid.uuid4().hex)
        except ManifestConflict:
            return Manifest.open(spark, root)
    return manifest


def set_status(spark: SparkSession, root: str, shards: DataFrame) -> Manifest:
    """Set the status of shards (``logstore, shard, status``): a closed shard
    is ``readonly``."""
    rows = shards.select(F.lit("status").alias("kind"), "logstore", "shard", "status")
    return _retry(spark, root, lambda m: m.put(rows, uuid.uuid4().hex))


def _retry(spark: SparkSession, root: str, attempt: Callable[[Manifest], Manifest]) -> Manifest:
    for _ in range(ATTEMPTS):
        try:
            return attempt(open_store(spark, root))
        except ManifestConflict:
            continue
    raise ManifestConflict(f"{ATTEMPTS} attempts on {root}")


def append_positioned(groups: DataFrame, root: str, placed: bool = False) -> Manifest:
    """Append groups that have their positions already (``placed``: and lie in
    range partitions on them)."""
    spark, root, token = groups.sparkSession, root.rstrip("/"), uuid.uuid4().hex
    staged = f"{root}/{STAGED}/{token}"
    _write_files(groups, staged, placed)
    rows = index_files(spark, staged)
    done = _retry(spark, root, lambda m: m.put(rows, token))
    _publish(spark, root, token)
    return done


def _behind(groups: DataFrame, ends: DataFrame) -> DataFrame:
    """Groups moved behind the ends of their shards; write times never fall."""
    from ..plans.broadcast import checked_broadcast
    at = checked_broadcast(ends.select("logstore", "shard", F.col("end_seq").alias("_end"), F.col("end_time").alias("_time")))
    seq = F.col("seq") + F.coalesce("_end", F.lit(0))
    moved = (groups.join(at, ["logstore", "shard"], "left")
             .withColumns({"cursor_time": F.greatest("cursor_time", "_time"), "seq": seq, "cursor": cursor_of(seq), "next_cursor": cursor_of(seq + 1)}))
    return moved.select(*[F.col(f.name).cast(f.dataType) for f in LOG_GROUP.fields])


def append_behind(groups: DataFrame, root: str, key: tuple[str, int] | None = None) -> Manifest:
    """Append groups numbered from 0 in each shard behind what the store holds.

    The ends come from the manifest.  Where another writer was faster, the
    staged files (not the input, which may not come the same again) are moved
    behind its positions.  ``key`` = (writer, batch): a batch committed before
    is not written again."""
    spark, root = groups.sparkSession, root.rstrip("/")
    source = token = None
    for _ in range(ATTEMPTS):
        manifest = open_store(spark, root)
        if key and manifest.has_batch(*key):
            break
        ends = manifest.ends().persist()
        source = source if source is not None else groups
        token, before = uuid.uuid4().hex, token
        staged = f"{root}/{STAGED}/{token}"
        _write_files(_behind(source, ends), staged)
        try:
            manifest = manifest.put(index_files(spark, staged), token, *(key or (None, None)))
            _discard(spark, root, before)
            _publish(spark, root, token)
            return manifest
        except ManifestConflict:
            # back to positions from 0 by the ends that these files were numbered behind
            _discard(spark, root, before)
            negative = spark.createDataFrame(
                [(r["logstore"], r["shard"], -r["end_seq"], None) for r in ends.collect()],  # one row per shard
                "logstore string, shard int, end_seq long, end_time timestamp_ntz")
            source = _behind(spark.read.schema(LOG_GROUP).parquet(staged), negative)
        finally:
            ends.unpersist()
    else:
        raise ManifestConflict(f"{ATTEMPTS} attempts on {root}")
    _discard(spark, root, token)
    return manifest


def _discard(spark: SparkSession, root: str, token: str | None) -> None:
    if token:
        fs, staged = _fs(spark, f"{root}/{STAGED}/{token}")
        if fs.exists(staged):
            fs.delete(staged, True)


class FileIndex:
    """Positions and times of a store's shards from its manifest (R5-R9, W6,
    W7): rows of the manifest and at most one file of each shard are read.

    Write times never fall within a shard, so the first file, by position,
    that reaches a time holds the first position written at or after it."""

    def __init__(self, spark: SparkSession, root: str, files: DataFrame | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = open_store(spark, root).files() if files is None else files

    def select(self, logstore=None, pattern=None) -> "FileIndex":
        from .logstore import select_logstores
        return FileIndex(self.spark, self.root, select_logstores(self.files, logstore, pattern))

    def shards(self) -> DataFrame:
        return shard_ends(self.files)

    def _opened(self, paths: list[str]) -> DataFrame:
        """The positions and times of some files; one of each shard."""
        if not paths:
            return self.spark.createDataFrame([], LOG_GROUP)
        reader = self.spark.read.schema(LOG_GROUP).option("basePath", self.root)
        return reader.parquet(*[_escaped(f"{self.root}/{p}") for p in paths])

    def first_seq_at(self, seconds: int, strict_after: bool = False, name: str = "at_seq") -> DataFrame:
        """Per shard, the first position written at or after ``seconds`` (or
        after them)."""
        from ..plans.positions import seconds_ntz
        t = seconds_ntz(seconds)

        def late(column):
            return F.col(column) > t if strict_after else F.col(column) >= t

        found = F.min_by(F.struct("path", "begin_seq", late("min_time").alias("whole")), "begin_seq").alias("f")
        first = self.files.where(late("max_time")).groupBy("logstore", "shard").agg(found).select("logstore", "shard", "f.*")
        cut = [r["path"] for r in first.where("NOT whole").select("path").collect()]
        inside = (self._opened(cut).where(late("cursor_time")).groupBy("logstore", "shard").agg(F.min("seq").alias(name)))
        return first.where("whole").select("logstore", "shard", F.col("begin_seq").alias(name)).unionByName(inside)

    def time_of(self, positions: DataFrame) -> DataFrame:
        """``positions`` (``logstore, shard, next_seq``; one row per group and
        shard) with ``progress_time``, the write time of the position before."""
        from ..plans.broadcast import checked_broadcast
        at = positions.select("logstore", "shard", (F.col("next_seq") - 1).alias("seq")).distinct()
        files = self.files.join(checked_broadcast(at), ["logstore", "shard"]).where("seq >= begin_seq AND seq < end_seq")
        ends = files.where((F.col("seq") == F.col("end_seq") - 1) | (F.col("min_time") == F.col("max_time")))
        cut = files.where((F.col("seq") < F.col("end_seq") - 1) & (F.col("min_time") < F.col("max_time"))).select("path", "seq").collect()
        opened = self._opened(sorted({r["path"] for r in cut}))
        if cut:
            lo, hi = min(r["seq"] for r in cut), max(r["seq"] for r in cut)
            opened = opened.where((F.col("seq") >= lo) & (F.col("seq") <= hi))
        inside = opened.join(checked_broadcast(at), ["logstore", "shard", "seq"]).select("logstore", "shard", "seq", F.col("cursor_time").alias("progress_time"))
        known = ends.select("logstore", "shard", "seq", F.col("max_time").alias("progress_time")).unionByName(inside)
        known = known.select("logstore", "shard", (F.col("seq") + 1).alias("next_seq"), "progress_time")
        return positions.join(known, ["logstore", "shard", "next_seq"], "left")


def _escaped(path: str) -> str:
    """A path as ``spark.read`` takes it literally (it expands patterns)."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)
