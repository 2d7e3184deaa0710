"""N-gram Jaccard join: which documents share enough word shingles.

Equal sets are one class.  Class representatives meet in tiles: a tile is a
band of set sizes and the content of one hashed part of the shingles
(``shingles.Signer``), chosen so that two sets that must link share a tile for
certain.  In a tile the parity bitmaps of two sets bound their overlap from
above; only pairs that pass the bound are checked on the sorted shingle arrays.

No tile emits all its pairs.  First each member meets the tile's smallest
member only, and the links found join sets into components.  Then tiles that
still hold several components compare members of different components by
their bitmaps, and emit the pairs that pass the bound; a tile where these are
many for its members emits a forest of them only, and is asked again, with the
new components, until it has no pair left.  A checked pair that is no link is
remembered and not asked again.  So every link counts, but links inside a
component are not all listed.
Large tiles are cut into blocks, each pair of blocks a task of its own.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles as S
from .common import components, small_batches, written

WIDTH, PERCENT = 3, 90
#: Members of a block of a large tile.
BLOCK = 1024
#: Pairs that a tile emits for each member before it keeps to a forest.
PAIRS_PER_MEMBER = 8
#: Ids up to this number are broadcast (8 MB), more are shuffled.
BROADCAST_IDS = 1_000_000


def set_table(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, n, d1, d2, keys, bits): size, digest, tile keys and bitmap of
    the shingle set of every row of ``docs``."""
    def run(batches):
        signer = S.Signer(percent)
        for b in batches:
            n, d1, d2, keys, bits = [], [], [], [], []
            for t in b.column("text").to_pylist():
                sh = S.shingles(t or b"", width)
                digest = xxhash.xxh3_128_intdigest(sh.tobytes())
                own = signer.keys(sh)
                n.append(len(sh))
                d1.append((digest >> 64) - (1 << 63))
                d2.append((digest & S.MASK) - (1 << 63))
                keys.append(own)
                bits.append(S.bitmap(sh) if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.binary())], names=["doc_id", "n", "d1", "d2", "keys", "bits"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
            .mapInArrow(run, "doc_id long, n long, d1 long, d2 long, keys array<long>, bits binary"))


def _checked(pairs: DataFrame, reps: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b, linked) of each pair, by the exact overlap of its shingle sets."""
    ids = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct().join(
        reps.select("rep", "doc", "d1", "d2"), "rep")
    wanted = written(ids, "asked")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)

    def run(batches):
        for b in batches:
            rows = [(i, S.shingles(t or b"", width), x, y) for i, t, x, y in zip(
                *(b.column(c).to_pylist() for c in ("rep", "text", "d1", "d2")))]
            # an id can stand on several rows; only the set that was asked for counts
            rows = [(i, sh) for i, sh, x, y in rows
                    if xxhash.xxh3_128_intdigest(sh.tobytes()) == ((x + (1 << 63)) << 64) + y + (1 << 63)]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()),
                                              pa.array([sh.tobytes() for _, sh in rows], pa.binary())], names=["rep", "sh"])

    sets = (docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("binary").alias("text")).join(wanted, "doc")
            .mapInArrow(run, "rep long, sh binary").dropDuplicates(["rep"]))
    sets = written(sets, "sets")

    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            both = np.concatenate([x, y])
            both.sort(kind="stable")
            same = int((both[1:] == both[:-1]).sum())
            out.append(100 * same >= percent * (len(both) - same))
        return pd.Series(out)

    return written(pairs.join(sets.select(F.col("rep").alias("a"), F.col("sh").alias("sa")), "a")
                   .join(sets.select(F.col("rep").alias("b"), F.col("sh").alias("sb")), "b")
                   .select("a", "b", linked("sa", "sb").alias("linked")), "checked")


def _passing(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs whose bitmaps leave room for enough overlap."""
    @F.pandas_udf("boolean")
    def room(x: pd.Series, n: pd.Series, y: pd.Series, r: pd.Series) -> pd.Series:
        most = [S.overlap_bound(*row) for row in zip(x, n, y, r)]
        return pd.Series([100 * m >= percent * (s + t - m) for m, s, t in zip(most, n, r)])

    sides = [reps.select(F.col("rep").alias(c), F.col("n").alias(f"n{c}"), F.col("bits").alias(f"x{c}")) for c in "ab"]
    return (pairs.join(sides[0], "a").join(sides[1], "b")
            .filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
            .filter(room("xa", "na", "xb", "nb")).select("a", "b"))


def _tile_pairs(percent: int, per_member: int):
    """Pairs to check (a, b, more) in each run of rows with equal (key, ba,
    bb): all pairs of different components that pass the bound, while they are
    few for the members; else (``more``) a forest of them."""
    def tile(rows, out):
        parent: dict = {}

        def find(c):
            while (p := parent.get(c, c)) != c:
                parent[c] = c = parent.get(p, p)
            return c

        rows.sort(key=lambda r: r[:2])
        second = sum(r[0] for r in rows)
        passing, forest, limit = [], [], per_member * len(rows)
        for i, (late, rep, comp, n, bits, size, no) in enumerate(rows):
            # of two blocks only pairs across them, of one block all
            others = rows[:i] if not second else rows[: len(rows) - second] if late else ()
            for _, rep2, comp2, n2, bits2, size2, no2 in others:
                if comp == comp2 or 100 * n < percent * n2 or 100 * n2 < percent * n or rep2 in no or rep in no2:
                    continue
                few = len(passing) <= limit
                if not few and find(comp) == find(comp2):
                    continue
                most = (n + n2 - S.differing_bits(bits, size, bits2, size2)) // 2
                if 100 * most >= percent * (n + n2 - most):
                    pair = (min(rep, rep2), max(rep, rep2))
                    if few:
                        passing.append(pair)
                    if (x := find(comp)) != (y := find(comp2)):
                        forest.append(pair)
                        parent[max(x, y)] = min(x, y)
        more = len(passing) > limit
        out += [(*pair, more) for pair in (forest if more else passing)]

    def run(batches):
        now, rows = None, []
        for b in batches:
            out: list[tuple] = []
            for key, ba, bb, block, rep, comp, n, bits, no in zip(*(b.column(c).to_pylist() for c in (
                    "key", "ba", "bb", "block", "rep", "comp", "n", "bits", "no"))):
                if (key, ba, bb) != now:
                    tile(rows, out)
                    now, rows = (key, ba, bb), []
                rows.append((int(block != ba), rep, comp, n, int.from_bytes(bits, "little"), 8 * len(bits), frozenset(no or ())))
            yield _batch(out)
        out = []
        tile(rows, out)
        yield _batch(out)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["a", "b", "more"])


def _open_tiles(hits: DataFrame, comps: DataFrame, reps: DataFrame, wrong: DataFrame) -> DataFrame:
    """Rows of the tiles that still hold several components, dealt into
    blocks.  A tile of two was settled when its members met."""
    rows = (hits.select("key", "rep").join(comps.withColumnRenamed("node", "rep"), "rep", "left")
            .select("key", "rep", F.coalesce("component", "rep").alias("comp")))
    wide = (rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("members"))
            .filter("lo < hi and members > 2").select("key", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")))
    rows = rows.join(wide, "key").join(reps.select("rep", "n", "bits"), "rep")
    rows = rows.join(wrong.groupBy(F.col("a").alias("rep")).agg(F.collect_list("b").alias("no")), "rep", "left")
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (rows.withColumn("block", block).withColumn("other", other)
            .withColumn("ba", F.least("block", "other")).withColumn("bb", F.greatest("block", "other"))
            .repartition("key", "ba", "bb").sortWithinPartitions("key", "ba", "bb")
            .select("key", "ba", "bb", "block", "rep", "comp", "n", "bits", "no"))


def _same_id(sets: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Edges (a, b) between the classes that share a doc_id; None if no id
    stands on rows of two classes."""
    found = sets.filter("n > 0 AND doc_id IS NOT NULL").select("doc_id", "d1", "d2")
    several = (found.groupBy("doc_id").agg(F.min(F.struct("d1", "d2")).alias("lo"), F.max(F.struct("d1", "d2")).alias("hi"))
               .filter("lo <> hi").select("doc_id"))
    several = written(several, "several")
    if not several.head(1):
        return None
    rows = found.join(several, "doc_id").distinct().join(classes.select("d1", "d2", "rep"), ["d1", "d2"])
    least = rows.groupBy("doc_id").agg(F.min("rep").alias("a"))
    return written(rows.join(least, "doc_id").filter("rep <> a").select("a", F.col("rep").alias("b")).distinct(), "same-id")


def link(docs: DataFrame, sets: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, component) of the classes that have a link: numbers of classes
    (``rep``), each with the least id ``doc`` that has its set."""
    reps = written(sets.filter(F.size("keys") > 0).join(classes.select("d1", "d2", "rep", F.col("doc").alias("doc_id")), ["d1", "d2", "doc_id"])
                   .withColumnRenamed("doc_id", "doc").dropDuplicates(["rep"]), "reps")
    given = _same_id(sets, classes)
    rows = reps.select("rep", F.explode("keys").alias("key"))
    tiles = rows.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo < hi").select("key", "lo")
    hits = written(rows.join(tiles, "key").select("key", "rep", "lo"), "tiles")
    stars = hits.filter("rep <> lo").select(F.col("lo").alias("a"), F.col("rep").alias("b")).distinct()
    checked = _checked(written(_passing(stars, reps, percent), "pairs"), reps, docs, width, percent)
    # enough to tell tiles that are settled: the least member that each one links with
    comps = checked.filter("linked").groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
    edges, wrong = given, None
    while True:
        good, bad = checked.filter("linked").select("a", "b"), checked.filter("not linked").select("a", "b")
        bad = bad.unionByName(bad.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = good if edges is None else edges.unionByName(good)
        wrong = bad if wrong is None else wrong.unionByName(bad)
        pairs = written(_open_tiles(hits, comps, reps, wrong).mapInArrow(_tile_pairs(percent, PAIRS_PER_MEMBER), "a long, b long, more boolean")
                        .groupBy("a", "b").agg(F.bool_or("more").alias("more")), "pairs")
        checked = _checked(pairs.select("a", "b"), reps, docs, width, percent)
        if not pairs.filter("more").head(1):
            return components(edges.unionByName(checked.filter("linked").select("a", "b")))
        comps = written(components(edges.unionByName(checked.filter("linked").select("a", "b"))), "components")


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    Words are runs of bytes other than x20 and x09-x0D, A-Z lower-cased; a
    set is the distinct ``width``-word shingles of a whole text, or its whole
    word sequence if it has fewer.  Two documents link when 100 * shared >=
    ``percent`` * united.  ``component_id`` is the smallest doc_id reachable
    by links, the document's own where there is none; null, empty and blank
    texts have no shingles and link with nothing.  Rows that share a doc_id
    are one document with the links of all its texts, each with its own row; a null
    id belongs to its set's component (null if no other row has the set).  An
    empty table gives no rows; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    sets = written(set_table(docs, width, percent), "signatures")
    # a class has a number of its own: one id can stand on rows of several
    classes = written(sets.filter("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("doc"))
                      .withColumn("rep", F.monotonically_increasing_id()), "classes")
    comps = written(link(docs, sets, classes, width, percent), "linked")
    least = (comps.join(classes.select(F.col("rep").alias("node"), "doc"), "node")
             .groupBy("component").agg(F.min("doc").alias("least")))
    named = comps.join(least, "component").select(F.col("node").alias("rep"), "least")
    classes = (classes.join(named, "rep", "left").select("d1", "d2", F.coalesce("least", "doc").alias("component")))
    return (sets.select("doc_id", "n", "d1", "d2").join(classes, ["d1", "d2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id")))
