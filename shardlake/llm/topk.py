"""Exact top-k search by inner product over KD-trees, one tree per shard.

The rows are dealt by a hash of their id into shards of about
``SHARD_ROWS`` rows.  Each shard builds a KD-tree (median splits of the widest
dimension, tight bounding boxes).  A query walks a tree best-first: the open
node with the highest box-to-query bound comes next, and the walk ends when no
open box can beat the query's kth score.  A query first searches the shard it
lives in; the kth score found there travels with it to every other shard.

Queries are streamed through each shard in Arrow batches, so a task holds one
shard and one batch, whatever the number of rows or queries.

Scores are exact: a query and a tree multiply as doubles where the largest
components of both keep every sum below 2**53, as longs below 2**63, and as
Python integers beyond.
"""
from __future__ import annotations

import copy
import math
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import finite_vectors, small_batches, sorted_runs, written

SHARD_ROWS = 2048
LEAF_ROWS = 64
SCALE = 256
#: Scores stay within a long; one beyond it counts as the nearest.
MOST = 2 ** 63 - 1


def _number_type(dim: int, a: float, b: float) -> type:
    """In which numbers sums of ``dim`` products of up to ``a`` times ``b`` are exact."""
    if math.isinf(a) or math.isinf(b):
        return object
    top = int(dim) * int(a) * int(b)
    return np.float64 if top < 2 ** 53 else np.int64 if top < 2 ** 63 and max(a, b) < 2 ** 62 else object


def _as(x: np.ndarray, kind: type) -> np.ndarray:
    return np.frompyfunc(int, 1, 1)(x) if kind is object else x.astype(kind, copy=False)


def _longs(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object:
        scores = np.minimum(np.maximum(scores, -MOST), MOST)
    return scores.astype(np.int64)


class KDTree:
    """Rows ``x`` (n, d) of whole numbers with ``ids``; at most ``keep`` smallest ids
    of equal rows are kept, more can never be among the best."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, keep: int):
        order = np.lexsort((ids, *x.T[::-1]))
        x, ids = x[order], ids[order]
        new = np.r_[True, (x[1:] != x[:-1]).any(axis=1)]
        start = np.flatnonzero(new)
        nth = np.arange(len(x)) - np.repeat(start, np.diff(np.r_[start, len(x)]))
        x, ids = x[nth < keep], ids[nth < keep]
        self.lo, self.hi, self.least_id, self.kids, self.rows = [], [], [], [], []
        self.x, self.ids = x, ids
        self._grow(np.arange(len(x)))
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)
        self.least_id = np.array(self.least_id)
        self.top = _top(x)
        self._kinds: dict[type, KDTree] = {}

    def of(self, kind: type) -> "KDTree":
        """The same tree with its numbers of another type."""
        if kind not in self._kinds:
            tree = copy.copy(self)
            tree.x, tree.lo, tree.hi = (_as(x, kind) for x in (self.x, self.lo, self.hi))
            self._kinds[kind] = tree
        return self._kinds[kind]

    def _grow(self, rows: np.ndarray) -> int:
        me, x = len(self.lo), self.x[rows]
        lo, hi = x.min(axis=0), x.max(axis=0)
        self.lo.append(lo)
        self.hi.append(hi)
        self.least_id.append(self.ids[rows].min())
        self.kids.append(None)
        self.rows.append(rows)
        wide = int(np.argmax(hi - lo))
        if len(rows) > LEAF_ROWS and hi[wide] > lo[wide]:
            half = len(rows) // 2
            cut = np.argpartition(x[:, wide], half)
            self.rows[me] = None
            self.kids[me] = (self._grow(rows[cut[:half]]), self._grow(rows[cut[half:]]))
        return me

    def bound(self, q: np.ndarray, node: int) -> np.ndarray:
        """Highest inner product that a point of the node's box can have."""
        return _longs(np.maximum(q, 0) @ self.hi[node] + np.minimum(q, 0) @ self.lo[node])

    def search(self, q: np.ndarray, qid: np.ndarray, score: np.ndarray, who: np.ndarray) -> None:
        """Best-first for a batch of queries at once; ``score`` and ``who``
        (queries, k), best first, are improved in place.  The kth entry on
        entry is the bound propagated from other shards."""
        nothing = np.iinfo(np.int64).min
        front = np.full((len(q), len(self.kids)), nothing, dtype=np.int64)
        front[:, 0] = self.bound(q, 0)
        while True:
            node = front.argmax(axis=1)
            best = front[np.arange(len(q)), node]
            kth, kth_id = score[:, -1], who[:, -1]
            live = (best > nothing) & ((best > kth) | (best == kth))
            if not live.any():
                return
            front[np.arange(len(q)), node] = nothing
            # an equal bound helps only where the box may hold a smaller id
            live &= (best > kth) | (self.least_id[node] < kth_id)
            for n in np.unique(node[live]):
                at = np.flatnonzero(live & (node == n))
                if self.kids[n]:
                    for kid in self.kids[n]:
                        front[at, kid] = self.bound(q[at], kid)
                    continue
                rows = self.rows[n]
                got = _longs(q[at] @ self.x[rows].T)
                ids = np.broadcast_to(self.ids[rows], got.shape)
                own = ids == qid[at, None]
                s = np.concatenate([score[at], np.where(own, nothing, got)], axis=1)
                i = np.concatenate([who[at], ids], axis=1)
                first = np.lexsort((i, -np.maximum(s, nothing + 1)), axis=1)[:, : score.shape[1]]
                score[at], who[at] = np.take_along_axis(s, first, 1), np.take_along_axis(i, first, 1)


def scaled(vectors) -> np.ndarray:
    """floor(256 x) of every component: doubles, which are exact here, or
    Python integers where 256 x is beyond a double."""
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    with np.errstate(over="ignore"):
        m = np.floor(SCALE * x)
    return m if np.isfinite(m).all() else np.frompyfunc(lambda c: math.floor(SCALE * Fraction(c)), 1, 1)(x)


def _top(x: np.ndarray) -> float:
    """The largest component by size; infinite for one beyond a double."""
    return math.inf if x.dtype == object else float(np.abs(x).max(initial=0))


def _walk(k: int):
    nothing = np.iinfo(np.int64).min

    def run(batches):
        """Rows sorted by (dim, shard, kind): a shard's rows (kind 0) come
        first, then the queries (kind 1) sent to it."""
        key, rows, tree = None, [], None
        for (dim, shard, kind), pdf in sorted_runs(batches, ["dim", "shard", "kind"]):
            if (dim, shard) != key:
                key, rows, tree = (dim, shard), [], None
            if kind == 0:
                rows.append((scaled(pdf["v"]), pdf["id"].to_numpy()))
                continue
            if not rows and tree is None:
                continue
            if tree is None:
                tree = KDTree(np.concatenate([x for x, _ in rows]), np.concatenate([i for _, i in rows]), k + 1)
                rows = []
            q, qid = scaled(pdf["v"]), pdf["id"].to_numpy()
            score = np.full((len(q), k), nothing, dtype=np.int64)
            who = np.full((len(q), k), np.iinfo(np.int64).max, dtype=np.int64)
            score[:, -1], who[:, -1] = pdf["kth"].to_numpy(), pdf["kth_id"].to_numpy()
            handed = who[:, -1].copy()
            kinds = [_number_type(dim, tree.top, _top(row)) for row in q]
            for kind in dict.fromkeys(kinds):
                at = np.flatnonzero([x is kind for x in kinds])
                s, w = score[at], who[at]
                tree.of(kind).search(_as(q[at], kind), qid[at], s, w)
                score[at], who[at] = s, w
            # the handed-in bound is a row of another shard, not a find of this one
            found = (score > nothing) & (who != handed[:, None])
            at, col = found.nonzero()
            yield pd.DataFrame({"query_id": qid[at], "vec_id": who[at, col], "score": score[at, col]})

    return run


def top_k(vectors: DataFrame, every: int, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of highest integer
    inner product, ties to the smaller id, for each row whose id is divisible
    by ``every``; the query's own id is no candidate.

    Null ids, null or empty vectors and vectors with null or non-finite
    components take no part.  A score beyond a long counts as the nearest
    long.  Of rows that share an id the smallest vector counts.  Vectors of different length
    are never compared.  Fewer than ``k`` candidates give fewer rows; an empty
    table gives none.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    usable = (finite_vectors(vectors, id_col, vec_col)
              .groupBy("id").agg(F.min("v").alias("v")))
    base = written(usable.withColumn("dim", F.size("v")), "vectors")
    shards = max(1, math.ceil(base.count() / shard_rows))
    nobody = F.lit(np.iinfo(np.int64).max).cast("long")
    rows = (base.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
            .withColumn("kind", F.lit(0)).withColumn("kth", F.lit(np.iinfo(np.int64).min).cast("long"))
            .withColumn("kth_id", nobody))
    queries = rows.filter(F.pmod("id", F.lit(every)) == 0).withColumn("kind", F.lit(1))
    out = "query_id long, vec_id long, score long"

    def searched(asked: DataFrame) -> DataFrame:
        return (rows.unionByName(asked).repartition("dim", "shard")
                .sortWithinPartitions("dim", "shard", "kind").mapInPandas(_walk(k), out))

    home = written(searched(queries), "home")
    if shards == 1:
        found = home
    else:
        worst = (home.groupBy("query_id").agg(F.count("*").alias("n"), F.get(F.sort_array(F.collect_list(
            F.struct((-F.col("score")).alias("s"), "vec_id"))), F.lit(k - 1)).alias("last"))
                 .filter(F.col("n") >= k)
                 .select(F.col("query_id").alias("id"), (-F.col("last.s")).alias("got"),
                         F.col("last.vec_id").alias("got_id")))
        away = (queries.join(worst, "id", "left")
                .withColumn("kth", F.coalesce("got", "kth")).withColumn("kth_id", F.coalesce("got_id", "kth_id"))
                .withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).filter("`to` <> shard")
                .withColumn("shard", F.col("to")).select(rows.columns))
        found = home.unionByName(searched(away))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
