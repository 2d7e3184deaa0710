"""Embedding near-dedup by product quantisation.

Equal vectors are one class; its smallest id stands for it.  Coarse centroids
and, for the residuals, one codebook for each subspace are fitted on a bounded
sample (``SAMPLE`` classes, taken by a hash of the id).  Every class is
indexed: it joins the inverted list of its nearest centroid with its residual
code and the length of what the code leaves out.

Every class also asks the ``PROBES`` nearest lists.  There the asymmetric
distance, a sum of table look-ups, plus the left-out length bounds the cosine
from above, so the codes lose no link; what passes is reranked by the exact
cosine in double precision.  A pair is found if either side probes the other's
list.  Lists are cut into blocks of ``BLOCK`` rows, askers are streamed through
a block, and only sums of links and a spanning forest leave a task, never the
pairs.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, components, finite_vectors, small_batches, sorted_runs, written

COSINE = 0.9
SAMPLE, LISTS, CODES, SUBSPACE = 32_768, 2048, 256, 4
PROBES, BLOCK, BATCH = 6, 4096, 1024


def kmeans(x: np.ndarray, k: int, rounds: int, seed: int = 17) -> np.ndarray:
    """Lloyd's rounds from ``k`` distinct rows of ``x``; an empty cluster
    keeps its centre."""
    centres = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = nearest(x, centres, 1)[:, 0]
        size = np.bincount(own, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        centres[size > 0] = total[size > 0] / size[size > 0, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the ``k`` nearest centres of each row, nearest first."""
    out = []
    half = (centres * centres).sum(axis=1) / 2
    for a in range(0, len(x), 4096):
        far = half - x[a : a + 4096] @ centres.T
        some = np.argpartition(far, min(k, len(centres)) - 1, axis=1)[:, :k]
        out.append(np.take_along_axis(some, np.take_along_axis(far, some, 1).argsort(axis=1, kind="stable"), 1))
    return np.concatenate(out) if out else np.zeros((0, k), dtype=np.int64)


@dataclass
class Quantiser:
    centres: np.ndarray
    books: np.ndarray  # (subspaces, codes, width)

    @classmethod
    def fit(cls, x: np.ndarray, lists: int) -> Quantiser:
        width = next(w for w in (SUBSPACE, 3, 2, 1) if x.shape[1] % w == 0)
        centres = kmeans(x, lists, 8)
        rest = (x - centres[nearest(x, centres, 1)[:, 0]]).reshape(len(x), -1, width)
        codes = min(CODES, len(x))
        return cls(centres, np.stack([kmeans(rest[:, m], codes, 5) for m in range(rest.shape[1])]))

    def encode(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Residual codes, and the length that they leave out."""
        rest = (x - self.centres[own]).reshape(len(x), len(self.books), -1)
        codes = np.stack([nearest(rest[:, m], b, 1)[:, 0] for m, b in enumerate(self.books)], axis=1)
        left = rest - np.stack([b[codes[:, m]] for m, b in enumerate(self.books)], axis=1)
        return codes.astype(np.uint8), np.sqrt((left * left).sum(axis=(1, 2)))

    def products(self, q: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """Inner products of ``q`` with the coded vectors of list ``at``, by
        one table for each subspace."""
        parts = q.reshape(len(q), len(self.books), -1)
        out = np.repeat((q @ self.centres[at])[:, None], len(codes), axis=1)
        for m, b in enumerate(self.books):
            out += (parts[:, m] @ b.T)[:, codes[:, m]]
        return out


def _unit(vectors) -> tuple[np.ndarray, np.ndarray]:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    return x, x / np.linalg.norm(x / np.abs(x).max(axis=1, keepdims=True), axis=1, keepdims=True) / np.abs(x).max(axis=1, keepdims=True)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its group) of the groups that the pairs join."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        np.minimum.at(new, x, label[y])
        np.minimum.at(new, y, label[x])
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _coded(model: Quantiser):
    def run(batches):
        for pdf in batches:
            if len(pdf):
                _, u = _unit(pdf["v"])
                probes = nearest(u, model.centres, min(PROBES, len(model.centres)))
                codes, left = model.encode(u, probes[:, 0])
                yield pdf.assign(list=probes[:, 0], codes=[c.tobytes() for c in codes], left=left, probes=list(probes))
    return run


def _search(model: Quantiser, cosine: float):
    def run(batches):
        now, block = None, None
        for (lst, part, kind), pdf in sorted_runs(batches, ["list", "part", "kind"]):
            if (lst, part) != now:
                now, block = (lst, part), []
            ids, n, home = pdf["id"].to_numpy(), pdf["n"].to_numpy(), pdf["home"].to_numpy()
            x, u = _unit(pdf["v"])
            probes = np.stack(pdf["probes"].to_numpy())
            if kind == 0:
                codes = np.stack([np.frombuffer(c, dtype=np.uint8) for c in pdf["codes"]])
                block.append((ids, n, u, codes, pdf["left"].to_numpy(), probes))
                continue
            if not block:
                continue
            if len(block) > 1:
                block = [tuple(np.concatenate(c) for c in zip(*block))]
            ids2, n2, u2, codes2, left2, probes2 = block[0]
            near = model.products(u, int(lst), codes2) + left2 >= cosine - 1e-9
            q, y = np.nonzero(near & (ids[:, None] != ids2))
            keep = np.zeros(len(q), dtype=bool)
            for a in range(0, len(q), 100_000):
                keep[a : a + 100_000] = (u[q[a : a + 100_000]] * u2[y[a : a + 100_000]]).sum(axis=1) >= cosine
            q, y = q[keep], y[keep]
            if not len(q):
                continue
            # the other side counts here too unless it asks our list itself
            alone = ~(probes2[y] == home[q][:, None]).any(axis=1)
            who = np.concatenate([ids[q], ids2[y[alone]]])
            gain = np.concatenate([n2[y], n[q[alone]]])
            whom, at = np.unique(who, return_inverse=True)
            node, least = _forest(ids[q], ids2[y])
            yield pd.DataFrame({"id": np.r_[whom, node], "links": np.r_[np.bincount(at, gain).astype(np.int64), np.zeros(len(node), dtype=np.int64)],
                                "other": np.r_[whom, least]})
    return run


def linked_classes(classes: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(id, links, other): sums of links of the classes (id, n, v), and a
    forest of edges (id, other) with the same components as the links."""
    spark = classes.sparkSession
    rows = classes.count()
    none = spark.range(0).select("id", F.col("id").alias("links"), F.col("id").alias("other"))
    if rows < 2:
        return none
    out = none
    for dim in sorted(r[0] for r in classes.select(F.size("v")).distinct().collect()):
        own = classes.filter(F.size("v") == dim)
        sample = bounded_sample(own, "id", SAMPLE).select("v").toPandas()
        model = Quantiser.fit(_unit(sample["v"])[1], max(1, min(LISTS, len(sample) // 16, math.isqrt(rows))))
        coded = written(own.mapInPandas(_coded(model), "id long, n long, v array<double>, list int, codes binary, left double, probes array<int>"), "coded")
        parts = coded.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
        cols = ["list", "part", "kind", "id", "n", "v", "codes", "left", "probes", "home"]
        base = coded.withColumn("home", F.col("list"))
        members = (base.join(F.broadcast(parts), "list").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
                   .withColumn("kind", F.lit(0)).select(cols))
        askers = (base.withColumn("list", F.explode("probes")).join(F.broadcast(parts), "list")
                  .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("kind", F.lit(1))
                  .withColumn("codes", F.lit(None).cast("binary")).select(cols))
        out = out.unionByName(members.unionByName(askers).repartition("list", "part").sortWithinPartitions("list", "part", "kind")
                              .mapInPandas(_search(model, cosine), "id long, links long, other long"))
    return out


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    Vectors that are null, empty, all zero or hold null or non-finite
    components link with nothing, and so do vectors of different length.
    Equal vectors always link.  Rows that share an id are one vector (the
    smallest counts), each with a row in the result; a null id takes part in
    no link.  An empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    small_batches(spark, BATCH)
    base = written(finite_vectors(vectors, id_col, vec_col).filter(F.exists("v", lambda x: x != 0))
                   .groupBy("id").agg(F.min("v").alias("v")), "vectors")
    classes = written(base.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("n")).select("id", "n", "v"), "classes")
    found = written(linked_classes(classes, cosine), "links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    comps = components(found.filter("id <> other").select(F.col("id").alias("a"), F.col("other").alias("b")))
    of_class = (classes.join(links, "id", "left").join(comps.withColumnRenamed("node", "id"), "id", "left")
                .select("v", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                        F.coalesce("component", "id").alias("component_id")))
    of_id = base.join(of_class, "v").select(F.col("id").alias("__id"), "n_links", "component_id")
    own = F.col(id_col).cast("long")
    return (vectors.select(own.alias("__id")).join(of_id, "__id", "left")
            .select(F.col("__id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.coalesce("component_id", "__id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))
