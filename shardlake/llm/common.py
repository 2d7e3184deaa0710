"""Helpers shared by the operators: tables, the shared folder, labels' folds
and connected components as Spark jobs."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_SHARED: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.  Where it is unset, local
    mode (tests) takes a temporary folder; a cluster must name one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _LOCAL_SHARED:
        _LOCAL_SHARED.append(tempfile.mkdtemp(prefix="shardlake-llm-"))
    return _LOCAL_SHARED[0]


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the stored table: it
    cuts the lineage, and lost executors re-read it instead of recomputing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def dropped(df: DataFrame) -> None:
    """Delete a table made by ``written`` that nothing refers to any more."""
    path = getattr(df, "stored_at", None)
    if path:
        delete(df.sparkSession, path)


def free_name(taken: list[str], base: str) -> str:
    """``base``, or ``base_1`` and so on, whichever no column is called (Spark
    takes names alike that differ in case only)."""
    low = {c.lower() for c in taken}
    name, k = base, 0
    while name.lower() in low:
        k += 1
        name = f"{base}_{k}"
    return name


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """All of ``df`` if it has at most ``rows`` rows, else about 95 % of that
    many, by a hash of ``key``, and never more (also if one key repeats)."""
    n = df.count()
    if n <= rows:
        return df
    part = F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(0.95 * (1 << 30) * rows / n)
    return df.filter(part).limit(rows)


def held_out(doc_id) -> F.Column:
    """Rows whose labels are never learnt from: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the least id around the node."""
    both = _both_ways(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b")


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least id reachable from every node that has an
    edge ``(a, b)``.  Large-star and small-star steps in turn, each step a
    pre-aggregated minimum and a join, until the edges are stars; the edges
    of each round are written to the shared folder.  Only a count and a
    checksum reach the driver."""
    now = written(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    state = _state(now)
    while state[0]:
        new = written(_small_star(_large_star(now)).distinct(), "edges")
        after = _state(new)
        dropped(now)
        now = new
        if after == state:
            break
        state = after
    return (now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))


#: Rows of an Arrow batch.  A batch of whole documents is held in a Python
#: worker, so it is kept small whatever the length of the texts.
ROWS_PER_BATCH = 256


def workers_find_library(spark: SparkSession) -> None:
    """Python workers import this library also when they start elsewhere."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def small_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def sorted_runs(batches, key: list[str]):
    """(key values, pandas frame) for every run of equal keys inside each
    batch of a partition sorted by ``key``; one key may give several runs."""
    for pdf in batches:
        if not len(pdf):
            continue
        new = (pdf[key] != pdf[key].shift()).any(axis=1).to_numpy()
        starts = [*new.nonzero()[0], len(pdf)]
        for a, b in zip(starts[:-1], starts[1:]):
            run = pdf.iloc[a:b]
            yield tuple(run.iloc[0][key]), run


def finite_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) as doubles of the rows whose vector is usable: not null, not
    empty, and without null or non-finite components."""
    v = F.col(vec_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (df.filter(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~bad)
            .select(F.col(id_col).cast("long").alias("id"), v.alias("v")))
