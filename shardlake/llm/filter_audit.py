"""How filters interact: what each one removes after every set of others.

Each filter has a table of the ids that fail it (a row number, the part, and
whether the labels call the document good or toxic), bucketed by row number.
For a filter f and a set S of filters before it, left-anti joins of f's table
with the tables of S leave what f removes at that place, and left-semi joins
count what S has removed already (redundant).  An order's step needs the *set*
before it only, so 120 orders of five filters come from 80 counts a part;
survivors are the part's documents less the removals so far.  Sets share their
joins: a letter's table is joined once with all that the sets of the letters
before it have left.

The buckets of all tables agree, so these joins move no row.  Only documents
that fail something are in them, at most 2^(filters - 1) narrow rows of each.
Counts are pre-aggregated in the tasks.

Copies: the smallest id of each text comes from one aggregate over digests.
Texts that hold more than a thousandth of all rows (a thousand of them at
most) are joined by broadcast, the others by their digest.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import delete, dropped, shared_dir, written

WORD_GAP = r"[\x20\x09-\x0D]+"
#: Failing rows in a bucket of an id table, and least number of buckets.
BUCKET_ROWS, LEAST_BUCKETS = 1_000_000, 8
#: Orders of more filters than this must be listed.
ALL_ORDERS = 6


def word_counts(text: Column) -> Column:
    """(n, distinct) of the words of a text, cut once."""
    words = F.filter(F.split(text, WORD_GAP), lambda w: w != "")
    return F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct")))[0]


def quality_filters() -> dict[str, Callable[[Column, Column], Column]]:
    """Failure conditions over a text and its word counts."""
    return {
        "A": lambda text, words: words["n"] < 200,
        "B": lambda text, words: 100 * words["distinct"] < 50 * words["n"],
        "C": lambda text, words: 100 * (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))) > 2 * F.length(text),
        "D": lambda text, words: text.rlike("[#$%&*|]"),
    }


COPIES = "E"


def _judged(docs: DataFrame, labels: DataFrame, filters: dict, part_col: str, id_col: str, text_col: str) -> DataFrame:
    """One narrow row for each document: row number, id, part, digest of the
    text, a flag for each failed filter, and the labels."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    columns = [F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), part.alias("part"),
               F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"), word_counts(text).alias("words")]
    rows = docs.select(*columns)
    flags = [F.coalesce(f(F.col("text"), F.col("words")), F.lit(False)).alias(f"fails_{k}") for k, f in filters.items()]
    judged = written(rows.select("rid", "id", "part", "digest", *flags), "audit-judged")
    found = (labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id"))
             .agg(F.max(F.col("quality").eqNullSafe(1)).alias("good"),
                  F.max(F.col("toxic").eqNullSafe(1)).alias("toxic"))
             .filter("good OR toxic"))
    # null ids have no labels; in an outer join they would all meet in one task
    none = judged.filter("id IS NULL").withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    flagged = (judged.filter("id IS NOT NULL").join(found, "id", "left")
               .withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")}))
    out = written(flagged.unionByName(none), "audit-base")
    dropped(judged)
    return out


def _copies(base: DataFrame, rows: int) -> DataFrame:
    """Rows whose text a smaller id has."""
    groups = written(base.filter("id IS NOT NULL").groupBy("digest")
                     .agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n"))
                     .filter("last > first").select("digest", "first", "n"), "audit-copies")
    hot = F.broadcast(groups.filter(F.col("n") > rows // 1000).select("digest", "first"))  # under 1,000 by their size
    rest = base.join(hot, "digest", "left_anti").join(groups.filter(F.col("n") <= rows // 1000).select("digest", "first"), "digest")
    return base.join(hot, "digest").unionByName(rest).filter("id > first")


class _BucketTables:
    """Tables of failing ids in buckets of the row number, all alike, so that
    joins between them move no row."""

    def __init__(self, spark, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.run = f"llm_audit_{uuid.uuid4().hex}"
        self.paths: dict[str, str] = {}

    def store(self, rows: DataFrame, apart: bool = False) -> DataFrame:
        """``rows`` as a table; those of joined tables lie in their buckets
        already.  ``apart`` keeps each filter's rows in files of their own."""
        name = f"{self.run}_{len(self.paths)}"
        self.paths[name] = f"{shared_dir(self.spark)}/{name}"
        writer = rows.write.bucketBy(self.buckets, "rid").sortBy("rid").option("path", self.paths[name])
        (writer.partitionBy("filter") if apart else writer).saveAsTable(name)
        return self.spark.table(name)

    def drop(self) -> None:
        for name, path in self.paths.items():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            delete(self.spark, path)


def _counts(tables: _BucketTables, failing: DataFrame, letters: str, sets: dict[str, list[str]]) -> DataFrame:
    """(filter, prefix, part, removed, good_lost, toxic_lost, hit): for each
    filter and set what the filter removes after the set, and how many of the
    rows left by the set without its last letter that last letter fails too.

    Letters come in order; each extends all sets of the letters before it, so
    one anti-join and one semi-join with its id table serve all filters."""
    spark = failing.sparkSession
    wanted = F.broadcast(spark.createDataFrame([(k, s) for k, v in sets.items() for s in v], "filter string, prefix string"))
    left = [tables.store(failing.select("filter", F.lit("").alias("prefix"), "rid", "part", "good", "toxic"))]
    hits = []
    for k in sorted(letters):
        ids = failing.filter(F.col("filter") == k).select("rid")
        longer = [t.filter(F.col("filter") != k).withColumn("prefix", F.concat("prefix", F.lit(k)))
                  .join(wanted, ["filter", "prefix"], "left_semi") for t in left]
        hits += [t.join(ids, "rid", "left_semi").select("filter", "prefix", "part") for t in longer]
        rest = [t.join(ids, "rid", "left_anti").select(*left[0].columns) for t in longer]
        left.append(tables.store(reduce(DataFrame.union, rest)))
    gone = (reduce(DataFrame.union, left).groupBy("filter", "prefix", "part")
            .agg(F.count("*").alias("removed"), F.count_if("good").alias("good_lost"), F.count_if("toxic").alias("toxic_lost")))
    hit = reduce(DataFrame.union, hits).groupBy("filter", "prefix", "part").agg(F.count("*").alias("hit"))
    return gone.join(hit, ["filter", "prefix", "part"], "full")


def _sets(orders: list[str], letters: str) -> dict[str, list[str]]:
    """For each filter the sets (sorted letters) that stand before it in some
    order, with all other filters, and every set that one of them extends."""
    out: dict[str, set[str]] = {k: {"".join(c for c in sorted(letters) if c != k)} for k in letters}
    for o in orders:
        for i, k in enumerate(o):
            out[k].add("".join(sorted(o[:i])))
    return {k: sorted({s[:i] for s in v for i in range(len(s) + 1)}) for k, v in out.items()}


def audit(docs: DataFrame, labels: DataFrame, filters: dict | None = None, copies: str | None = COPIES,
          orders: list[str] | None = None, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, filter_order, step, filter, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley) for every part, order and step.

    ``filters`` maps a letter to its failure condition over (text, word
    counts); ``copies`` is the letter of the filter that a document fails if a
    smaller id has its text (in any part, removed or not).  ``orders`` are
    strings of all letters, by default every permutation; ``shapley`` sums a
    filter's removals over the orders.

    A null text is an empty one, a null part an empty string; a condition
    that is null does not fail.  Rows are documents: a repeated row counts
    again.  A null id is no copy, makes none and has no labels; rows that
    share an id and a text are no copies of each other.  An empty table gives
    no rows; columns of other names play no part."""
    filters = quality_filters() if filters is None else filters
    letters = "".join(filters) + (copies or "")
    if orders is None:
        if len(letters) > ALL_ORDERS:
            raise ValueError(f"list the orders of more than {ALL_ORDERS} filters")
        orders = ["".join(o) for o in permutations(letters)]
    if any(sorted(o) != sorted(letters) for o in orders) or len(set(letters)) != len(letters):
        raise ValueError("an order holds every letter once")
    spark = docs.sparkSession
    base = _judged(docs, labels, filters, part_col, id_col, text_col)
    totals = written(base.groupBy("part").agg(F.count("*").alias("total")), "audit-totals")
    rows = totals.agg(F.sum("total")).first()[0] or 0
    tables = _BucketTables(spark, max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS)))
    flags = [F.when(F.col(f"fails_{k}"), F.lit(k)) for k in filters]
    columns = ["rid", "part", "good", "toxic"]
    failing = base.select(F.explode(F.array_compact(F.array(*flags))).alias("filter"), *columns) if filters else None
    if copies:
        found = _copies(base, rows).select(F.lit(copies).alias("filter"), *columns)
        failing = found if failing is None else failing.unionByName(found)
    bucket = F.pmod(F.hash("rid"), F.lit(tables.buckets))
    failing = tables.store(failing.repartitionById(tables.buckets, bucket), apart=True)
    counts = written(_counts(tables, failing, letters, _sets(orders, letters)), "audit-counts")
    tables.drop()
    dropped(base)
    return _report(totals, counts, orders, letters)


def _report(totals: DataFrame, counts: DataFrame, orders: list[str], letters: str) -> DataFrame:
    # what the set has removed: its last letter's share, its last but one's, ...
    chain = F.transform(F.sequence(F.lit(0), F.length("prefix")), lambda i: F.substring("prefix", F.lit(1), i))
    places = (totals.select("part", "total", F.explode(F.split(F.lit(" ".join(orders)), " ")).alias("filter_order"))
              .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step")))
    before = F.filter(F.split(F.substring("filter_order", F.lit(1), F.col("step") - 1), ""), lambda c: c != "")
    places = places.select("*", F.substring("filter_order", F.col("step"), F.lit(1)).alias("filter"),
                           F.array_join(F.array_sort(before), "").alias("prefix"))
    key = ["part", "filter", "prefix"]
    hits = (places.select(*key).distinct().select(*key, F.explode(chain).alias("member"))
            .join(counts.select("part", "filter", F.col("prefix").alias("member"), "hit"), ["part", "filter", "member"])
            .groupBy(*key).agg(F.sum("hit").alias("redundant")))
    alone = (counts.filter(F.length("prefix") == len(letters) - 1)
             .select("part", "filter", F.col("removed").alias("unique_fails")))
    rows = places.join(counts.drop("hit"), key, "left").join(hits, key, "left").join(alone, ["part", "filter"], "left")
    zero = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("removed", "good_lost", "toxic_lost", "redundant", "unique_fails")}
    rows = rows.withColumns(zero)
    so_far = F.sum("removed").over(Window.partitionBy("part", "filter_order").orderBy("step"))
    shapley = F.sum("removed").over(Window.partitionBy("part", "filter"))
    return rows.select("part", "filter_order", "step", "filter", (F.col("total") - so_far).alias("kept"), "removed", "redundant",
                       "unique_fails", "good_lost", "toxic_lost", shapley.alias("shapley"))
