"""Line dedup with a suffix array over line ids, built by prefix doubling.

A document is the sequence of its non-blank lines, each a 128-bit line id.
Prefix doubling ranks the suffixes of all documents by their first line, then
by their first 2, 4, 8, ... lines: the rank for ``2n`` lines is the place of
the pair (rank of the suffix, rank of the suffix ``n`` lines later) in the
sorted order of all pairs.  Suffixes whose prefix occurs once leave the array;
nothing in them can be a repeat of that length.

Suffixes that share their first ``m`` lines are one interval of the array with
a common prefix of at least ``m``; two ranks that overlap name it for any
``m``.  A run of lines counts as repeated if it has ``min_words`` words and
occurs at least twice.  Every maximal repeated run is the union of the shortest
windows of ``min_words`` words inside it, taken from each line forwards and
backwards, so the intervals of these windows reveal all of it, and doubling
stops at their length (``min_words`` lines at most).  In each interval the
earliest window, by (doc_id, hash of the text, line), stays; the lines of the
later ones are deleted.

Sorting, grouping and joining are Spark's; hot lines meet in pre-aggregated
groups and in joins that can split a skewed key.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, free_name, small_batches, written

MIN_WORDS = 8
KEY = ["k", "t"]
PLACE = ["i", "m", "line"]


def windows(words: list[int], least: int) -> list[list[int]]:
    """For each line, the lengths of the windows that start there: the shortest
    one with ``least`` words forwards, and those that are the shortest
    backwards from their last line.  ``words`` may be capped at ``least``."""
    out: list[list[int]] = [[] for _ in words]
    begin, total = 0, 0
    for end, n in enumerate(words):
        total += n
        while total - words[begin] >= least:
            total -= words[begin]
            begin += 1
        if total >= least:
            out[begin].append(end - begin + 1)  # backwards from ``end``
    end, total = 0, 0
    for begin, n in enumerate(words):
        while end < len(words) and total < least:
            total += words[end]
            end += 1
        if total < least:
            break
        if (size := end - begin) not in out[begin]:
            out[begin].append(size)  # forwards from ``begin``
        total -= n
    return out


SPAN = pa.list_(pa.struct([("size", pa.int32()), ("end", pa.int32())]))


def _lines(least: int):
    """One row per non-blank line: document (k, t), its number among them
    (i of m), its number in the text, its id (h1, h2), and the windows that
    start there with the number of their last line in the text."""
    def run(batches):
        for b in batches:
            rows: list[tuple] = []
            for k, t, text in zip(*(b.column(c).to_pylist() for c in ("k", "t", "text"))):
                lines = [(n, x) for n, x in enumerate((text or "").split("\n")) if x.strip()]
                spans = windows([len(x.split(None, least)[:least]) for _, x in lines], least)
                for i, (n, x) in enumerate(lines):
                    own = xxhash.xxh3_128_intdigest(x.encode("utf-8", "replace"))
                    rows.append((k, t, i, len(lines), n, (own >> 64) - (1 << 63), (own & (1 << 64) - 1) - (1 << 63),
                                 [{"size": s, "end": lines[i + s - 1][0]} for s in spans[i]]))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), SPAN]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)],
                                             names=["k", "t", "i", "m", "line", "h1", "h2", "spans"])

    return run


def _ranked(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rank of every ``by`` that occurs more than once: its place in the sorted
    order.  Range partitions are in order, and so are the numbers."""
    again = rows.groupBy(*by).agg(F.count("*").alias("n")).filter("n > 1").select(*by)
    return written(again.repartitionByRange(*by).sortWithinPartitions(*by)
                   .withColumn("new_rank", F.monotonically_increasing_id()), "ranks")


def keyed(docs: DataFrame) -> tuple:
    """Columns that name a row's document: the id (the least long for null)
    and a hash of its text."""
    return (F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2 ** 63)).cast("long")).alias("k"),
            F.xxhash64(F.col("text").cast("string")).alias("t"))


def repeated_windows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(k, t, i, size, line, end, m): windows of ``size`` non-blank lines from
    the ``i``-th of the ``m`` of document (k, t) that have an earlier copy;
    ``line`` and ``end`` are their first and last line's numbers in the text."""
    small_batches(docs.sparkSession)
    lines = written(docs.select(*keyed(docs), F.col("text").cast("string").alias("text"))
                    .mapInArrow(_lines(min_words), "k long, t long, i int, m int, line int, h1 long, h2 long, spans array<struct<size:int,end:int>>"), "lines")
    longest = lines.agg(F.max(F.array_max(F.col("spans.size")))).first()[0] or 0
    ranks = _ranked(lines, ["h1", "h2"])
    # suffixes with a repeated prefix of ``size`` lines, and the windows that start at them
    array = written(lines.join(ranks, ["h1", "h2"]).select(*KEY, *PLACE, F.col("new_rank").alias("rank"), "spans"), "suffixes")
    spent = [lines, ranks]
    found, size = [], 1
    while size <= longest:
        fits = F.filter("spans", lambda s: (s["size"] >= size) & (s["size"] < 2 * size))
        own = array.select(*KEY, *PLACE, "rank", F.explode(fits).alias("span")).select("*", "span.size", "span.end").drop("span")
        there = array.select(*KEY, F.col("i").alias("j"), F.col("rank").alias("last"))
        spans = own.filter(F.col("size") == size).withColumn("last", F.col("rank"))
        if size > 1:
            spans = spans.unionByName(own.filter(F.col("size") > size).withColumn("j", F.col("i") + F.col("size") - size)
                                      .join(there, [*KEY, "j"]).drop("j"))
        spans = written(spans, "windows")
        place = F.struct(*KEY, "i")
        first = (spans.groupBy("size", "rank", "last").agg(F.min(place).alias("first"), F.max(place).alias("final"))
                 .filter("first <> final").drop("final"))
        found.append(spans.join(first, ["size", "rank", "last"]).filter(F.struct(*KEY, "i") != F.col("first")).select(*KEY, *PLACE, "size", "end"))
        if 2 * size <= longest:
            pairs = written(array.withColumn("j", F.col("i") + size).join(there, [*KEY, "j"]).drop("j"), "pairs")
            ranks = _ranked(pairs, ["rank", "last"])
            array = written(pairs.join(ranks, ["rank", "last"])
                            .select(*KEY, *PLACE, F.col("new_rank").alias("rank"), "spans"), "suffixes")
        size *= 2
    for d in spent:
        dropped(d)
    out = found[0] if found else array.select(*KEY, *PLACE, F.lit(1).alias("size"), F.col("line").alias("end"))
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _deleted(windows: pd.Series) -> pd.DataFrame:
    """From the windows of a document (i, size, line, end by turns): for each
    line of the text whether it goes, and how many non-blank ones go.  Windows
    that overlap or adjoin are one run, and blank lines inside a run go too."""
    out = []
    for rows in windows:
        rows = np.asarray(rows, dtype=np.int64).reshape(-1, 4)
        gone, count, last = np.zeros(int(rows[:, 3].max()) + 1, dtype=bool), 0, -1
        start = 0
        for i, size, line, end in rows[np.lexsort((rows[:, 1], rows[:, 0]))].tolist():
            if i > last + 1 or last < 0:
                start, done = line, i
            elif i + size - 1 <= last:
                continue
            else:
                done = last + 1
            gone[start : end + 1] = True
            count += i + size - done
            last, start = i + size - 1, min(start, line)
        out.append((gone.tolist(), count))
    return pd.DataFrame(out, columns=["gone", "n"])


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated line runs deleted from ``text``, and the columns
    ``n_removed`` (lines deleted, long) and ``emptied`` (all lines were).

    Rows without a repeat keep their text as it is, null and empty ones too.
    Rows equal in id and text are one document and lose the same lines; rows
    that share only the id are documents of their own; null ids come before
    all others.  A text may repeat itself.  An empty table gives no rows; all
    columns are kept (``n_removed`` and ``emptied`` are replaced).
    """
    deleted = F.pandas_udf(_deleted, "gone array<boolean>, n long")
    runs = (repeated_windows(docs, min_words).distinct().groupBy(*KEY)
            .agg(F.max("m").alias("m"), F.flatten(F.collect_list(F.array("i", "size", "line", "end"))).alias("rows"))
            .withColumn("cut", deleted("rows")))
    keep = [c for c in docs.columns if c not in ("n_removed", "emptied")]
    # names that no column of the table has
    key, line_text, cut = (free_name(keep, c) for c in ("key", "key_text", "cut"))
    runs = runs.select(F.col("k").alias(key), F.col("t").alias(line_text), F.struct("cut.gone", "cut.n", "m").alias(cut))
    k, t = keyed(docs)
    both = docs.select(*keep, k.alias(key), t.alias(line_text)).join(runs, [key, line_text], "left")
    gone, n, m = (F.col(cut)[c] for c in ("gone", "n", "m"))
    rest = F.filter(F.split(F.col("text").cast("string"), "\n"), lambda x, i: ~F.coalesce(F.get(gone, i), F.lit(False)))
    all_gone = F.coalesce(n == m, F.lit(False))
    text = F.when(n.isNull(), F.col("text")).when(all_gone, F.lit("")).otherwise(F.array_join(rest, "\n"))
    return both.select(*(text.alias(c) if c == "text" else F.col(c) for c in keep),
                       F.coalesce(n, F.lit(0)).alias("n_removed"), all_gone.alias("emptied"))
