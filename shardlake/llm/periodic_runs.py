"""Runs of periodically repeated words, by a dictionary of basic factors.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are
equal) that no neighbour extends.  For each power of two ``L`` every factor of
``L`` words that recurs in its document gets a name (pairs of names of the
level below, sorted); the sort also gives each factor's next occurrence.  An
occurrence whose successor and the successor's successor lie at one distance
of at most ``2 L`` is an arithmetic progression and proposes that distance as
a period; neighbouring places with the same distance are one proposal.  One
period from there is extended both ways, as far as words a period apart are
equal, by matching names from the longest level down; equal ``(start, period)``
are one run.

No run of at least four periods is missed: at the level with ``L/2 < q <= L``
a factor of the run recurs exactly ``q`` words on, so its start proposes ``q``.
No run's period is a multiple of a smaller one: the factor that proposed it
would recur at the smaller distance first.

Documents are independent, so there is no shuffle.  A task looks at the words
of at most ``WORDS_TOGETHER`` words of an Arrow batch at once (one longer
document by itself); names are kept for recurring factors only.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches

#: Least number of periods and least number of words of a run.
MIN_PERIODS, MIN_WORDS = 4, 6
WORDS_TOGETHER = 1 << 20

RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))
_RUN = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])


class FactorDictionary:
    """Names of recurring factors of a row of documents, level by level.

    ``words`` are word numbers, ``ends`` each document's end in them.
    ``levels[k]`` is (places, names) of the factors of ``2**k`` words that
    recur in their document; names differ between documents."""

    def __init__(self, words: np.ndarray, ends: np.ndarray):
        self.size = len(words)
        sizes = np.diff(np.r_[0, ends])
        self.doc = np.repeat(np.arange(len(ends), dtype=np.int32), sizes)
        self.room = np.repeat(ends, sizes) - np.arange(self.size)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.proposals: list[tuple[np.ndarray, np.ndarray]] = []
        self.names = np.full(self.size, -1, dtype=np.int32)
        self.successor = np.zeros(self.size, dtype=np.int64)
        places, codes, length = np.arange(self.size), words.astype(np.int64), 1
        while len(places):
            places, names = self._level(places, codes, length)
            left = places[self.room[places] >= 2 * length]
            right = self.names[left + length]
            codes = self.names[left].astype(np.int64) * (self.size + 1) + right
            self.names[places] = -1
            places, codes = left[right >= 0], codes[right >= 0]
            length *= 2
        del self.names, self.successor

    def _level(self, places: np.ndarray, codes: np.ndarray, length: int):
        """Name the factors at ``places`` (ascending), keep those that recur,
        note successors and take the level's proposals."""
        order = np.argsort(codes, kind="stable")
        at, code = places[order], codes[order]
        same = (code[1:] == code[:-1]) & (self.doc[at[1:]] == self.doc[at[:-1]])
        recurs = np.r_[same, False] | np.r_[False, same]
        name = np.cumsum(np.r_[True, ~same])[recurs] if len(at) else np.zeros(0, dtype=np.int64)
        follower = np.r_[np.where(same, at[1:], -1), -1][recurs]
        at = at[recurs]
        self.names[at] = name
        self.successor[at] = follower
        places = np.sort(at)
        names = self.names[places]
        self.levels.append((places, names.copy()))
        self._propose(places, length)
        return places, names

    def _propose(self, places: np.ndarray, length: int) -> None:
        nearest = self.successor[places] - places
        some = (nearest > 0) & (nearest <= 2 * length)
        seed, gap = places[some], nearest[some]
        progression = self.successor[seed + gap] == seed + 2 * gap
        seed, gap = seed[progression], gap[progression]
        if len(seed):
            new = np.r_[True, (np.diff(seed) != 1) | (np.diff(gap) != 0)]
            self.proposals.append((seed[new], gap[new]))

    def _name(self, level: int, places: np.ndarray) -> np.ndarray:
        known, names = self.levels[level]
        if not len(known):
            return np.full(len(places), -1, dtype=np.int32)
        i = np.minimum(np.searchsorted(known, places), len(known) - 1)
        return np.where(known[i] == places, names[i], -1)

    def runs(self, min_periods: int = MIN_PERIODS, min_words: int = MIN_WORDS):
        """(start, end, period) of every run, by start and period."""
        if not self.proposals:
            return (np.zeros(0, dtype=np.int64),) * 3
        start, period = (np.concatenate(x) for x in zip(*self.proposals))
        end = start + period
        for level in reversed(range(len(self.levels))):
            step = 1 << level
            a = self._name(level, end - period)
            end = end + step * ((a >= 0) & (a == self._name(level, end)))
            a = self._name(level, start - step)
            start = start - step * ((a >= 0) & (a == self._name(level, start - step + period)))
        long = end - start >= np.maximum(min_words, min_periods * period)
        found = np.unique(np.stack([start[long], period[long], end[long]], axis=1), axis=0)
        return found[:, 0], found[:, 2], found[:, 1]


def _together(sizes: list[int]):
    """Ranges of documents with at most ``WORDS_TOGETHER`` words, or one."""
    a, n = 0, 0
    for i, size in enumerate(sizes):
        if i > a and n + size > WORDS_TOGETHER:
            yield a, i
            a, n = i, 0
        n += size
    if a < len(sizes):
        yield a, len(sizes)


def runs_of_texts(texts: list[bytes], min_periods: int = MIN_PERIODS, min_words: int = MIN_WORDS):
    """For each text its runs, an array of (start, length, period), and the
    text of the words that stay, joined by one space."""
    split = [t.split() for t in texts]
    runs, kept = [], []
    for a, z in _together([len(w) for w in split]):
        sizes = np.array([len(w) for w in split[a:z]], dtype=np.int64)
        words = np.array([w for ws in split[a:z] for w in ws], dtype=object)
        ends = np.cumsum(sizes)
        first = ends - sizes
        start, end, period = FactorDictionary(pd.factorize(words)[0], ends).runs(min_periods, min_words)
        change = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, end, -1)
        stays = np.cumsum(change)[:-1] == 0
        doc = np.searchsorted(ends, start, side="right")
        cut = np.searchsorted(doc, np.arange(z - a + 1))
        for i, (f, e) in enumerate(zip(first.tolist(), ends.tolist())):
            at = slice(cut[i], cut[i + 1])
            runs.append(np.stack([start[at] - f, end[at] - start[at], period[at]], axis=1))
            own = split[a + i]
            kept.append(b" ".join(own if cut[i] == cut[i + 1] else words[f:e][stays[f:e]].tolist()))
    return runs, kept


def find_runs(docs: DataFrame, min_periods: int = MIN_PERIODS, min_words: int = MIN_WORDS,
              text_col: str = "text", runs_col: str = "runs", kept_col: str = "collapsed") -> DataFrame:
    """``docs`` with its text replaced by ``runs``, an array of (start, length,
    period) by start and period, words numbered from 0, and ``collapsed``, the
    text without each run's words after its first period.

    Words are maximal ``[^\\x20\\x09-\\x0D]+`` of the whole text.  A run has at
    least ``min_periods`` (four or more) periods and ``min_words`` words.  A
    null, empty or blank text has no run and collapses to an empty one.  Rows
    are looked at each by itself, so repeated rows and null ids stay; the other
    columns are kept (ones called like the two new columns are replaced)."""
    if min_periods < 4:
        raise ValueError("runs of fewer than four periods may have no progression of their own")
    small_batches(docs.sparkSession)
    keep = [f for f in docs.schema.fields if f.name not in (text_col, runs_col, kept_col)]
    names = [f.name for f in keep]

    def run(batches):
        for b in batches:
            texts = [t or b"" for t in b.column(text_col).cast(pa.binary()).to_pylist()]
            runs, kept = runs_of_texts(texts, min_periods, min_words)
            flat = np.concatenate(runs) if runs else np.zeros((0, 3), dtype=np.int64)
            ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
            structs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(_RUN))
            column = pa.ListArray.from_arrays(pa.array(ends), structs)
            text = pa.array(kept, type=pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), column, text], names=[*names, runs_col, kept_col])

    schema = T.StructType([*keep, T.StructField(runs_col, RUNS), T.StructField(kept_col, T.StringType())])
    return docs.select(*names, text_col).mapInArrow(run, schema)


def strongest(runs) -> F.Column:
    """The run with the greatest length / period, compared exactly; of equals
    the one with the least start, then period.  Null where there is none."""
    def better(best, r):
        a, b = r["length"] * best["period"], best["length"] * r["period"]
        return F.when(best.isNull() | (a > b), r).otherwise(best)  # runs come by start and period

    none = F.lit(None).cast(RUNS.elementType)
    return F.aggregate(runs, none, better)


def runs_text(runs) -> F.Column:
    """A line ``start,length,period`` for every run."""
    line = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return F.array_join(line, "")
