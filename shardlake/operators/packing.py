"""K11, greedy: records in order are put into the open group until the next
one would break its line or byte limit.

Where a group ends depends on where it starts, and so on all records of the key
before.  A key may hold a third of all records, so this is not walked record by
record in one task.  The records of a key are cut into *stretches* of a fixed
number of lines.  The first group of a stretch starts within its first
``max_lines`` records, so a stretch is a small table: for each such start, the
place in the next stretch where the first group starts (found with prefix sums
over the stretch and the ``max_lines`` records behind it).  The tables of
``FAN`` neighbours compose into one, ``FAN`` of those again, up to one table a
key; then the start 0 of the key goes down that tree and gives every stretch its
first start.  Each level is a shuffle by (key, node) of the tables of the one
below.  The plan holds every level twice, and the plans below it, so the tree is
wide: a million stretches take four levels.  Without a limit of bytes groups
start at the multiples of ``max_lines`` and need no tree.
"""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.broadcast import checked_broadcast
from ..plans.cache import persist_fresh
from ..plans.numbering import largest_key_rows, position_within
from .route import floor_div, record_bytes

#: Lines of a stretch for each line of a group: a longer stretch carries less
#: of its neighbour and has fewer tables, and needs more memory.
STRETCH = 4
#: Tables composed into one: fewer make the tree and so the plan deeper, more
#: make the rows larger (a row holds ``FAN * max_lines`` numbers).
FAN = 32


def next_starts(sizes: np.ndarray, own: int, max_lines: int, max_bytes: int | None) -> np.ndarray:
    """For a group that starts at each of the first ``own`` records, where the
    next one starts.  ``sizes``: bytes of these records and those behind."""
    first = np.arange(own)
    out = np.minimum(first + max_lines, len(sizes))
    if max_bytes is not None:
        until = np.concatenate([[0], np.cumsum(sizes)])
        fits = np.searchsorted(until, until[:own] + max_bytes, side="right") - 1
        out = np.minimum(out, np.maximum(fits, first + 1))    # a larger record is a group of its own
    return out


def jump_table(sizes: np.ndarray, lines: int, max_lines: int, max_bytes: int | None) -> np.ndarray:
    """For a first group at each of the first ``max_lines`` records of a whole
    stretch of ``lines``, where the first group of the next one starts."""
    land = next_starts(sizes, lines, max_lines, max_bytes)
    for i in range(lines - 1, -1, -1):
        if land[i] < lines:
            land[i] = land[land[i]]
    return land[:max_lines] - lines


def group_ends(sizes: np.ndarray, lines: int, start: int, max_lines: int, max_bytes: int | None) -> np.ndarray:
    """For each record of a stretch, the place after the last record of its
    group, where the first group to start in the stretch starts at ``start``."""
    own = min(len(sizes), lines)
    after = next_starts(sizes, own, max_lines, max_bytes)
    out = np.full(own, start)
    while start < own:
        out[start:after[start]] = after[start]
        start = after[start]
    return out


def _same(left: DataFrame, right: DataFrame, keys: list[str], on: list[str]) -> DataFrame:
    """An inner join on ``keys`` (a null key is a key of its own) and ``on``."""
    names = {c: f"_r{i}" for i, c in enumerate([*keys, *on])}
    renamed = right.select(*[F.col(c).alias(names.get(c, c)) for c in right.columns])
    cond = [F.col(k).eqNullSafe(F.col(names[k])) for k in keys] + [F.col(c) == F.col(names[c]) for c in on]
    return left.join(renamed, cond).drop(*names.values())


def _first_starts(tables: DataFrame, keys: list[str], stretches: int) -> DataFrame:
    """(keys, _at, _start): where the first group of each stretch starts.
    ``tables``: (keys, _at, _table), ``_table`` null for a key's last one."""
    levels = []
    while stretches > 1:
        below = F.sort_array(F.collect_list(F.struct("_at", "_table")))    # at most FAN tables
        nodes = persist_fresh(tables.groupBy(*keys, floor_div(F.col("_at"), FAN).alias("_node")).agg(
            F.transform(below, lambda t: t["_table"]).alias("_tables")))
        levels.append(nodes)
        composed = F.aggregate(F.slice("_tables", 2, FAN), F.get("_tables", F.lit(0)),
                               lambda acc, t: F.transform(acc, lambda s: F.get(t, s)))
        whole = F.get("_tables", F.lit(FAN - 1)).isNotNull()
        tables = nodes.select(*keys, F.col("_node").alias("_at"), F.when(whole, composed).alias("_table"))
        stretches = -(-stretches // FAN)
    starts = tables.select(*keys, "_at", F.lit(0).alias("_start"))
    for nodes in reversed(levels):
        down = _same(nodes, starts.withColumnRenamed("_at", "_node"), keys, ["_node"])
        each = F.aggregate(F.slice("_tables", 1, F.size("_tables") - 1), F.array("_start"),
                           lambda acc, t: F.concat(acc, F.array(F.get(t, F.element_at(acc, -1)))))
        starts = (down.select(*keys, "_node", F.posexplode(each).alias("_place", "_start"))
                  .select(*keys, (F.col("_node") * FAN + F.col("_place")).alias("_at"), "_start"))
    return starts


def pack_greedy(records: DataFrame, order: Sequence[str], max_lines: int = 4096, max_bytes: int | None = 3 * 1024 * 1024,
                keys: Sequence[str] = ("logstore", "topic", "source"), largest: int | None = None,
                stretch: int = STRETCH) -> DataFrame:
    """``records`` with ``group_end``: records with the same ``keys`` and
    ``group_end`` are a group; ``group_end`` is the place, in ``order`` within
    the keys and counted from 0, after the group's last record.

    A group takes records as long as it has at most ``max_lines`` of them and
    at most ``max_bytes`` bytes (``route.record_bytes``); a record that alone
    is larger is a group of its own.  ``order`` must be unique within a key.  A
    null key is a key of its own; null contents have no bytes; an empty table
    gives no rows.  ``largest``: a known upper bound of the records of a key.
    Names that begin with ``_`` are the operator's own and must not be columns
    of ``records``."""
    keys, order = list(keys), list(order)
    if max_lines < 1 or (max_bytes is not None and max_bytes < 0) or stretch < 1:
        raise ValueError("max_lines and stretch must be positive, max_bytes not negative")
    lines = max_lines * stretch
    top = largest if largest is not None else largest_key_rows(records, keys)
    placed = position_within(records, keys, order, out="_pos", largest=top)
    if max_bytes is None:
        # groups start at the multiples of max_lines: the place alone tells where one ends
        totals = checked_broadcast(records.groupBy(*keys).agg(F.count("*").alias("_n")))
        end = F.least((floor_div(F.col("_pos"), max_lines) + 1) * max_lines, F.col("_n"))
        return _same(placed, totals, keys, []).withColumn("group_end", end).drop("_pos", "_n")
    placed = placed.withColumn("_at", floor_div(F.col("_pos"), lines))
    size = F.coalesce(record_bytes(), F.lit(0)).cast("long")
    within = F.col("_pos") - F.col("_at") * lines
    lent = F.when((within < max_lines) & (F.col("_at") > 0), F.array(F.col("_at"), F.col("_at") - 1)).otherwise(F.array(F.col("_at")))
    sized = placed.select(*keys, "_pos", size.alias("_size"), F.explode(lent).alias("_at"))
    entries = F.sort_array(F.collect_list(F.struct("_pos", "_size")))    # at most lines + max_lines
    stretches = persist_fresh(sized.groupBy(*keys, "_at").agg(F.transform(entries, lambda e: e["_size"]).alias("_sizes")))

    @F.pandas_udf("array<int>")
    def table(sizes: pd.Series) -> pd.Series:
        return sizes.map(lambda s: jump_table(np.asarray(s), lines, max_lines, max_bytes) if len(s) > lines else None)

    @F.pandas_udf("array<int>")
    def ends(sizes: pd.Series, starts: pd.Series) -> pd.Series:
        return pd.Series([group_ends(np.asarray(s), lines, a, max_lines, max_bytes) for s, a in zip(sizes, starts)], dtype=object)

    starts = _first_starts(stretches.select(*keys, "_at", table("_sizes").alias("_table")), keys, -(-top // lines))
    ended = _same(stretches, starts, keys, ["_at"]).select(*keys, "_at", ends("_sizes", "_start").alias("_ends"))
    end = F.col("_at") * lines + F.get("_ends", within.cast("int"))
    return _same(placed, ended, keys, ["_at"]).withColumn("group_end", end).drop("_pos", "_at", "_ends")
