"""Reproducible shuffle into shards by a Feistel permutation of row numbers.

Rows are numbered 0 to n - 1 in the order of given columns.  A Feistel network
over the bits that n needs maps a number to another one; where that is n or
more it is mapped again (cycle walking), so the map is a permutation of the n
numbers.  A row's place p gives shard ``p % shards`` and slot ``p // shards``:
shard sizes differ by one row at most, slots have no gap.  The map needs the
seed and n alone, so ``Permutation`` tells any row's shard and slot and which
row lies in a slot, without a table.

Numbering: rows are range partitioned by the order columns and a stamp (rows
equal in all order columns, however many, spread over several tasks), numbered
inside each task and shifted by the counts of the tasks before: one number per
task reaches the driver.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import MASK, PLACE, mixed
from .common import dropped, free_name, written

SHARDS, SEED, ROUNDS = 40, 20240601, 8
#: The round function: two multiplications modulo a prime with a shift between.
PRIME, FIRST, SECOND, SHIFT = 2 ** 31 - 1, 1_664_525, 1_103_515_245, 15


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    return [mixed((seed + (r + 1) * PLACE) & MASK) % PRIME for r in range(rounds)]


class Permutation:
    """A keyed permutation of the numbers 0 to n - 1."""

    def __init__(self, n: int, seed: int = SEED, rounds: int = ROUNDS):
        self.n, self.keys = n, round_keys(seed, rounds)
        bits = max(2, (n - 1).bit_length())
        self.left, self.right = bits // 2, bits - bits // 2
        if self.right > 31:
            raise ValueError("too many rows")

    @staticmethod
    def _mix(half: np.ndarray, key: int, bits: int) -> np.ndarray:
        y = (half * np.uint64(FIRST) + np.uint64(key)) % np.uint64(PRIME)
        y = (y ^ (y >> np.uint64(SHIFT))) * np.uint64(SECOND) % np.uint64(PRIME)
        return y & np.uint64((1 << bits) - 1)

    def _network(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> np.uint64(self.right), x & np.uint64((1 << self.right) - 1)
        steps = list(enumerate(self.keys))
        for r, key in reversed(steps) if back else steps:
            if r % 2:
                right = right ^ self._mix(left, key, self.right)
            else:
                left = left ^ self._mix(right, key, self.left)
        return (left << np.uint64(self.right)) | right

    def _walk(self, numbers: np.ndarray, back: bool) -> np.ndarray:
        out = self._network(np.asarray(numbers).astype(np.uint64), back)
        while len(again := np.flatnonzero(out >= np.uint64(self.n))):
            out[again] = self._network(out[again], back)
        return out.astype(np.int64)

    def place(self, rows: np.ndarray) -> np.ndarray:
        """The place of each row number."""
        return self._walk(rows, False)

    def row(self, places: np.ndarray) -> np.ndarray:
        """The row number at each place."""
        return self._walk(places, True)


def slot_of(row: int, n: int, shards: int = SHARDS, seed: int = SEED) -> tuple[int, int]:
    """(shard, slot) of one of n rows."""
    place = int(Permutation(n, seed).place(np.array([row]))[0])
    return place % shards, place // shards


def row_of(shard: int, slot: int, n: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """The number of the row in a slot of a shard."""
    return int(Permutation(n, seed).row(np.array([slot * shards + shard]))[0])


def numbered(df: DataFrame, order: list[str], row_col: str = "row") -> tuple[DataFrame, int]:
    """``df`` with its rows numbered from 0 in the order of the columns (nulls
    first), stored in the shared folder, and the number of rows."""
    spark = df.sparkSession
    names = [c for c in df.columns if c != row_col]
    stamp = free_name([*names, row_col], "stamp")
    stored = written(df.select(*names, F.monotonically_increasing_id().alias(stamp)), "stamped")
    by = [*(F.col(c).asc_nulls_first() for c in order), F.col(stamp)]
    task = free_name([*names, row_col], "task")
    at = F.monotonically_increasing_id()
    ranged = written(stored.repartitionByRange(*by).sortWithinPartitions(*by)
                     .select(*names, at.alias(row_col)).withColumn(task, F.shiftright(row_col, 33)), "ranged")
    dropped(stored)
    before, n = [], 0
    for r in ranged.groupBy(task).agg(F.count("*").alias("n")).orderBy(task).collect():
        before.append((r[task], n - (r[task] << 33)))
        n += r["n"]
    shift = free_name([*names, row_col, task], "shift")
    shifts = F.broadcast(spark.createDataFrame(before, f"{task} long, {shift} long"))  # one row per task
    return (ranged.join(shifts, task).select(*names, (F.col(row_col) + F.col(shift)).alias(row_col)), n)


def shuffle(df: DataFrame, order: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``df`` with ``row`` (its number in the order of the columns, nulls
    first), ``shard`` and ``slot``.  Columns with these names are replaced.

    Rows equal in all order columns take their numbers in any order, so give
    enough columns (a digest of the text) to fix what differs.  A repeated row
    is a row of its own.  An empty table gives an empty one."""
    if shards < 1:
        raise ValueError("shards must be positive")
    rows, n = numbered(df.drop("shard", "slot"), order)
    permutation = Permutation(max(n, 1), seed)

    @F.pandas_udf("long")
    def place(row: pd.Series) -> pd.Series:
        return pd.Series(permutation.place(row.to_numpy()))

    at = free_name(rows.columns, "place")
    return (rows.withColumn(at, place("row"))
            .select(*rows.columns, (F.col(at) % shards).cast("int").alias("shard"),
                    F.expr(f"`{at}` div {shards}").alias("slot")))


def document_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, text_hash) of each document: what the shards
    of a corpus are numbered by.  A null text counts as an empty one; its size
    is 16 as every empty document's."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"))


def write_shards(df: DataFrame, order: list[str], path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Write whole rows as ``path/shard=i/part-*``: files of a shard follow one
    another in slot order, and a shard of any size is cut into several."""
    rows = shuffle(df, order, shards, seed)
    (rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def permutation_sql(rows: str, seed: int = SEED, rounds: int = ROUNDS) -> str:
    """CTEs of the same permutation in DuckDB SQL over a CTE ``rows`` with a
    column ``row``: ``placed`` (row, place) and ``bits`` (n, lb, rb)."""
    step = "SELECT row, n, lb, rb, x >> rb AS l, x & ((1 << rb) - 1) AS r FROM walk, bits WHERE NOT done"
    for i, key in enumerate(round_keys(seed, rounds)):
        half, other, size = ("l", "r", "rb") if i % 2 else ("r", "l", "lb")
        mixed_half = f"SELECT *, ({half} * {FIRST} + {key}) % {PRIME} AS y FROM ({step})"
        new = f"xor({other}, (xor(y, y >> {SHIFT}) * {SECOND} % {PRIME}) & ((1 << {size}) - 1)) AS {other}"
        step = f"SELECT row, n, lb, rb, {half}, {new} FROM ({mixed_half})"
    return f"""
bits AS (SELECT n, b // 2 AS lb, b - b // 2 AS rb FROM (
  SELECT count(*) AS n, greatest(2, length(bin(greatest(count(*) - 1, 1)))) AS b FROM {rows})),
walk(row, x, done) AS (
  SELECT row, row, false FROM {rows}
  UNION ALL SELECT row, (l << rb) | r, ((l << rb) | r) < n FROM ({step})),
placed AS (SELECT row, x AS place FROM walk WHERE done)"""
