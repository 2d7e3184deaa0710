"""A3 on a stream, whatever the age of a duplicate: the positions that were
delivered are state, kept as merged intervals.

``operators.audit.dedup_stream`` forgets what is older than its watermark.
Here a shard's positions are dense, so what was delivered is a few intervals
however long the stream runs: one without gaps, one more for each gap.  A
shard's positions are dealt to ``lanes`` states by their remainder (the
quotients are dense again), so a shard with most of the rows takes that many
tasks, not one.
"""
from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..model import floor_div
from ..session import workers_find_library

LANES = 16
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows travel as text; microseconds stay.
TEXT = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


def merge(begins: np.ndarray, ends: np.ndarray, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint sorted intervals ``[begin, end)`` with ``positions`` (none of
    them inside) added; touching intervals become one."""
    b, e = np.concatenate([begins, positions]), np.concatenate([ends, positions + 1])
    order = np.argsort(b, kind="stable")
    b, e = b[order], e[order]
    first = np.concatenate([[True], b[1:] > e[:-1]]) if len(b) else np.zeros(0, bool)
    last = np.concatenate([first[1:], [True]]) if len(b) else first
    return b[first], e[last]


def inside(begins: np.ndarray, ends: np.ndarray, positions: np.ndarray) -> np.ndarray:
    at = np.searchsorted(begins, positions, "right") - 1
    return (at >= 0) & (positions < ends[at]) if len(begins) else np.zeros(len(positions), bool)


class SeenPositions(StatefulProcessor):
    """Lets the first row of each position pass."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "begins array<bigint>, ends array<bigint>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        begins = ends = np.zeros(0, np.int64)
        if self.seen.exists():
            begins, ends = (np.array(a, np.int64) for a in self.seen.get())
        for batch in rows:
            # columns come in order, without their names: keys, lane, position, row
            at, text = batch.iloc[:, -2].to_numpy(np.int64), batch.iloc[:, -1]
            _, first = np.unique(at, return_index=True)
            fresh = np.zeros(len(at), bool)
            fresh[first] = True
            fresh &= ~inside(begins, ends, at)
            begins, ends = merge(begins, ends, at[fresh])
            yield pd.DataFrame({"row": text[fresh]})
        self.seen.update((begins.tolist(), ends.tolist()))

    def close(self) -> None:
        pass


def dedup_positions(stream: DataFrame, position: str = "seq", by: tuple[str, ...] = ("logstore", "shard"), lanes: int = LANES) -> DataFrame:
    """The rows of ``stream`` whose ``position`` (a long, not null, one row
    each, dense within ``by``) was never delivered before.  Start the query
    inside :func:`interval_state`."""
    workers_find_library(stream.sparkSession)
    lane, at = F.pmod(F.col(position), F.lit(lanes)), floor_div(F.col(position), lanes)
    rows = stream.select(*[F.col(c).alias(f"_key{i}") for i, c in enumerate(by)], lane.alias("_lane"), at.alias("_at"),
                         F.to_json(F.struct(*[F.col(c) for c in stream.columns]), TEXT).alias("_row"))
    kept = rows.groupBy(*[f"_key{i}" for i in range(len(by))], "_lane").transformWithStateInPandas(
        SeenPositions(), outputStructType="row string", outputMode="Append", timeMode="None")
    return kept.select(F.from_json("row", stream.schema, TEXT).alias("r")).select("r.*")


@contextmanager
def interval_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which the intervals
    need; the session's own setting comes back afterwards."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
