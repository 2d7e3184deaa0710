"""Persisting intermediate results that must not be shared across calls.

Spark's cache matches *plans*: a later DataFrame with the same plan reads
an earlier cached result.  That is wrong here in two cases: results of
non-deterministic plans (range partitioning samples its bounds, partition
ids and row ids follow from them), which must be paired with the rows of
the same computation; and results over files that change between calls (a
log store that was appended to).  So every persist gets a plan of its own
(a unique token column, dropped again), and everything persisted is
registered with its thread, so that a job's own frames can be released
(``scoped``) without those that another lazy frame still needs.
"""
from __future__ import annotations

import threading
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = "_persist_token"
_OF_THREAD = threading.local()


def _live() -> list[DataFrame]:
    if not hasattr(_OF_THREAD, "frames"):
        _OF_THREAD.frames = []
    return _OF_THREAD.frames


def persist_fresh(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """``df`` persisted under a plan no other DataFrame can match."""
    kept = df.withColumn(TOKEN, F.lit(uuid.uuid4().hex)).persist(level)
    _live().append(kept)
    return kept.drop(TOKEN)


@contextmanager
def scoped():
    """Unpersist at the end what was persisted inside, and nothing else; the
    results built on it must be written or collected by then."""
    before = len(_live())
    try:
        yield
    finally:
        while len(_live()) > before:
            _live().pop().unpersist()


def release_persisted() -> None:
    """Unpersist everything that this thread has persisted by
    :func:`persist_fresh` (between queries)."""
    while _live():
        _live().pop().unpersist()
