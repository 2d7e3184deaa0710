"""The corpus pipeline: toxicity, quality, line dedup, n-gram Jaccard join and
packing, each stage over all documents that the one before has kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes each as Parquet to the shared folder and reads it again as the next
stage's ``docs``.  All but the last return the columns of ``docs``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlake.llm import line_dedup, ngram_join, packing, quality, toxicity
from shardlake.llm.common import free_name, table, workers_find_library, written
from shardlake.llm.queries import PACK_TOKENIZER

#: Near duplicates of the pipeline: shingles of five words, Jaccard 0.8.
WIDTH, PERCENT = 5, 80

#: The stages learn classifiers and cut texts; SQL cannot express them.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    workers_find_library(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    score = toxicity.score_column(model, F.col("text"))
    name = free_name(docs.columns, "score")
    return docs.withColumn(name, score).filter(F.col(name) < toxicity.THRESHOLD).select(*docs.columns)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    workers_find_library(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    score = toxicity.score_column(model, F.col("text"))
    name = free_name(docs.columns, "score")
    return docs.withColumn(name, score).filter(F.col(name) >= quality.THRESHOLD).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go, and documents of which nothing
    else is left; ``n_chars`` follows the text."""
    workers_find_library(spark)
    cut = line_dedup.dedup_lines(docs)
    out = cut.filter(~F.col("emptied"))
    if "n_chars" in docs.columns:
        size = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id.  Rows
    that share the id of a group's document stay with it; a null id stays."""
    workers_find_library(spark)
    found = ngram_join.near_duplicates(docs, WIDTH, PERCENT)
    gone = written(found.filter(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct(), "gone")
    if gone.count() <= ngram_join.BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces of training sequences."""
    workers_find_library(spark)
    return packing.pack(docs, PACK_TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", drop_near_duplicates),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
