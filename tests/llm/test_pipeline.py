"""The stages of the corpus pipeline one by one, and the registered queries."""
from __future__ import annotations

import zlib
from collections import defaultdict

import __spark_entry__ as entry
import corpus_pipeline
import pytest

from helpers import awkward_documents
from test_text_operators import brute_join, brute_lines, unpacked

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= names


def test_stages(spark):
    """Each stage against its rule, on what the one before has kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
        kept = {r["doc_id"]: r for r in docs.collect()}
        assert kept and set(kept) <= set(before)
        rows = sorted((i, r["text"]) for i, r in before.items())
        if name == "line_dedup":
            gone = brute_lines(rows, 8)
            for i, t in rows:
                lines = sum(bool(x.strip()) for x in t.split("\n"))
                assert (i in kept) == (gone[i] < lines or not gone[i])
                if i in kept:
                    assert (kept[i]["text"] == t) == (not gone[i]) and (kept[i]["n_chars"] == len(kept[i]["text"]) or not gone[i])
        elif name == "ngram_join":
            groups = defaultdict(set)
            for i, c in brute_join(rows, 5, 80).items():
                groups[c].add(i)
            assert all(len(g & set(kept)) == 1 and min(g) in kept for g in groups.values())
        else:
            assert all(kept[i] == before[i] for i in kept)
    pieces, padding = unpacked(corpus_pipeline.pack(spark, docs, SF).collect())
    assert padding == 0 and {d for d, _ in pieces} == set(kept)
    assert all(sum(p[1] for p in ps) == n for (_, n), ps in pieces.items())


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert unpacked(rows)[1] == 0 and len({r["doc_id"] for r in rows}) > 50


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_awkward_rows(spark, name, stage):
    docs = awkward_documents(spark)
    out = stage(spark, docs, SF)
    if name != "packing":
        assert out.columns == docs.columns
    assert out.count() > 0
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_clean_documents_stay(spark):
    """Ordinary prose passes the filters; toxic labels go, poor ones go."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    truth = {r["doc_id"]: r for r in labels.collect()}
    held = {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    left = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, "/root/testdata/sf0.01").select("doc_id").collect()}
    clean = {i for i in held if not truth[i]["toxic"]}
    assert len(clean - left) <= 1
    fine = {r["doc_id"] for r in corpus_pipeline.drop_poor(spark, docs, "/root/testdata/sf0.01").select("doc_id").collect()}
    good = {i for i in held if truth[i]["quality"]}
    assert len(good - fine) <= 0.03 * len(good) and not {i for i in held - good} & fine
