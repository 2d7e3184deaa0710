"""Toxicity and quality: held-out accuracy, hidden labels and awkward rows."""
from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import DOCS, awkward_documents
from shardlake.llm import quality, toxicity

SF = "/root/testdata/sf0.01"
CASES = [(toxicity, "toxic", 0.7, 0.88), (quality, "quality", 0.5, 0.97)]


def held(i) -> bool:
    return zlib.crc32(str(i).encode()) % 3 == 1


@pytest.mark.parametrize("module, column, threshold, least", CASES)
def test_held_out_accuracy(spark, module, column, threshold, least):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in module.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r["held_out"] == held(i) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= threshold)
               for i, r in got.items())
    truth = {r["doc_id"]: r[column] for r in labels.collect() if held(r["doc_id"])}
    assert np.mean([got[i]["predicted"] == y for i, y in truth.items()]) >= least
    if column == "toxic":  # clean documents are left alone
        assert sum(got[i]["predicted"] for i, y in truth.items() if not y) <= 1


def test_held_out_toxic_rows_are_found(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r["predicted"] for r in toxicity.classify(docs, labels).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect() if held(r["doc_id"])}
    assert np.mean([got[i] for i, y in truth.items() if y]) >= 0.8
    assert np.mean([got[i] for i, y in truth.items() if not y]) <= 0.01


@pytest.mark.parametrize("module, column, threshold, least", CASES)
def test_held_out_labels_are_never_learnt(spark, module, column, threshold, least):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn(column, F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col(column))
                                .otherwise(F.col(column)))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("none"))
    scores = [[tuple(r) for r in module.classify(d, l).select("doc_id", F.round("score", 9)).orderBy("doc_id").collect()]
              for d, l in ((docs, labels), (other, flipped))]
    assert scores[0] == scores[1]


@pytest.mark.parametrize("module, column, threshold, least", CASES)
def test_awkward_rows(spark, module, column, threshold, least):
    docs = awkward_documents(spark)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(20)] + [(None, 1, 1), (3, None, None), (3, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    got = module.classify(docs, labels).collect()
    assert len(got) == 17 and all(0 <= r["score"] <= 1 for r in got)
    assert module.classify(docs, labels.limit(0)).count() == 17
    assert module.classify(docs.limit(0), labels).count() == 0
    one = module.classify(docs, labels.filter("quality = 1")).collect()
    assert len(one) == 17


def test_insults_without_labels(spark):
    texts = ["you are a stupid idiot and a worthless loser, pathetic trash", "the garden is green and the sky is blue today",
             "a report on the weather of the north", None]
    docs = spark.createDataFrame([(i, texts[i % 4], "en", "s", 1) for i in range(40)], DOCS)
    got = {r["doc_id"]: r["score"] for r in toxicity.classify(docs, spark.createDataFrame([], "doc_id long, toxic int")).collect()}
    assert min(got[i] for i in range(0, 40, 4)) > max(got[i] for i in range(40) if i % 4)


def test_label_model_counts_copies_of_a_voter_once():
    one = toxicity.LabelModel(np.array([[0.01, 0.9], [0.5, 0.2]]), 0.1, [np.array([0])])
    two = toxicity.LabelModel(np.array([[0.01, 0.01, 0.9], [0.5, 0.5, 0.2]]), 0.1, [np.array([0, 1])])
    assert np.allclose(one.posterior(np.array([[True], [False]])), two.posterior(np.array([[True, True], [False, False]])))


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(8)
    x = rng.uniform(size=(4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit_additive(x, y)
    assert ((model.margin(x) > 0) == y).mean() > 0.9
    assert (0, 1) in {tuple(sorted(p[:2])) for p in model.pairs}


def test_no_rows_and_one_class():
    assert quality.AdditiveModel().score([None, "a b"]).tolist() == [0.5, 0.5]
    assert quality.fit_additive(np.zeros((5, len(quality.FEATURES))), np.ones(5)).score([""])[0] > 0.8


def plain_posterior(model, row, given=None, errors=None):
    """Class 1 by Bayes, one vote at a time: of a group only the voter with
    the greatest rate ratio among those that fire counts."""
    p = [1 - model.prior, model.prior]
    for g in model.groups:
        firing = [k for k in g if row[k]]
        if firing:
            k = max(firing, key=lambda k: model.rate[1][k] / model.rate[0][k])
            p = [p[c] * model.rate[c][k] for c in (0, 1)]
    if not any(row):
        p = [p[c] * model.rate[c][-1] for c in (0, 1)]
    if given is not None and not np.isnan(given):
        p = [p[c] * (1 - errors[c] if bool(given) == bool(c) else errors[c]) for c in (0, 1)]
    return p[1] / sum(p)


def planted_votes(n=600, seed=3):
    """Four voters of which the last copies the third, and their true classes."""
    rng = np.random.default_rng(seed)
    y = rng.uniform(size=n) < 0.2
    votes = rng.uniform(size=(n, 4)) < np.where(y[:, None], [0.7, 0.5, 0.6, 0], [0.02, 0.05, 0.01, 0])
    votes[:, 3] = votes[:, 2]
    return y, votes


def test_label_model_equals_plain_expectation_maximisation(spark):
    y, votes = planted_votes()
    sizes = np.array([40.0, 10.0])
    known = np.array([[2.0, 3.0, 1.0, 1.0, 34.0], [6.0, 5.0, 6.0, 6.0, 1.0]])
    rows = spark.createDataFrame([(v.tolist(), 1) for v in votes], "votes array<boolean>, n long").groupBy("votes").count().withColumnRenamed("count", "n")
    got = toxicity.fit_label_model(rows, known, sizes)
    guess = np.array([[0.002] * 4 + [0.9], [0.1] * 4 + [0.1]])
    model = toxicity.LabelModel(np.clip((known + 2 * guess) / (sizes[:, None] + 2), 1e-5, 0.999),
                                np.clip((sizes[1] + 1) / (sizes.sum() + 10), 0.01, 0.5), [[0], [1], [2], [3]])
    for _ in range(toxicity.ROUNDS):
        q = [plain_posterior(model, v) for v in votes]
        rate, corr = np.zeros((2, 5)), np.zeros((4, 4))
        for c in (0, 1):
            w = np.array(q) if c else 1 - np.array(q)
            for k in range(5):
                fires = votes[:, k] if k < 4 else ~votes.any(axis=1)
                rate[c, k] = (w[fires].sum() + known[c, k] + 2 * guess[c, k]) / (w.sum() + sizes[c] + 2)
            for a in range(4):
                for b in range(4):
                    pa, pb = (w[votes[:, k]].sum() / w.sum() for k in (a, b))
                    pab = w[votes[:, a] & votes[:, b]].sum() / w.sum()
                    corr[a, b] = max(corr[a, b], (pab - pa * pb) / np.sqrt(pa * (1 - pa) * pb * (1 - pb)))
        prior = (sum(q) + sizes[1] + 1) / (len(q) + sizes.sum() + 10)
        model = toxicity.LabelModel(np.clip(rate, 1e-5, 0.999), prior, [[0], [1], [2, 3]])
        assert corr[2, 3] > toxicity.DEPENDENT > max(corr[0, 1], corr[0, 2], corr[1, 2])
    assert np.allclose(got.rate, model.rate, atol=1e-6) and np.isclose(got.prior, model.prior, atol=1e-6)
    assert sorted(map(sorted, got.groups)) == [[0], [1], [2, 3]]
    assert np.allclose(got.posterior(votes), [plain_posterior(model, v) for v in votes], atol=1e-5)
    # an abstention says nothing, so a weak voter alone is believed; still better than the larger class
    assert np.mean((got.posterior(votes) > 0.5) == y) > np.mean(~y) + 0.05


def test_annotator_is_one_voter_and_can_be_outvoted():
    y, votes = planted_votes(4000)
    model = toxicity.LabelModel(np.array([[0.02, 0.05, 0.01, 0.01, 0.9], [0.7, 0.5, 0.6, 0.6, 0.06]]), 0.2, [np.array([0]), np.array([1]), np.array([2, 3])])
    rng = np.random.default_rng(4)
    flipped = rng.uniform(size=len(y)) < 0.1
    given = np.where(rng.uniform(size=len(y)) < 0.5, np.nan, (y ^ flipped).astype(float))
    errors = toxicity.fit_annotator(model, votes, given)
    honest = toxicity.fit_annotator(model, votes, np.where(np.isnan(given), np.nan, y))
    assert (errors > 3 * honest).all() and (errors < 0.15).all()
    q = model.posterior(votes, given, errors)
    assert np.allclose(q, [plain_posterior(model, v, g, errors) for v, g in zip(votes, given)])
    own = ~np.isnan(given)
    assert np.mean((q[own] > 0.5) == y[own]) > np.mean((given[own] > 0.5) == y[own])
    assert np.allclose(model.posterior(votes, np.full(len(y), np.nan), errors), model.posterior(votes))
