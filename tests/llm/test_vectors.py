"""Top-k search and embedding near-dedup against brute force."""
from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from helpers import least_reachable
from shardlake.llm import pq_dedup, topk

VECTORS = "vec_id long, embedding array<float>, label int, id string, v string, kind string, list string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "c", "c", "c", "c") for i, v in rows], VECTORS)


def clustered(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    x = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, dim)) * rng.choice([0.05, 0.2, 0.6], size=(n, 1))
    x[: n // 3] = x[0]  # a third of the rows are one vector
    return [(int(i), [float(c) for c in row.astype(np.float32)]) for i, row in enumerate(x)]


AWKWARD = [(1000, None), (1050, []), (1100, [1.0, None, 2.0]), (1150, [float("nan"), 1.0, 2.0]), (1200, [float("inf"), 0.0, 0.0]),
           (None, [1.0, 2.0, 3.0]), (1250, [0.0, 0.0, 0.0]), (1300, [1.0, 2.0]), (1350, [1.0, 2.0])]


def brute_top(rows, every, k):
    best = {}
    for i, v in rows:
        if i is None or not v or any(c is None or not math.isfinite(c) for c in v):
            continue
        best[i] = min(best[i], v) if i in best else v
    q = {i: [math.floor(256 * Fraction(c)) for c in v] for i, v in best.items()}
    out = set()
    for i in q:
        if i % every == 0:
            most = 2 ** 63 - 1
            scores = sorted((-max(-most, min(most, sum(a * b for a, b in zip(q[i], q[j])))), j) for j in q if j != i and len(q[j]) == len(q[i]))
            out.update((i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k]))
    return out


@pytest.mark.parametrize("shard_rows", [10_000, 40])
def test_top_k(spark, shard_rows):
    rows = clustered(400, 6, 1) + [(i, v) for i, v in AWKWARD] + clustered(400, 6, 1)[:20] + [(50, [9.0] * 6)]
    got = topk.top_k(table(spark, rows), every=50, k=5, shard_rows=shard_rows)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute_top(rows, 50, 5))


def test_top_k_few_rows(spark):
    assert topk.top_k(table(spark, []), every=50).count() == 0
    assert topk.top_k(table(spark, [(0, [1.0, 2.0])]), every=50).count() == 0
    got = topk.top_k(table(spark, [(0, [1.0]), (50, [-1.0]), (7, [1.0])]), every=50)
    assert sorted(tuple(r) for r in got.collect()) == [(0, 1, 7, 65536), (0, 2, 50, -65536), (50, 1, 0, -65536), (50, 2, 7, -65536)]


def test_large_components_stay_exact(spark):
    """Every finite vector takes part; a score beyond a long counts as the nearest."""
    rows = [(0, [500_000.0, 3.0]), (1, [400_000.0, 1.0]), (2, [400_000.0, 2.0]), (3, [1e30, 1.0]), (4, [-3e38, 1.0]), (50, [1e6, 1.0]), (100, [2.0, 1.0]),
            (7, [1.0, 3.0])]
    got = {tuple(r) for r in topk.top_k(table(spark, rows), every=50).collect()}
    assert got == brute_top([(i, [float(np.float32(c)) for c in v]) for i, v in rows], 50, 5)


def test_components_beyond_a_double_once_scaled(spark):
    """256 x is beyond a double: exact integers all the same."""
    rows = [(0, [1.0, 1e308]), (1, [5.0, -1e-300]), (2, [-4.0, 1e-306]), (3, [0.25, 1.5e308]), (50, [-1e308, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in topk.top_k(df, every=50).collect()} == brute_top(rows, 50, 5)


@pytest.mark.parametrize("shard_rows", [40, 1000])
def test_mixed_magnitudes(spark, shard_rows):
    """64 dimensions, queries far larger than candidates, several shards and batches."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        size = 2.0 ** (18.9 if i % 50 == 0 else rng.choice([3, 10, 15]))
        rows.append((i, [float(np.float32(c)) for c in rng.uniform(-size, size, 64)]))
    got = {tuple(r) for r in topk.top_k(table(spark, rows), every=50, shard_rows=shard_rows).collect()}
    assert got == brute_top(rows, 50, 5)


def test_near_duplicates(spark):
    rows = clustered(500, 8, 2) + AWKWARD
    got = pq_dedup.near_duplicates(table(spark, rows)).collect()
    fine = {i: np.array(v) for i, v in rows
            if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)}
    links = {(i, j) for i in fine for j in fine if i < j and len(fine[i]) == len(fine[j])
             and fine[i] @ fine[j] / np.sqrt((fine[i] @ fine[i]) * (fine[j] @ fine[j])) >= 0.9}
    found = {r["vec_id"]: r for r in got}
    assert len(got) == len(rows)
    want = least_reachable(found.keys() - {None}, links)
    total = {i: sum(i in p for p in links) for i in fine}
    assert sum(r["n_links"] for r in got) >= 0.9 * 2 * len(links)
    assert all(found[i]["n_links"] <= total.get(i, 0) for i in want)
    same = sum(found[i]["component_id"] == c for i, c in want.items())
    assert same >= 0.98 * len(want)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got if r["vec_id"] is not None)
    assert found[1250]["n_links"] == 0 and found[1300]["component_id"] == 1300 and found[1350]["component_id"] == 1300


def test_no_vectors(spark):
    assert pq_dedup.near_duplicates(table(spark, [])).count() == 0
    got = pq_dedup.near_duplicates(table(spark, [(3, [1.0, 0.0]), (4, None)])).collect()
    assert sorted(tuple(r) for r in got) == [(3, 0, 3, True), (4, 0, 4, True)]


def test_codes_lose_no_link():
    rng = random.Random(3)
    x = np.array([[rng.gauss(0, 1) for _ in range(8)] for _ in range(300)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    model = pq_dedup.Quantiser.fit(x[:100], 5)
    own = pq_dedup.nearest(x, model.centres, 1)[:, 0]
    codes, left = model.encode(x, own)
    for c in range(5):
        mine = own == c
        bound = model.products(x, c, codes[mine]) + left[mine]
        assert (bound >= x @ x[mine].T - 1e-9).all()
