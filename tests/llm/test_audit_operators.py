"""Feistel shards, filter interaction audit and periodic runs against brute force."""
from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import DOCS, awkward_documents
from shardlake.llm import feistel, filter_audit, periodic_runs, queries
from shardlake.llm.common import free_name

SF = "/root/testdata/sf0.001"


def clashing(docs):
    """``docs`` with columns called like those that these operators use inside."""
    for name in ("shard", "slot", "stamp", "task", "shift", "place", "rid", "part", "digest", "words", "good", "toxic", "prefix",
                 "filter", "id", "runs", "collapsed"):
        if name not in docs.columns:
            docs = docs.selectExpr("*", f"'clash' AS {name}")
    return docs


# ---- Feistel shards

@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 39, 40, 41, 1000, 4097])
def test_permutation(n):
    """A permutation with its inverse, the same for a seed and others for others."""
    p = feistel.Permutation(n, 7)
    places = p.place(np.arange(n))
    assert sorted(places.tolist()) == list(range(n))
    assert (p.row(places) == np.arange(n)).all()
    assert n < 39 or (feistel.Permutation(n, 8).place(np.arange(n)) != places).any()


def test_permutation_mixes():
    """Neighbours part: over 40 shards, pairs of neighbours fall as by chance."""
    n = 200_000
    places = feistel.Permutation(n, 3).place(np.arange(n))
    shard = places % 40
    same = float((shard[1:] == shard[:-1]).mean())
    assert abs(same - 1 / 40) < 0.003
    blocks = np.array([Counter((shard[a : a + 20_000]).tolist())[0] for a in range(0, n, 20_000)])
    assert abs(blocks - 500).max() < 120
    assert abs(np.corrcoef(np.arange(n), places)[0, 1]) < 0.02


def test_large_numbers():
    p = feistel.Permutation(10 ** 12 + 7, 5)
    rows = np.array([0, 1, 10 ** 12 + 6, 123_456_789_012])
    assert (p.row(p.place(rows)) == rows).all() and p.place(rows).max() < 10 ** 12 + 7
    shard, slot = feistel.slot_of(123, 1000)
    assert feistel.row_of(shard, slot, 1000) == 123


def brute_shards(rows, shards, seed):
    """Place by a plain loop over Python integers."""
    n = len(rows)
    bits = max(2, (n - 1).bit_length())
    lb, rb = bits // 2, bits - bits // 2

    def once(x):
        left, right = x >> rb, x & ((1 << rb) - 1)
        for r, key in enumerate(feistel.round_keys(seed)):
            half, size = (left, rb) if r % 2 else (right, lb)
            y = (half * 1_664_525 + key) % (2 ** 31 - 1)
            y = (y ^ (y >> 15)) * 1_103_515_245 % (2 ** 31 - 1) & ((1 << size) - 1)
            left, right = (left, right ^ y) if r % 2 else (left ^ y, right)
        return left << rb | right

    out = []
    for i, row in enumerate(sorted(rows, key=lambda r: (r[0] is not None, *[x or 0 for x in r]))):
        x = once(i)
        while x >= n:
            x = once(x)
        out.append((*row, x % shards, x // shards))
    return sorted(out, key=str)


def test_shards_against_brute_force(spark):
    docs = clashing(awkward_documents(spark))
    got = feistel.shuffle(feistel.document_digest(docs), ["doc_id", "size", "text_crc32", "text_hash"], 4, 9).collect()
    rows = [(r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in docs.collect()]
    assert sorted([(r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in got], key=str) == brute_shards(rows, 4, 9)
    sizes = Counter(r["shard"] for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    slots = defaultdict(set)
    for r in got:
        slots[r["shard"]].add(r["slot"])
    assert all(s == set(range(len(s))) for s in slots.values())


def test_shards_do_not_depend_on_the_input_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    order = ["doc_id", "size", "text_crc32", "text_hash"]
    first = feistel.shuffle(feistel.document_digest(docs), order).select(*order, "row", "shard", "slot").collect()
    other = feistel.shuffle(feistel.document_digest(docs.repartition(7, F.rand(1))), order).select(*order, "row", "shard", "slot").collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, other))


def test_one_key_many_rows(spark):
    """A row that is most of the table is numbered in several tasks."""
    one = spark.range(30_000).select(F.lit(5).cast("long").alias("doc_id"))
    rows, n = feistel.numbered(one.union(spark.range(4)), ["doc_id"])
    assert n == 30_004 and sorted(r["row"] for r in rows.collect()) == list(range(n))
    first, last = rows.filter("doc_id = 5").agg(F.min("row"), F.max("row")).first()
    assert (first, last) == (4, 30_003)


def test_write_shards(spark, scratch):
    """Whole rows in files, in slot order; columns with the new names are replaced."""
    docs = clashing(awkward_documents(spark))
    feistel.write_shards(docs.withColumn("h", F.xxhash64("text")), ["doc_id", "h"], f"{scratch}/shards", 3)
    back = spark.read.parquet(f"{scratch}/shards")
    assert Counter(r["text"] for r in back.collect()) == Counter(r["text"] for r in docs.collect())
    assert back.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m")).filter("n <> m + 1").count() == 0


def test_no_rows_no_shards(spark):
    none = spark.createDataFrame([], DOCS)
    assert feistel.shuffle(feistel.document_digest(none), ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        feistel.shuffle(none, ["doc_id"], 0)


def test_free_name():
    assert free_name(["a", "TASK", "task_1"], "task") == "task_2" and free_name([], "x") == "x"


# ---- filter interaction audit

def brute_audit(rows, labels, orders):
    """rows: (doc_id, text, source); every order step by step over all rows."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    judged = []
    for i, t, s in rows:
        t = t or ""
        ws = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        fails = {"A"} if len(ws) < 200 else set()
        fails |= {"B"} if 100 * len(set(ws)) < 50 * len(ws) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t) else set()
        fails |= {"D"} if re.search("[#$%&*|]", t) else set()
        fails |= {"E"} if i is not None and first[t] < i else set()
        judged.append((s or "", fails, i in good, i in toxic))
    out, shapley = [], Counter()
    for part in {j[0] for j in judged}:
        own = [j for j in judged if j[0] == part]
        for o in orders:
            alive = own
            for step, f in enumerate(o, 1):
                gone = [j for j in alive if f in j[1]]
                alive = [j for j in alive if f not in j[1]]
                all_f = sum(f in j[1] for j in own)
                out.append((part, o, step, f, len(alive), len(gone), all_f - len(gone), sum(j[1] == {f} for j in own),
                            sum(j[2] for j in gone), sum(j[3] for j in gone)))
                shapley[part, f] += len(gone)
    return sorted((*r, shapley[r[0], r[3]]) for r in out)


def audit_tables(spark):
    rng = random.Random(4)
    words = "alpha beta gamma delta Epsilon ZETA eta theta # $5 iota kappa".split()
    texts = [" ".join(rng.choices(words[: rng.choice([2, 6, 12])], k=rng.choice([0, 3, 150, 260]))) for _ in range(25)]
    texts += [" ".join(f"w{rng.randrange(900)}" for _ in range(300)) for _ in range(10)] + [None, "", " \n"]
    rows = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice(["web", "web", "web", None, "", "Books"])) for _ in range(160)]
    labels = [(rng.choice([None, *range(60)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(70)]
    docs = spark.createDataFrame(rows + rows[:5], "doc_id long, text string, source string")
    return rows + rows[:5], labels, docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_audit_against_brute_force(spark):
    rows, labels, docs, label_table = audit_tables(spark)
    got = sorted(map(tuple, filter_audit.audit(clashing(docs).withColumn("source", docs.source), label_table).collect()))
    assert got == brute_audit(rows, labels, ["".join(o) for o in permutations("ABCDE")])


def test_audit_of_listed_orders_and_hot_copies(spark):
    """Two orders only; one text is most of the table (the broadcast way), one is not."""
    rows = [(i, "the same text", "web") for i in range(3000)] + [(i, f"text {i // 2}", "web") for i in range(3000, 3100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = [(i, i % 2, 1) for i in range(40)]
    got = filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), orders=["EDCBA", "ABCDE"]).collect()
    assert sorted(map(tuple, got)) == brute_audit(rows, labels, ["EDCBA", "ABCDE"])
    with pytest.raises(ValueError):
        filter_audit.audit(docs, docs, orders=["AB"])


def test_audit_leaves_no_tables(spark):
    rows, labels, docs, label_table = audit_tables(spark)
    assert filter_audit.audit(docs.limit(0), label_table.limit(0)).count() == 0
    assert not [t for t in spark.catalog.listTables() if "audit" in t.name]
    awkward = filter_audit.audit(awkward_documents(spark), label_table)
    assert awkward.count() == 600 and awkward.filter("step = 5").select("kept").distinct().count() == 1


def test_audit_joins_move_no_rows(spark, monkeypatch):
    """The joins with the id tables read buckets; rows are exchanged for counts only."""
    plans = []
    stored = filter_audit._BucketTables.store

    def store(self, rows, apart=False):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return stored(self, rows, apart)

    monkeypatch.setattr(filter_audit._BucketTables, "store", store)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, _, docs, labels = audit_tables(spark)
        filter_audit.audit(docs, labels)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [p for p in plans if "LeftAnti" in p and "rid" in p][-5:]
    assert joins and all("Exchange hashpartitioning(rid" not in p for p in joins)


# ---- periodic runs

def brute_runs(ws, periods=4, least=6):
    """Every stretch for every distance; a smaller distance wins."""
    n, out = len(ws), []
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            if ws[i] != ws[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and ws[j] == ws[j + q]:
                j += 1
            size = j + q - i
            if size >= max(least, periods * q) and not any(
                    all(ws[x] == ws[x + r] for x in range(i, j + q - r)) for r in range(1, q)):
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(ws, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(ws) if i not in gone)


def run_texts():
    rng = random.Random(1)
    out = []
    for _ in range(500):
        ws = [rng.choice("abcdefgh"[: rng.choice([1, 2, 2, 3, 5])]) for _ in range(rng.randint(0, 70))]
        if rng.random() < 0.6 and ws:
            p, a = rng.randint(1, 9), rng.randrange(len(ws))
            ws = [ws[a + (i - a) % min(p, len(ws) - a)] if i >= a else ws[i] for i in range(len(ws) + rng.randint(0, 20))]
        out.append(ws + rng.choice([[], ["x"], ["a", "b"]]))
    return out


def test_runs_against_brute_force():
    texts = run_texts()
    runs, kept = periodic_runs.runs_of_texts([" ".join(t).encode() for t in texts])
    total = 0
    for ws, r, k in zip(texts, runs, kept):
        want = brute_runs(ws)
        assert [tuple(x) for x in r.tolist()] == want
        assert k.decode() == collapse(ws, want)
        total += len(want)
    assert total > 200


@pytest.mark.parametrize("together", [1, 50])
def test_documents_apart(monkeypatch, together):
    """The result does not depend on which documents are looked at together."""
    texts = [" ".join(t).encode() for t in run_texts()]
    want = periodic_runs.runs_of_texts(texts)
    monkeypatch.setattr(periodic_runs, "WORDS_TOGETHER", together)
    got = periodic_runs.runs_of_texts(texts)
    assert got[1] == want[1] and all((a == b).all() for a, b in zip(got[0], want[0]))


def test_long_texts():
    """One word 200,000 times; a period of 30,000 words; no repeat at all."""
    runs, kept = periodic_runs.runs_of_texts([b"w " * 200_000, b" ".join(b"%d" % (i % 30_000) for i in range(130_000)),
                                              b" ".join(b"%d" % i for i in range(50_000))])
    assert [r.tolist() for r in runs] == [[[0, 200_000, 1]], [[0, 130_000, 30_000]], []]
    assert kept[0] == b"w" and len(kept[1].split()) == 30_000 and len(kept[2].split()) == 50_000


def test_fibonacci_and_squares():
    """Words with many overlapping runs of small exponents: none has four periods."""
    a, b = "a", "ab"
    while len(b) < 400:
        a, b = b, b + a
    runs, _ = periodic_runs.runs_of_texts([" ".join(b).encode(), b"a b a b a b", b"a b a b a b a b"])
    assert [tuple(x) for x in runs[0].tolist()] == brute_runs(list(b)) and len(runs[1]) == 0 and runs[2].tolist() == [[0, 8, 2]]


def test_find_runs_on_awkward_rows(spark):
    docs = clashing(awkward_documents(spark)).drop("words")
    got = periodic_runs.find_runs(docs)
    rows = got.collect()
    assert len(rows) == 17 and Counter(r["doc_id"] for r in rows)[1] == 2 and all(r["shard"] == "clash" for r in rows)
    assert {r["collapsed"] for r in rows if r["doc_id"] in (4, 5, 6)} == {""}
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(docs, min_periods=3)


def test_query_of_runs(spark):
    """The registered query against brute force, its input included."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.QUERIES["op13_periodic_runs"](spark, SF).collect()}
    found = 0
    for i, text in docs.select("doc_id", "text").collect():
        ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(ws), zlib.crc32(str(i).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            ws = [w if j < a else ws[a + (j - a) % p] for j, w in enumerate(ws)]
        runs = brute_runs(ws)
        top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        r = got.pop(i)
        assert r["n_runs"] == len(runs) and (r["start"], r["length"], r["period"]) == top
        assert r["exponent_milli"] == (1000 * top[1] // top[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{x},{q}\n" for s, x, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapse(ws, runs).encode()).hexdigest()
        found += bool(runs)
    assert not got and found > 5


def test_ties_of_the_strongest_run(spark):
    """Equal ratios: the first start; a ratio that differs beyond double precision counts."""
    runs = spark.createDataFrame([([(0, 8, 2), (9, 4, 1)],), ([(3, 4_000_000_000_000_001, 1_000_000_000_000_000), (5, 4, 1)],), ([],)],
                                 "runs array<struct<start: long, length: long, period: long>>")
    got = [r[0] and tuple(r[0]) for r in runs.filter("size(runs) < 3").select(periodic_runs.strongest(F.col("runs"))).collect()]
    assert got[0] == (0, 8, 2) and got[2] is None and got[1][0] == 3
