"""Small tables with every awkward case, and brute-force versions."""
from __future__ import annotations

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int) -> str:
    syllables = "an be co do er fi ga hu in jo ka lo mi no or pe qui ra su ti".split()
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))


def awkward_documents(spark, extra: bool = True):
    """Null texts and ids, empty, blank and very long texts, repeated rows, and
    columns whose names the operators use inside."""
    rng = random.Random(5)
    base = [prose(rng, 60) for _ in range(4)]
    rows = [(0, base[0]), (1, base[0]), (1, base[0]), (2, base[1]), (3, base[1] + " one more"), (4, None), (5, ""), (6, " \n\t "),
            (7, prose(rng, 30_000)), (None, base[2]), (8, base[2]), (9, "a"), (10, "a"), (11, "a b"), (12, "x" * 5000),
            (2, base[3]), (13, "日本語 テスト ▁ \x00 \U0001F600  two  spaces\r\nline")]
    rows = [(d, t, "en", "s", len(t or "")) for d, t in rows]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        for name in ("rank", "rep", "key", "size", "id", "v", "n", "score", "ids", "component", "n_removed", "kept", "y", "key_text", "cut", "__key", "__k", "__t", "__score"):
            df = df.selectExpr("*", f"'clash' AS {name}")
    return df


def words(text) -> list[bytes]:
    low = re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode())
    return re.findall(rb"[^\x20\x09-\x0d]+", low)


def shingle_set(text, width: int) -> frozenset:
    ws = words(text)
    n = min(width, len(ws))
    return frozenset(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)) if n else frozenset()


def least_reachable(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
