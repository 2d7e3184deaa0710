"""Licence scan, url filter, codec, packing, line dedup and n-gram join."""
from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import DOCS, awkward_documents, least_reachable, shingle_set
from shardlake.llm import bpe, licenses, line_dedup, ngram_join, packing, shingles, sp_codec, url_filter

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS)


# ---- licence scan

def test_licences(spark):
    texts = ["Some prose that goes on for a while.\nLicensed under CC BY-NC 4.0.\nAnd some more", "ALL RIGHTS RESERVED", "This is licensed under the MIT license, I think, or not",
             "prose\n\nreleased under the mit license\n\nAll rights reserved.", None, "", "license", "All rights reserved.\nAll rights reserved."]
    got = {r["doc_id"]: r for r in licenses.scan(docs_of(spark, texts)).collect()}
    assert [got[i]["license"] for i in range(8)] == ["CC-BY-NC-4.0", "proprietary", None, "MIT", None, None, None, "proprietary"]
    assert [got[i]["n_hits"] for i in range(8)] == [1, 1, 0, 2, 0, 0, 0, 2]
    assert got[3]["licenses"] == "MIT,proprietary" and got[0]["dice"] == 1.0
    assert licenses.scan(awkward_documents(spark)).count() == 17
    assert licenses.scan(docs_of(spark, [])).count() == 0


def test_licence_bounds_lose_nothing():
    words = licenses.anchors(licenses.TEMPLATES, licenses.THRESHOLD)
    for _, text in licenses.TEMPLATES:
        grams = licenses.template_bigrams(text)
        bare = [g for g in grams if not any(a in w for a in words for w in g.split())]
        # a unit without an anchor can only share the uncovered bigrams
        assert len(bare) < licenses.size_bounds(len(grams), licenses.THRESHOLD)[0]


def test_licence_notices(spark):
    """Notices as real files carry them, one paragraph each."""
    texts = {
        "GPL-3.0": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as "
                   "published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
        "GPL-2.0": "Foo is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
                   "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "LGPL-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                    "License as published by the Free Software Foundation; either version 2.1 of the License, or any later version.",
        "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the "
                        "following conditions are met:\n* Redistributions of source code must retain the above copyright notice, this list of "
                        "conditions and the following disclaimer.\n* Redistributions in binary form must reproduce the above copyright notice, "
                        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
                        "distribution.\n* Neither the name of Foo Inc. nor the names of its contributors may be used to endorse or promote "
                        "products derived from this software without specific prior written permission.",
        "ISC": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided "
               "that the above copyright notice and this permission notice appear in all copies.",
    }
    docs = docs_of(spark, [f"some prose\n\n{t}\n\nmore" for t in texts.values()])
    got = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    assert [got[i]["license"] for i in range(len(texts))] == list(texts)
    assert all(r["dice"] >= 0.8 and r["n_hits"] == 1 and r["licenses"] == r["license"] for r in got.values())


def test_licences_inside_lines_and_wrapped(spark):
    bsd = dict(licenses.NOTICES)["BSD-3-Clause"].split()
    wrapped = [" ".join(bsd[i : i + 11]) for i in range(0, len(bsd), 11)]
    gpl = dict(licenses.NOTICES)["GPL-3.0"].split()
    cases = [
        ("Copyright (c) 2020 Example Inc. All rights reserved.", "proprietary"),
        ("Thanks for reading this post. Licensed under CC BY-NC 4.0. See you next week.", "CC-BY-NC-4.0"),
        ("Except where otherwise noted, content on this site is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"),
        ("/*\n * a tool for trees\n *\n * " + "\n * ".join(wrapped) + "\n *\n * and more\n */\nint main() {}", "BSD-3-Clause"),
        ("# a tool\n#\n# " + " ".join(gpl[:20]) + "\n# " + " ".join(gpl[20:]) + "\n#\n# import os", "GPL-3.0"),
        ("intro\n\n" + "\n\n".join(wrapped), "BSD-3-Clause"),
        ("The code is released under the MIT License and its texts are licensed under CC BY-SA 4.0, all rights reserved.", "CC-BY-SA-4.0,MIT,proprietary"),
        ("All rights reserved.\nprose in between, and all rights reserved.", "proprietary"),
        ("released under licence by the mit, all of the rights", None), ("x" * 3000 + " license " + "software of the public " * 2000, None),
    ]
    got = {r["doc_id"]: r for r in licenses.scan(docs_of(spark, [t for t, _ in cases])).collect()}
    assert [got[i]["licenses"] for i in range(len(cases))] == [n for _, n in cases]
    assert [got[i]["n_hits"] for i in range(len(cases))] == [1, 1, 1, 1, 1, 1, 3, 1, 0, 0]


# ---- url filter

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def test_urls(spark):
    urls = {"http://Example.COM/en/x?q": ("example.com", "/en/x", "example.com/en/", "block"),
            "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
            "https://a.www.example.com/en/#f": ("a.www.example.com", "/en/", "www.example.com/en/", "allow"),
            "x://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
            "http://a.net/es": ("a.net", "/es", None, "allow"), "http://net/fr/a": ("net", "/fr/a", "net/fr/", "block"),
            "http://example.com": ("example.com", "", None, "allow"), "http://example.com?x=/en/": ("example.com", "", None, "allow"),
            "example.com/en/": ("", "", None, "allow"), "": ("", "", None, "allow"), "://": ("", "", None, "allow"),
            "a://b.com:80/en/": ("b.com:80", "/en/", None, "allow"), "http://x.com/\nY": ("x.com", "/\nY", "com/", "allow"),
            "http://" + "a." * 20_000 + "com/en/": ("a." * 20_000 + "com", "/en/", "com/", "allow")}
    rows = [(i, u, "h") for i, u in enumerate(urls)] + [(90, None, "h"), (91, "http://a.com/", "h"), (91, "http://a.com/", "h")]
    got = url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, host string"), RULES).collect()
    assert len(got) == len(rows)
    assert [tuple(r)[1:] for r in sorted(got, key=lambda r: r["page_id"])][: len(urls)] == list(urls.values())
    assert sum(r["page_id"] == 91 and r["rule"] == "com/" for r in got) == 2
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string"), RULES).count() == 0


def test_colliding_digests(tmp_path):
    same = lambda raw: 7
    path = tmp_path / "rules"
    path.write_bytes(url_filter.pack_rules(RULES, same))
    index = url_filter.RuleIndex(str(path), same)
    assert index.judge(["www.example.com", "example.com", "b.org"], ["/en/", "/en/", "/"], "allow") == (
        ["www.example.com/en/", "example.com/en/", None], ["allow", "block", "allow"])


def test_no_rules(tmp_path):
    path = tmp_path / "rules"
    path.write_bytes(url_filter.pack_rules([]))
    assert url_filter.RuleIndex(str(path)).judge(["a.com"], ["/"], "block") == ([None], ["block"])


# ---- SentencePiece codec

def test_codec_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(
        awkward_documents(spark).select("doc_id", "text"))
    plain = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    seen = []
    for rate, seed in ((0.0, 1), (0.1, 1), (0.1, 1), (0.1, 2), (1.0, 1)):
        got = sp_codec.encode(docs.withColumn("original", F.col("text")), PIECES, seed=seed, rate=rate)
        back = sp_codec.decode(got.withColumn("kept", F.col("ids")), PIECES).collect()
        assert all(r["text"] == r["original"] for r in back)
        if rate == 0:
            assert all(r["kept"] == plain.encode(r["original"]) for r in back if r["original"] and "▁" not in r["original"])
        seen.append(Counter(tuple(r["kept"] or ()) for r in back))
    assert seen[1] == seen[2] and seen[1] != seen[3] and seen[1] != seen[0]
    assert sp_codec.encode(docs_of(spark, []), PIECES, seed=1).count() == 0


def test_every_occurrence_is_cut_by_itself(spark):
    word, n = "international", 400
    docs = docs_of(spark, [" ".join([word] * 100)] * (n // 100) + ["xyz" * 300])
    ids = {r["doc_id"]: r["ids"] for r in sp_codec.encode(docs, PIECES, seed=3, rate=0.5).collect()}
    model = sp_codec.PieceModel(PIECES)
    cuts = Counter()
    for d in range(n // 100):
        text, cut = "", ()
        for i in ids[d]:
            piece = model.bytes_of[i].decode()
            if piece.startswith(" ") and cut:
                cuts[cut], cut = cuts[cut] + 1, ()
            cut += (piece,)
        cuts[cut] += 1
    assert sum(cuts.values()) == n and len(cuts) > 20 and max(cuts.values()) < n // 2
    assert all("".join(c) == f" {word}" for c in cuts)
    # a long chunk: the same pair is merged at some places and skipped at others
    plain = sentencepiece.SentencePieceProcessor(model_file=PIECES).encode("xyz" * 300)
    assert len(set(ids[n // 100])) > len(set(plain)) and len(ids[n // 100]) < 900


def test_remembered_candidates_lose_no_skip(spark):
    """The ids equal those of every chunk segmented with its own key."""
    texts = [r["text"].encode() for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()] + ["a ▁▁b ▁".encode(), b""]
    coder = sp_codec.Encoder(PIECES, 7, 0.1)
    got = [coder.encode(list(range(len(texts))), texts) for _ in range(2)]
    coder._skips = lambda number, keys: np.ones(len(number), dtype=bool)
    want = coder.encode(list(range(len(texts))), texts)
    assert all((g[0].tolist(), g[1].tolist()) == (want[0].tolist(), want[1].tolist()) for g in got)


def naive_ids(model, chunk: str, key: int, limit: int) -> list[int]:
    """A chunk by the plainest agenda: of all adjacent pairs that merge and are
    not skipped, the best ranked, leftmost one merges, until none is left."""
    marked = chunk.replace(" ", sp_codec.SPACE)
    parts = [(i, int(model.char_symbol[ord(c)]), c) for i, c in enumerate(marked)]
    while True:
        best = None
        for j, ((i, a, _), (_, b, _)) in enumerate(zip(parts, parts[1:])):
            got = model.merges.pairs.get((a, b))
            if got and bpe.coin(key, bpe.candidate(i, a, b)) >= limit and (best is None or got[0] < best[0]):
                best = (got[0], j, got[1])
        if best is None:
            break
        _, j, new = best
        parts[j : j + 2] = [(parts[j][0], new, parts[j][2] + parts[j + 1][2])]
    out = []
    for _, symbol, text in parts:
        out += [symbol] if 0 <= symbol < len(model.bytes_of) else [model.byte_id[b] for b in text.encode()]
    return out


@pytest.mark.parametrize("seen, rate", [((1, 1, 1, 1, 1, 1), 0.3), ((1, 2), 0.1), ((16, 128, 1024), 0.1), ((), 0.2)])
def test_dropout_equals_a_naive_agenda(spark, monkeypatch, seen, rate):
    """Whatever a worker remembers, on a second pass as on the first."""
    monkeypatch.setattr(sp_codec, "SEEN", seen)
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(12).collect()]
    texts += ["the the  the\nthe\n\n the", "日本語 テスト x" * 3, "a" * 150, "", "ab " * 300]
    encoder = sp_codec.Encoder(PIECES, 11, rate)
    limit, mark = encoder.limit, sp_codec.STEP
    want = []
    for d, t in enumerate(texts):
        own = bpe.mixed((d * mark + 11) & bpe.MASK)
        chunks = re.findall(r" +[^ \n]*|[^ \n]+|\n", " " + t) if t else []
        want.append([i for k, c in enumerate(chunks) for i in naive_ids(encoder.model, c, bpe.mixed((own + k * mark) & bpe.MASK), limit)])
    for _ in range(2):
        ids, ends = encoder.encode(list(range(len(texts))), [t.encode() for t in texts])
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == want
    assert (encoder.outcomes.nodes.count > 0) == bool(seen)


def test_only_merges_that_are_made_are_tossed_for(spark, monkeypatch):
    """A candidate that no merge was made of changes nothing if it is skipped:
    it costs no toss, and an occurrence that skips only such ones is plain."""
    texts = [r["text"].encode() for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()]
    encoder, learned = sp_codec.Encoder(PIECES, 5, 0.1), []
    segment = encoder.model.segment

    def noted(chunks, keys, limit=0, trace=None, skips=None):
        learned.extend(chunks if not limit and skips is None else [])
        return segment(chunks, keys, limit, trace, skips)

    monkeypatch.setattr(encoder.model, "segment", noted)
    encoder.encode(list(range(len(texts))), texts)
    tosses, ids = encoder.plain.take(np.arange(len(learned)))[1], encoder.coder.size[: len(learned)]
    ascii_ = [i for i, c in enumerate(learned) if c.isascii()]
    assert len(ascii_) > 500 and all(tosses[i] == len(learned[i]) - ids[i] for i in ascii_)


def test_rounds_equal_the_agenda():
    model = sp_codec.PieceModel(PIECES)
    chunks = ["▁the", "▁international", "abababababab", "▁▁▁▁▁x", "éàü", "m" * 200, "a"]
    keys = np.arange(1, len(chunks) + 1, dtype=np.uint64) * np.uint64(977)
    points, sizes = bpe.code_points(chunks)
    first = model.char_symbol[points]
    for limit in (0, 2 ** 62, 2 ** 63):
        got = model.merges.many(first, sizes, keys, limit)
        ends = np.cumsum(sizes)
        for i, raw in enumerate(got):
            own = first[ends[i] - sizes[i] : ends[i]].tolist()
            assert np.frombuffer(raw, dtype="<i4").tolist() == model.merges.one(own, int(keys[i]), limit)


# ---- packing

def unpacked(rows, window=2048):
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[(r["doc_id"], r["doc_tokens"])].append((r["start"], r["length"], r["ids_crc32"]))
    padding = 0
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at and length > 0
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return pieces, padding


def test_pack(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = Tokenizer.from_file(WORDS)
    pieces, padding = unpacked(packing.pack(docs, WORDS).collect())
    assert padding == 0
    for r in docs.collect():
        ids = np.array(model.encode(r["text"], add_special_tokens=False).ids + [1], dtype="<u4").tobytes()
        at = 0
        for start, length, crc in sorted(pieces.pop((r["doc_id"], len(ids) // 4))):
            assert start == at and crc == zlib.crc32(ids[4 * start : 4 * (start + length)])
            at += length
        assert 4 * at == len(ids)
    assert not pieces


def test_pack_awkward(spark):
    rows = packing.pack(awkward_documents(spark), WORDS).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] in (4, 5, 6)) == 3
    assert sum(r["length"] == r["doc_tokens"] for r in rows if r["doc_id"] == 1) <= 2
    assert any(r["doc_id"] is None for r in rows)
    assert packing.pack(docs_of(spark, []), WORDS).count() == 0


def test_tokenizer_equals_the_library():
    own, lib = packing.WordTokenizer(WORDS), Tokenizer.from_file(WORDS)
    texts = ["", "a  b\t c\x0bd\x1ce", "<|endoftext|> x<|endoftext|>y", "é ́x Σας ΟΔΟΣ İ", "it's we'll 123 !!!", "日本 \U0001F600", "a" * 3000,
             "\xadx\xa0y Ǆ ŉ ß ſ ½ ² ª <|x|>", "\n", "\n \n a"]
    for text, ids in zip(texts, own.encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, dtype="<u4").tolist() == lib.encode(text, add_special_tokens=False).ids


def test_level_choice_is_the_sum_of_squares():
    rng = np.random.default_rng(4)
    p = packing.Packer(32, 0)
    for i, size in enumerate(rng.integers(1, 32, 400)):
        size = int(size)
        options = {}
        for level in range(0, 33 - size):
            if level and not p.count[level]:
                continue
            after = p.count.copy()
            if level:
                after[level] -= 1
            if level + size < 32:
                after[level + size] += 1
            options[level] = int((after * after).sum())
        assert options[p.level_for(size)] == min(options.values())
        p.place((i, 0, bytes(4 * size), size))


# ---- line dedup

def brute_lines(rows, least):
    """Deleted lines: in any run of at least ``least`` words with an earlier copy."""
    first, gone = {}, defaultdict(set)
    for d, t in rows:
        lines = [x for x in (t or "").split("\n") if x.strip()]
        for i in range(len(lines)):
            n = 0
            for e in range(i, min(len(lines), i + 2 * least)):
                n += len(lines[e].split())
                if n >= least and first.setdefault(tuple(lines[i : e + 1]), (d, i)) != (d, i):
                    gone[d].update(range(i, e + 1))
    return {d: len(gone[d]) for d, _ in rows}


@pytest.mark.parametrize("least", [3, 8, 40])
def test_line_dedup(spark, least):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = sorted(tuple(r) for r in docs.collect())
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs, least).collect()}
    want = brute_lines(rows, least)
    assert {d: r["n_removed"] for d, r in got.items()} == want
    assert all(got[d]["text"] == t for d, t in rows if not want[d])


def test_line_dedup_cases(spark):
    long, other = "one two three four five six seven eight", "uno dos tres cuatro cinco seis siete ocho"
    texts = [f"{long}\n\nshort\n{other}", f"x\n{long}\n\nshort\n{other}\ny", f"{long}", f"{other}\n{other}", "short", None, "", f"z\n{long[:-6]}"]
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs_of(spark, texts)).collect()}
    assert [got[i]["text"] for i in range(8)] == [texts[0], "x\ny", "", "", "short", None, "", texts[7]]
    assert [got[i]["emptied"] for i in range(8)] == [False, False, True, True, False, False, False, False]
    awkward = awkward_documents(spark)
    out = line_dedup.dedup_lines(awkward)
    assert set(out.columns) == {*awkward.columns, "emptied"} and out.count() == 17
    assert line_dedup.dedup_lines(docs_of(spark, [])).count() == 0


# ---- n-gram join

def brute_join(rows, width, percent):
    sets = defaultdict(set)
    for d, t in rows:
        sets[d].add(shingle_set(t, width))
    links, ids = [], list(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            if any(s and t and 100 * len(s & t) >= percent * len(s | t) for s in sets[a] for t in sets[b]):
                links.append((a, b))
    return least_reachable(ids, links)


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_ngram_join(spark, width, percent):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = ngram_join.near_duplicates(docs, width, percent).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute_join(rows, width, percent)
    assert all(r["n_shingles"] == len(shingle_set(dict(rows)[r["doc_id"]], width)) for r in got)


@pytest.mark.parametrize("per_member, block", [(8, 1024), (0, 5)])
def test_ngram_join_near_copies(spark, monkeypatch, per_member, block):
    """A chain, a star and copies on both sides of the threshold, in one tile;
    also with forests only, and tiles cut into blocks."""
    import random
    monkeypatch.setattr(ngram_join, "PAIRS_PER_MEMBER", per_member)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = random.Random(9)
    base = [f"w{rng.randrange(10 ** 9)}" for _ in range(200)]
    texts = []
    for edits in [0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12] * 6:
        ws = base[:]
        for _ in range(edits):
            ws[rng.randrange(200)] = f"n{rng.randrange(10 ** 9)}"
        texts.append(" ".join(ws))
    for k in range(0, 60, 3):
        texts.append(" ".join(base[k:] + [f"t{k}-{i}" for i in range(k)]))
    docs = docs_of(spark, texts)
    for width, percent in ((3, 90), (5, 80)):
        got = {r["doc_id"]: r["component_id"] for r in ngram_join.near_duplicates(docs, width, percent).collect()}
        assert got == brute_join(list(enumerate(texts)), width, percent)


@pytest.mark.parametrize("parts", [1, 3])
@pytest.mark.parametrize("turn", [False, True])
def test_one_id_on_two_texts_loses_no_link(spark, parts, turn):
    """Id 1 stands on texts a and b, id 2 is near a, id 3 near b, 4 equals b; also an id on equal classes of others."""
    import random
    from helpers import prose
    rng = random.Random(2)
    a, b, c = (prose(rng, 80) for _ in range(3))
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (4, b), (5, c), (5, None), (6, c + " more"), (7, prose(rng, 80)), (None, a)]
    rows = rows[::-1] if turn else rows
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS).repartition(parts)
    got = sorted(((r["doc_id"], r["component_id"]) for r in ngram_join.near_duplicates(docs).collect() if r["n_shingles"]), key=str)
    assert got == sorted([(1, 1), (1, 1), (2, 1), (3, 1), (4, 1), (5, 5), (6, 5), (7, 7), (None, 1)], key=str)


def test_ngram_join_awkward(spark):
    got = ngram_join.near_duplicates(awkward_documents(spark)).collect()
    of = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in got}
    assert len(got) == 17
    assert of[(1, 58)] == 0 and of[(3, 60)] == 2 and of[(10, 1)] == 9 and of[(11, 1)] == 11
    assert of[(None, 58)] == 8 and of[(4, 0)] == 4 and of[(5, 0)] == 5
    assert ngram_join.near_duplicates(docs_of(spark, [])).count() == 0


def test_tiles_and_bounds_lose_no_link():
    rng = np.random.default_rng(6)
    for percent in (80, 90):
        signer = shingles.Signer(percent)
        for _ in range(300):
            n = int(rng.integers(2, 400))
            a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
            lost = int(rng.integers(0, max(1, n // 5)))
            b = np.unique(np.r_[a[rng.permutation(len(a))[lost:]], rng.integers(0, 2 ** 63, int(rng.integers(0, n // 5 + 1))).astype(np.uint64)])
            same = len(np.intersect1d(a, b))
            assert shingles.overlap_bound(shingles.bitmap(a), len(a), shingles.bitmap(b), len(b)) >= same
            if 100 * same >= percent * (len(a) + len(b) - same) and same < max(len(a), len(b)):
                assert np.intersect1d(signer.keys(a), signer.keys(b)).size


def test_words_and_shingles():
    for text in ("A b\tC\x0bd e", "  x ", "", "é É x", "a b c a b c"):
        assert len(shingles.shingles(text.encode(), 3)) == len(shingle_set(text, 3))
    assert (shingles.shingles(b"One TWO three", 3) == shingles.shingles(b" one\ntwo  three ", 3)).all()
    assert shingles.shingles(b"a b", 3)[0] != shingles.shingles(b"b a", 3)[0]
