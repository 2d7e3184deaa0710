"""URL filter: rules looked up in a sorted array of 64-bit xxhash digests.

The rule list becomes one index file: the sorted digests, their rule strings
and verdicts.  It is stored in the shared folder and sent to the executors by
``SparkContext.addFile``; every Python worker memory-maps it, so a long list
costs page cache, not heap.  A url probes the index with each host suffix and
each path prefix whose size occurs among the rules, by one vectorised binary
search for a batch; the stored string must equal the probe.
"""
from __future__ import annotations

import struct
import uuid

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir

HEADER = struct.Struct("<qqq")


def pack_rules(rules: list[tuple[str, str]], digest=xxhash.xxh64_intdigest) -> bytes:
    """The index of ``(verdict, host + path)`` rules.  A rule given twice keeps
    its last verdict.  Tests replace ``digest`` to force collisions."""
    verdicts = {rule: verdict for verdict, rule in rules}
    rows = sorted((digest(rule.encode()), rule, verdict == "allow") for rule, verdict in verdicts.items())
    text = [rule.encode() for _, rule, _ in rows]
    shapes = sorted({(rule.partition("/")[0].count(".") + 1, len(rule) - len(rule.partition("/")[0])) for rule in verdicts})
    return b"".join([
        HEADER.pack(len(rows), len(shapes), sum(map(len, text))),
        np.array([k for k, _, _ in rows], dtype="<u8").tobytes(),
        np.cumsum([0, *map(len, text)]).astype("<i8").tobytes(),
        np.array(shapes, dtype="<i8").tobytes(),
        np.array([a for _, _, a in rows], dtype="u1").tobytes(),
        *text,
    ])


class RuleIndex:
    """A memory-mapped index made by ``pack_rules``."""

    def __init__(self, path: str, digest=xxhash.xxh64_intdigest):
        raw = np.memmap(path, dtype="u1", mode="r")
        n, shapes, text = HEADER.unpack(raw[: HEADER.size].tobytes())
        at = HEADER.size
        self.keys, at = raw[at : at + 8 * n].view("<u8"), at + 8 * n
        self.ends, at = raw[at : at + 8 * (n + 1)].view("<i8"), at + 8 * (n + 1)
        self.shapes, at = raw[at : at + 16 * shapes].view("<i8").reshape(-1, 2).tolist(), at + 16 * shapes
        self.allow, at = raw[at : at + n], at + n
        self.text, self.digest = raw[at : at + text], digest

    def probes(self, host: str, path: str) -> list[str]:
        labels = host.split(".")
        return [".".join(labels[-n:]) + path[:size] for n, size in self.shapes
                if len(labels) >= n and len(path) >= size]

    def lookup(self, probes: list[str]) -> np.ndarray:
        """Position of the rule equal to each probe, -1 where there is none."""
        keys = np.fromiter((self.digest(p.encode()) for p in probes), dtype=np.uint64, count=len(probes))
        lo, hi = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        out = np.full(len(probes), -1, dtype=np.int64)
        for i in np.flatnonzero(hi > lo):
            want = probes[i].encode()
            for j in range(lo[i], hi[i]):
                if self.text[self.ends[j] : self.ends[j + 1]].tobytes() == want:
                    out[i] = j
                    break
        return out

    def judge(self, hosts: list[str], paths: list[str], default: str) -> tuple[list, list]:
        """(rule or None, verdict) of each url: the longest rule that fits,
        of equally long ones that with the longer host."""
        probes, owner = [], []
        for i, (h, p) in enumerate(zip(hosts, paths)):
            mine = self.probes(h, p)
            probes += mine
            owner += [i] * len(mine)
        rules, verdicts, rank = [None] * len(hosts), [default] * len(hosts), [(0, 0)] * len(hosts)
        for at in np.flatnonzero((hit := self.lookup(probes)) >= 0):
            i, rule = owner[at], probes[at]
            if (size := (len(rule), len(rule.partition("/")[0]))) > rank[i]:
                rank[i], rules[i] = size, rule
                verdicts[i] = "allow" if self.allow[hit[at]] else "block"
        return rules, verdicts


def ship_index(spark: SparkSession, rules: list[tuple[str, str]]) -> str:
    """Store the index in the shared folder, hand it to all executors and
    return the name to open it by."""
    name = f"llm-rules-{uuid.uuid4().hex}.idx"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.mkdirs(path.getParent())
    out = fs.create(path)
    out.write(bytearray(pack_rules(rules)))
    out.close()
    spark.sparkContext.addFile(fs.makeQualified(path).toString())
    return name


def split_url(url) -> tuple[F.Column, F.Column]:
    """(host, path).  Host: after the first ``://`` up to ``/``, ``?``, ``#``
    or the end, A-Z lower-cased; path: from there up to ``?``, ``#`` or the
    end.  A null url, or one without ``://``, has both empty."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], default: str = "allow",
                id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) for every row of ``pages``.

    A rule (host + path, as ``net/es/``) fits its host and all subdomains if
    the url's path starts with the rule's path; the longest rule gives the
    verdict, ``default`` where none fits.  Null urls and urls without a host
    fit no rule; repeated rows are judged each; an empty table gives no rows.
    Other columns of the table are not read.
    """
    name = ship_index(pages.sparkSession, rules)
    host, path = split_url(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))

    def run(batches):
        index = RuleIndex(SparkFiles.get(name))
        for pdf in batches:
            rule, verdict = index.judge(pdf["host"].tolist(), pdf["path"].tolist(), default)
            yield pdf.assign(rule=pd.Series(rule, dtype=object, index=pdf.index), verdict=verdict)

    kind = dict(pages.dtypes)[id_col]
    return (urls.mapInPandas(run, f"id {kind}, host string, path string, rule string, verdict string")
            .withColumnRenamed("id", id_col))
