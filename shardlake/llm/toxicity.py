"""Toxicity by weak supervision.

Voters are lexicons of insults, patterns, and word stems mined from labelled
rows; a voter fires or abstains.  A generative label model (two classes; each
voter fires with its own rate in each class, which is its accuracy) is fitted
by expectation-maximisation over the votes of *all* documents, with the
labelled rows as prior counts.  From the pairs of votes it estimates how
voters correlate within a class; strongly correlated voters see the same thing
and count once.  A given label is the vote of one more voter, the annotator,
whose error rates are estimated too (``fit_annotator``): it can be outvoted.
The posterior of all votes labels a bounded sample, on which a linear
(logistic) classifier of the voters' hits is trained; the classifier scores
every whole text.

Bounded, by parameters: the labelled rows that stems are mined from
(``TOXIC_ROWS``, ``CLEAN_ROWS``), the mined stems (``STEMS``) and the rows the
classifier is trained on (``TRAIN_ROWS``).  Vote statistics cover all rows.
"""
from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, dropped, held_out, small_batches, written

TOXIC_ROWS, CLEAN_ROWS, TRAIN_ROWS = 2000, 3000, 20_000
STEMS, CANDIDATES = 60, 2000
#: Lengths of the word prefixes that can become stems, besides whole words,
#: and the most distinct words with a prefix that a stem can ask for.
STEM_LENGTHS, STEM_REPEATS = (4, 5, 6, 7), 3
#: A stem occurs in at least so many toxic sample rows, and each sample row is
#: covered by up to so many stems.
STEM_ROWS, COVER = 5, 3
#: Share of the rows with a stem that may be clean.
STEM_CLEAN = 0.02
#: How much a clean row with a stem counts against a toxic one.
NOISE = 20
ROUNDS = 4
#: Voters correlated by this much within a class see the same thing.  Weaker
#: correlations also come from the language and the length of a text.
DEPENDENT = 0.6
#: The annotator's error rate before any row is seen, and the rows of each
#: class that this guess counts for.
MISLABELLED, GUESS_ROWS = 0.001, 1000
THRESHOLD = 0.7

# Insults by theme (fixed values).
LEXICONS = {
    "intellect": "idiot idiots idiotic moron morons moronic stupid imbecile cretin dimwit halfwit brainless dumbass",
    "worth": "loser losers worthless pathetic useless failure nobody",
    "filth": "trash garbage scum filth filthy vermin parasite lowlife",
    "disgust": "disgusting revolting repulsive vile sickening",
    "mockery": "clown clowns freak weirdo creep coward crybaby",
    "profanity": "shit bullshit fuck fucking bitch bastard asshole dickhead",
    "german": "idiot dummkopf blödmann arschloch abschaum dreckskerl trottel versager",
    "french": "imbécile crétin connard salaud ordure abruti minable",
    "spanish": "idiota estúpido imbécil escoria asqueroso basura payaso",
}
# Patterns of abuse, over lower-cased text (fixed values).
PATTERNS = {
    "you_are": r"\byou(?: are|'re| r)? (?:a |an |such |so )*(?:idiot|moron|stupid|dumb|loser|pathetic|worthless|disgusting|scum|trash|clown)",
    "go_away": r"\b(?:shut (?:the \w+ )?up|go to hell|get lost|drop dead)\b",
    "threat": r"\b(?:i|we)(?:'ll| will) (?:kill|hurt|beat|destroy) you\b",
}
#: A pattern is searched for only where one of these words stands.
PATTERN_WORDS = {"you", "shut", "hell", "lost", "drop"}


def words_of(text: str) -> set[str]:
    """Distinct lower-cased words (letters only) of a text."""
    return set(re.findall(r"[^\W\d_]+", " ".join(set(text.lower().split()))))


def prefixes(words: set[str]) -> dict[str, int]:
    """Distinct words behind each prefix."""
    return Counter(w[:n] for n in STEM_LENGTHS for w in words if len(w) > n)


def stems_of(words: set[str]) -> set[str]:
    """Whole words as themselves, and ``prefix*m`` for each prefix that at
    least ``m`` distinct words begin with."""
    out = set(words)
    for p, n in prefixes(words).items():
        out.update(f"{p}*{m}" for m in range(1, min(n, STEM_REPEATS) + 1))
    return out


@dataclass
class Voters:
    stems: list[str] = field(default_factory=list)

    def __post_init__(self):
        self.names = [*LEXICONS, *PATTERNS, *self.stems]
        lists = [(k, set(v.split())) for k, v in enumerate(LEXICONS.values())]
        self.by_word: dict[str, list[int]] = {}
        for k, ws in lists:
            for w in ws:
                self.by_word.setdefault(w, []).append(k)
        self.by_prefix: dict[str, list[tuple[int, int]]] = {}
        for k, s in enumerate(self.stems, len(LEXICONS) + len(PATTERNS)):
            prefix, star, least = s.partition("*")
            if star:
                self.by_prefix.setdefault(prefix, []).append((k, int(least)))
            else:
                self.by_word.setdefault(s, []).append(k)
        self.sizes = sorted({len(p) for p in self.by_prefix})

    def hits(self, text) -> np.ndarray:
        """Distinct words that each voter fires on (for ``prefix*m`` those from
        the ``m``-th on, for a pattern its matches), and the number of
        distinct words."""
        out = np.zeros(len(self.names) + 1, dtype=np.float64)
        if not isinstance(text, str) or not text:
            return out
        words = words_of(text)
        out[-1] = len(words)
        for w in words.intersection(self.by_word):
            out[self.by_word[w]] += 1
        for n in self.sizes:
            starts = [w[:n] for w in words if len(w) > n]
            for p in self.by_prefix.keys() & set(starts):
                for k, least in self.by_prefix[p]:
                    if len(p) == n:
                        out[k] = max(0, starts.count(p) - least + 1)
        if not words.isdisjoint(PATTERN_WORDS):
            low = text.lower()
            for k, p in enumerate(PATTERNS.values(), len(LEXICONS)):
                out[k] = len(re.findall(p, low))
        return out


def labelled(docs: DataFrame, labels: DataFrame, column: str, rows: int, worst: str) -> DataFrame:
    """(doc_id, text, y) of up to ``rows`` labelled documents, taken by a hash
    of the id, never a held-out one.  Of several labels of a document the
    ``worst`` ("min" or "max") counts."""
    own = (labels.filter(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(getattr(F, worst)(column).cast("int").alias("y")))
    own = written(bounded_sample(own, "doc_id", rows), "labels")
    return docs.select("doc_id", "text").join(F.broadcast(own), "doc_id")


def mine_stems(docs: DataFrame, labels: DataFrame) -> tuple[list[str], np.ndarray]:
    """Word stems that tell toxic sample rows from clean ones (a greedy cover
    of the toxic rows), and the number of clean and toxic sample rows."""
    picked = [labelled(docs, labels.filter(F.col("toxic") == y), "toxic", n, "max") for y, n in ((1, TOXIC_ROWS), (0, CLEAN_ROWS))]

    def stems(batches):
        for pdf in batches:
            for d, t, y in zip(pdf["doc_id"], pdf["text"], pdf["y"]):
                found = sorted(stems_of(words_of(t))) if isinstance(t, str) else []
                yield pd.DataFrame({"doc_id": d, "stem": ["", *found], "y": y})

    rows = written(picked[0].unionByName(picked[1]).mapInPandas(stems, "doc_id long, stem string, y int"), "stems")
    counts = rows.groupBy("stem").agg(F.count_if(F.col("y") == 1).alias("toxic"), F.count_if(F.col("y") == 0).alias("clean"))
    total = counts.filter("stem = ''").first()
    sizes = np.array([total["clean"], total["toxic"]] if total else [0, 0], dtype=float)
    good = (counts.filter((F.col("stem") != "") & (F.col("toxic") >= STEM_ROWS)
                          & (F.col("clean") <= STEM_CLEAN * F.col("toxic") * max(sizes[0], 1) / max(sizes[1], 1)))
            .orderBy(F.desc(F.col("toxic") - F.col("clean")), "clean", F.length("stem"), "stem").limit(CANDIDATES))
    held = (rows.filter("y = 1").join(F.broadcast(good.select("stem", "clean")), "stem")
            .groupBy("stem").agg(F.first("clean").alias("clean"), F.collect_set("doc_id").alias("docs")).collect())
    dropped(rows)
    cover = {r["stem"]: (set(r["docs"]), r["clean"] / len(r["docs"])) for r in held}
    need = {d: COVER for ds, _ in cover.values() for d in ds}
    chosen: list[str] = []
    while cover and len(chosen) < STEMS:
        # rows newly covered, less for every clean row that the stem hits too;
        # one that hits clean rows is taken for rows without any stem only
        gain = {s: sum(need[d] > (0 if x == 0 else COVER - 1) for d in ds) * max(0.0, 1 - NOISE * x) for s, (ds, x) in cover.items()}
        best = min(cover, key=lambda s: (-gain[s], len(s), s))
        if gain[best] < STEM_ROWS:
            break
        docs_of, noise = cover.pop(best)
        chosen.append(best)
        for d in docs_of:
            need[d] -= 1
        # what sees no other rows, and is no more exact, adds nothing
        cover = {s: (ds, x) for s, (ds, x) in cover.items() if not (ds <= docs_of and x >= noise)}
    return chosen, sizes


def groups_of(corr: np.ndarray) -> list[np.ndarray]:
    """Voters joined by strong correlations, directly or over others."""
    group = np.arange(len(corr))
    for a, b in zip(*np.nonzero(corr >= DEPENDENT)):
        if group[a] != group[b]:
            group[group == group[a]] = group[b]
    return [np.flatnonzero(group == g) for g in np.unique(group)]


@dataclass
class LabelModel:
    """``rate``: how often each voter fires in class 0 and 1, last how often
    none does; ``prior``: share of class 1; ``groups``: voters that see the
    same thing, of which only the strongest that fires counts.  A voter that
    does not fire abstains."""
    rate: np.ndarray
    prior: float
    groups: list[np.ndarray]

    def posterior(self, votes: np.ndarray, given: np.ndarray | None = None, errors: np.ndarray | None = None) -> np.ndarray:
        """Probability of class 1 by the votes and, where ``given`` is not nan,
        by the annotator's label with ``errors`` (share of class 0 given label
        1, share of class 1 given label 0)."""
        gain = np.log(self.rate[1] / self.rate[0])
        z = np.log(self.prior / (1 - self.prior)) + np.where(votes.any(axis=1), 0.0, gain[-1])
        for g in self.groups:
            best = np.where(votes[:, g], gain[g], -np.inf).max(axis=1)
            z += np.where(np.isfinite(best), best, 0.0)
        if given is not None:
            says = np.log([errors[1] / (1 - errors[0]), (1 - errors[1]) / errors[0]])
            z += np.where(np.isnan(given), 0.0, says[(given > 0).astype(int)])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_label_model(votes: DataFrame, known: np.ndarray, sizes: np.ndarray) -> LabelModel:
    """``votes``: (votes array<boolean>, n) vote patterns of all documents.
    ``known``: (2, voters + 1) labelled rows of each class in which a voter
    fires (last: none fires), out of ``sizes`` rows."""
    j = known.shape[1] - 1
    prior = float(np.clip((sizes[1] + 1) / (sizes.sum() + 10), 0.01, 0.5))
    # without labelled rows: a voter mostly fires on toxic texts
    guess = np.array([np.r_[np.full(j, 0.002), 0.9], np.r_[np.full(j, 0.1), 0.1]])
    rate = np.clip((known + 2 * guess) / (sizes[:, None] + 2), 1e-5, 0.999)
    model = LabelModel(rate, prior, [np.array([k]) for k in range(j)])
    schema = "i int, k int, c0 double, c1 double"
    for _ in range(ROUNDS):
        now = model

        def expect(batches):
            both = np.zeros((2, j + 2, j + 2))
            for pdf in batches:
                v = np.stack(pdf["votes"].to_numpy()).astype(float)
                n, q = pdf["n"].to_numpy(dtype=float), now.posterior(v > 0)
                v = np.c_[v, ~v.any(axis=1), np.ones(len(v))]  # none fires; the last counts the documents
                both[0] += v.T @ (v * (n * (1 - q))[:, None])
                both[1] += v.T @ (v * (n * q)[:, None])
            i, k = np.nonzero(both.sum(axis=0))
            yield pd.DataFrame({"i": i, "k": k, "c0": both[0][i, k], "c1": both[1][i, k]})

        both = np.zeros((2, j + 2, j + 2))
        for r in votes.mapInPandas(expect, schema).groupBy("i", "k").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")).collect():
            both[:, r["i"], r["k"]] = r["c0"], r["c1"]
        total = both[:, -1, -1]
        rate = np.clip((both[:, -1, : j + 1] + known + 2 * guess) / (total + sizes + 2)[:, None], 1e-5, 0.999)
        # correlation of two voters within a class; the stronger of the two counts
        together = both[:, :j, :j] / np.maximum(total, 1)[:, None, None]
        alone = both[:, -1, :j] / np.maximum(total, 1)[:, None]
        spread = np.sqrt(np.maximum(alone * (1 - alone), 1e-9))
        corr = (together - alone[:, :, None] * alone[:, None, :]) / (spread[:, :, None] * spread[:, None, :])
        prior = float(np.clip((total[1] + sizes[1] + 1) / (total.sum() + sizes.sum() + 10), 0.005, 0.5))
        model = LabelModel(rate, prior, groups_of(corr.max(axis=0)))
    return model


def fit_annotator(model: LabelModel, votes: np.ndarray, given: np.ndarray) -> np.ndarray:
    """The annotator's error rates in class 0 and class 1 by expectation-
    maximisation over the labelled rows (``given``: 0, 1, or nan for none)."""
    errors = np.full(2, MISLABELLED)
    own = ~np.isnan(given)
    for _ in range(ROUNDS):
        q = model.posterior(votes[own], given[own], errors)
        wrong = np.array([((1 - q) * (given[own] > 0)).sum(), (q * (given[own] <= 0)).sum()])
        errors = np.clip((wrong + MISLABELLED * GUESS_ROWS) / (np.array([(1 - q).sum(), q.sum()]) + GUESS_ROWS), 1e-6, 0.5)
    return errors


def fit_linear(x: np.ndarray, q: np.ndarray, ridge: float = 0.1, steps: int = 30) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps; the last weight is
    the intercept, which is not shrunk."""
    x = np.c_[x, np.ones(len(x))]
    keep = np.r_[np.full(x.shape[1] - 1, ridge), 1e-6]
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (q - p) - keep * w
        hess = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(hess, grad)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class ToxicityModel:
    voters: Voters
    weights: np.ndarray
    label_model: LabelModel | None = None

    def score(self, texts) -> np.ndarray:
        x = np.log1p(np.array([self.voters.hits(t) for t in texts]).reshape(len(texts), len(self.voters.names) + 1))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learn from ``docs`` (all rows, unlabelled) and the labels of rows that
    are not held out.  ``lang``, ``source`` and ``doc_id`` are no inputs."""
    small_batches(docs.sparkSession)
    stems, sizes = mine_stems(docs, labels)
    voters = Voters(stems)
    j = len(voters.names)

    def vote(batches):
        for b in batches:
            hits = [voters.hits(t).tolist() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(hits, pa.list_(pa.float64()))], names=["doc_id", "hits"])

    votes = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                    .mapInArrow(vote, "doc_id long, hits array<double>"), "votes")
    fired = F.transform(F.slice("hits", 1, j), lambda h: h > 0)
    patterns = written(votes.groupBy(fired.alias("votes")).agg(F.count("*").alias("n")), "patterns")
    known, size = np.zeros((2, j + 1)), np.zeros(2)
    own = labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    sample = written(bounded_sample(own, "doc_id", TRAIN_ROWS // 2), "labels")
    seen = F.concat(fired, F.array(~F.exists(fired, lambda f: f), F.lit(True)))
    for r in (votes.join(F.broadcast(sample), "doc_id").select("y", F.posexplode(seen).alias("k", "f"))
              .groupBy("y", "k").agg(F.count_if("f").alias("c")).collect()):
        if r["k"] > j:
            size[int(r["y"] > 0)] += r["c"]
        else:
            known[int(r["y"] > 0), r["k"]] += r["c"]
    model = fit_label_model(patterns, known, size)
    # half labelled rows, half others; all are labelled by the posterior
    own_votes = votes.filter(~held_out(F.col("doc_id")))
    others = bounded_sample(own_votes.join(own.select("doc_id"), "doc_id", "left_anti"), "doc_id", TRAIN_ROWS // 2)
    train = (own_votes.join(F.broadcast(sample), "doc_id").limit(TRAIN_ROWS // 2).select("hits", "y")
             .unionByName(others.select("hits", F.lit(None).cast("int").alias("y"))).toPandas())
    x = np.array(train["hits"].tolist(), dtype=float).reshape(len(train), j + 1)
    given = train["y"].to_numpy(dtype=float)
    q = model.posterior(x[:, :j] > 0, given, fit_annotator(model, x[:, :j] > 0, given))
    weights = fit_linear(np.log1p(x), q) if len(x) else np.r_[np.zeros(j + 1), -30.0]
    dropped(votes)
    dropped(patterns)
    return ToxicityModel(voters, weights, model)


def score_column(model, text):
    """A column of scores of whole texts; works on Arrow batches."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts.tolist()))
    return score(text.cast("string"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Null and empty texts score as texts without any hit; repeated rows and
    null ids are scored each; without labels the lexicons and patterns alone
    are the voters; an empty table gives no rows; other columns are ignored.
    """
    model = fit(docs, labels)
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(model, F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
