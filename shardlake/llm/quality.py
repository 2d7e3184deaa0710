"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature has a lookup table over its bins.  The tables are learnt by
cyclic boosting: round after round, each feature in turn gets a shallow tree
(one or two cuts of its bins) fitted to the gradient, added with a small step.
Then the pairs of features with the largest gain get two-dimensional tables,
boosted in the same way with one cut in each direction.  A score is a sum of
table entries, looked up for a whole batch by bin numbers.

The model is fitted on at most ``TRAIN_ROWS`` labelled rows, taken by a hash
of the id; it scores every whole text.
"""
from __future__ import annotations

import operator
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, small_batches
from .toxicity import labelled, score_column

TRAIN_ROWS = 20_000
BINS, PAIR_BINS = 48, 12
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 6
STEP, SHRINK = 0.1, 1.0
THRESHOLD = 0.5

FEATURES = ["words", "word_length", "upper", "digits", "signs", "bars", "shouts", "stops", "commas", "not_ascii", "distinct",
            "repeats", "top_word", "line_words", "line_repeats", "marked_words"]
SIGNS = np.zeros(256, dtype=bool)
SIGNS[list(b"#$%&*@^~+=<>{}[]\\_`/")] = True


def features(text) -> list[float]:
    """Shape of a whole text; a null, empty or blank one has no words."""
    words = text.split() if isinstance(text, str) else []
    if not words:
        return [0.0] * len(FEATURES)
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8), minlength=256)
    n, total = len(words), max(1, int(raw.sum()))
    upper, lower = raw[65:91].sum(), raw[97:123].sum()
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    marked = sum(k for w, k in counts.items() if not (w[-1].isalnum() or w[-1] in ".,;:?'\")»"))
    return [
        np.log1p(n), sum(map(len, words)) / n, upper / max(1, upper + lower), raw[48:58].sum() / total, raw[SIGNS].sum() / total,
        raw[124] / n, raw[33] / n, raw[46] / n, raw[44] / n, raw[128:].sum() / total, len(counts) / n ** 0.8,
        sum(map(operator.eq, words, words[1:])) / n, counts.most_common(1)[0][1] / n, np.log1p(n / len(lines)),
        1 - len(set(lines)) / len(lines), marked / n,
    ]


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g, h):
    return g * g / (h + SHRINK)


def _split(g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
    """Best single cut of a row of bins: (bins on the left, gain)."""
    if len(g) < 2:
        return 0, 0.0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = _gain(gl, hl) + _gain(g.sum() - gl, h.sum() - hl) - _gain(g.sum(), h.sum())
    best = int(np.argmax(gain))
    return best + 1, float(gain[best])


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Value per bin of a shallow tree fitted to gradient and curvature sums."""
    cut, gain = _split(g, h) if depth else (0, 0.0)
    if gain <= 1e-9:
        return np.full(len(g), g.sum() / (h.sum() + SHRINK))
    return np.concatenate([_tree(g[:cut], h[:cut], depth - 1), _tree(g[cut:], h[cut:], depth - 1)])


def _square(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Table of the best pair of cuts, one in each direction, and its gain."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    parts_g = [cg, cg[:, -1:] - cg, cg[-1:, :] - cg, cg[-1, -1] - cg[:, -1:] - cg[-1:, :] + cg]
    parts_h = [ch, ch[:, -1:] - ch, ch[-1:, :] - ch, ch[-1, -1] - ch[:, -1:] - ch[-1:, :] + ch]
    gain = sum(_gain(a, b) for a, b in zip(parts_g, parts_h))[:-1, :-1]
    if not gain.size:
        return np.zeros_like(g), 0.0
    i, k = np.unravel_index(int(np.argmax(gain)), gain.shape)
    value = [a[i, k] / (b[i, k] + SHRINK) for a, b in zip(parts_g, parts_h)]
    out = np.empty_like(g)
    out[: i + 1, : k + 1], out[: i + 1, k + 1 :], out[i + 1 :, : k + 1], out[i + 1 :, k + 1 :] = value
    return out, float(gain[i, k] - _gain(g.sum(), h.sum()))


@dataclass
class AdditiveModel:
    base: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for f, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            z += table[np.searchsorted(cuts, x[:, f], side="right")]
        for a, b, table in self.pairs:
            z += table[np.searchsorted(self.pair_cuts[a], x[:, a], side="right"),
                       np.searchsorted(self.pair_cuts[b], x[:, b], side="right")]
        return z

    def score(self, texts) -> np.ndarray:
        x = np.array([features(t) for t in texts], dtype=float).reshape(len(texts), len(FEATURES))
        return 1 / (1 + np.exp(-self.margin(x)))


def fit_additive(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Without rows the model scores 0.5; with rows of one class only, near
    that class."""
    if not len(x):
        return AdditiveModel()
    share = np.clip(y.mean(), 0.5 / (len(y) + 1), 1 - 0.5 / (len(y) + 1))
    model = AdditiveModel(float(np.log(share / (1 - share))))
    model.cuts = [_cuts(x[:, f], BINS) for f in range(x.shape[1])]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    bins = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(model.cuts)]
    z = np.full(len(y), model.base)

    def slopes():
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, table in enumerate(model.tables):
            g, h = slopes()
            step = STEP * _tree(np.bincount(bins[f], g, len(table)), np.bincount(bins[f], h, len(table)))
            table += step
            z += step[bins[f]]
    model.pair_cuts = [_cuts(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
    wide = [len(c) + 1 for c in model.pair_cuts]
    coarse = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(model.pair_cuts)]

    def square(a, b):
        g, h = slopes()
        both = coarse[a] * wide[b] + coarse[b]
        return _square(np.bincount(both, g, wide[a] * wide[b]).reshape(wide[a], wide[b]),
                       np.bincount(both, h, wide[a] * wide[b]).reshape(wide[a], wide[b]))

    ranked = sorted(((-square(a, b)[1], a, b) for a in range(x.shape[1]) for b in range(a)))[:PAIRS]
    model.pairs = [(a, b, np.zeros((wide[a], wide[b]))) for gain, a, b in ranked if gain < -1e-9]
    for _ in range(PAIR_ROUNDS):
        for a, b, table in model.pairs:
            step = STEP * square(a, b)[0]
            table += step
            z += step[coarse[a], coarse[b]]
    return model


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> AdditiveModel:
    """Learn from up to ``rows`` labelled documents that are not held out."""
    small_batches(docs.sparkSession)

    def measured(batches):
        for pdf in batches:
            pdf["x"] = [features(t) for t in pdf["text"]]
            yield pdf[["x", "y"]]

    got = labelled(docs, labels, "quality", rows, "min").mapInPandas(measured, "x array<double>, y int").toPandas()
    x = np.array(got["x"].tolist(), dtype=float).reshape(len(got), len(FEATURES))
    return fit_additive(x, (got["y"] > 0).to_numpy(dtype=float))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Null and empty texts are scored by their all-zero features; repeated rows
    and null ids are scored each; without labels every score is 0.5; an empty
    table gives no rows; other columns are ignored.
    """
    model = fit(docs, labels)
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(model, F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
