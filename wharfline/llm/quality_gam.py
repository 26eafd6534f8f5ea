"""Quality classifier: a generalised additive model with pairwise interactions.

A text is described by some twenty ratios of its bytes, words and lines. Each
feature is cut into bins, and boosting visits the features in turn, again and
again: a tree of depth two is fitted to the residuals over the bins of one
feature and added, shrunk, to that feature's lookup table. Then the pairs whose
joint bins explain most of what is left get tables of their own in the same way.
A score is a sum of table entries, one per feature and pair, through the
logistic function.

The fit sees at most ``TRAIN_ROWS`` labelled rows, as features only, and is a
matter of seconds on the driver; tables of a few kilobytes go to the tasks, which
score whole batches of texts. Nothing is shuffled to score.

Defined cases: null and empty texts have all features zero and get the score of
such texts; without labelled rows, or with one class only, every score is the
share of label 1 (0.5 if there is none); repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wharfline.llm.common import query, small_batches, table
from wharfline.llm.labelled import TRAIN_ROWS, fold, training_rows

BINS, PAIR_BINS = 48, 8
PAIRS = 8
ROUNDS, PAIR_ROUNDS = 150, 60
RATE = 0.1
RIDGE = 5.0
THRESHOLD = 0.7
FEATURES = (
    "words", "word_length", "longest_word", "short_words", "upper", "digits", "stops", "commas", "marks", "quotes",
    "beyond_ascii", "spaces", "controls", "lines", "line_length", "different_lines", "different_words", "words_per_stop",
    "marked_words", "capital_words",
)
_MARKS = [b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".!?,;:'\"()-"]


def describe(text: str | None) -> list[float]:
    """The features of one text, in the order of ``FEATURES``."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n, n_words = len(data), len(words)
    upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
    beyond = int(count[128:].sum())
    stops = int(count[46] + count[33] + count[63])
    lines = [x for x in data.split(b"\n") if x.strip()]
    longest = max(map(len, words))
    short = sum(1 for w in words if len(w) <= 3)
    body = sum(map(len, words))
    return [
        np.log1p(n_words), body / n_words, np.log1p(longest), short / n_words,
        upper / max(1, upper + lower + beyond), count[48:58].sum() / n, stops / n_words, (count[44] + count[59] + count[58]) / n_words,
        count[_MARKS].sum() / n_words, (count[34] + count[39] + count[40] + count[41] + count[45]) / n_words,
        beyond / n, count[32] / n_words, (count[:9].sum() + count[14:32].sum() + count[127]) / n,
        len(lines) / n_words, np.log1p(n / max(1, len(lines))), len(set(lines)) / max(1, len(lines)),
        len(set(words)) / n_words, np.log1p(n_words / (stops + 1)),
        sum(1 for w in words if not w[-1:].isalnum() and w[-1:] not in b".!?,;:'\")") / n_words,
        sum(1 for w in words if w[:1].isupper()) / n_words,
    ]


class Model(NamedTuple):
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pair_cuts: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]
    base: float


def _binned(values: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, values[:, j], "right") for j, c in enumerate(cuts)], axis=1)


def _cuts(values: np.ndarray, bins: int) -> list[np.ndarray]:
    """Inner borders at quantiles of the distinct values, so that rare values have bins, too."""
    out = []
    for j in range(values.shape[1]):
        both = np.concatenate([np.quantile(values[:, j], np.linspace(0, 1, bins // 2 + 1)[1:-1]),
                               np.quantile(np.unique(values[:, j]), np.linspace(0, 1, bins // 2 + 1)[1:-1])])
        out.append(np.unique(both))
    return out


def _split(g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
    """Best cut of a row of bins: the first bin of the right part, and the gain."""
    if len(g) < 2:
        return 0, 0.0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = left_g**2 / (left_h + RIDGE) + right_g**2 / (right_h + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE)
    at = int(gain.argmax())
    return at + 1, float(gain[at])


def _leaf(g: np.ndarray, h: np.ndarray) -> float:
    return float(g.sum() / (h.sum() + RIDGE))


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values of a tree of depth two over the bins of one feature."""
    out, at = np.zeros(len(g)), _split(g, h)[0]
    for part in ((slice(0, len(g)),) if not at else (slice(0, at), slice(at, len(g)))):
        inner = _split(g[part], h[part])[0]
        for leaf in (slice(part.start, part.start + inner), slice(part.start + inner, part.stop)):
            if leaf.stop > leaf.start:
                out[leaf] = _leaf(g[leaf], h[leaf])
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Values over two features: one cut of the first, then one of the second on either side; and the gain."""
    best, out = -1.0, np.zeros_like(g)
    for flip in (False, True):
        a, b = (g.T, h.T) if flip else (g, h)
        for cut in range(1, len(a)):
            values, gain = np.zeros_like(a), 0.0
            for rows in (slice(0, cut), slice(cut, len(a))):
                ga, ha = a[rows].sum(axis=0), b[rows].sum(axis=0)
                at, more = _split(ga, ha)
                gain += more + ga.sum() ** 2 / (ha.sum() + RIDGE)
                for columns in (slice(0, at), slice(at, a.shape[1])):
                    if columns.stop > columns.start:
                        values[rows, columns] = _leaf(ga[columns], ha[columns])
            if gain > best:
                best, out = gain, values.T if flip else values
    return out, best


def fit(values: np.ndarray, labels: np.ndarray) -> Model:
    share = float(labels.mean()) if len(labels) else 0.5
    if not len(labels) or not 0 < share < 1:
        flat = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))) if len(labels) else 0.0
        return Model([], [], [], [], [], flat)
    base = float(np.log(share / (1 - share)))
    cuts, pair_cuts = _cuts(values, BINS), _cuts(values, PAIR_BINS)
    bins, coarse = _binned(values, cuts), _binned(values, pair_cuts)
    tables = [np.zeros(len(c) + 1) for c in cuts]
    total = np.full(len(labels), base)

    def residuals():
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, own in enumerate(tables):
            g, h = residuals()
            step = RATE * _tree(np.bincount(bins[:, j], g, len(own)), np.bincount(bins[:, j], h, len(own)))
            own += step
            total += step[bins[:, j]]
    shapes = [len(c) + 1 for c in pair_cuts]
    g, h = residuals()

    def joint(i, j, weights):
        return np.bincount(coarse[:, i] * shapes[j] + coarse[:, j], weights, shapes[i] * shapes[j]).reshape(shapes[i], shapes[j])

    gains = [(_pair_tree(joint(i, j, g), joint(i, j, h))[1], i, j) for i, j in combinations(range(len(cuts)), 2)]
    pairs = [(i, j) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
    pair_tables = [np.zeros((shapes[i], shapes[j])) for i, j in pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), own in zip(pairs, pair_tables, strict=True):
            g, h = residuals()
            step = RATE * _pair_tree(joint(i, j, g), joint(i, j, h))[0]
            own += step
            total += step[coarse[:, i], coarse[:, j]]
    return Model(cuts, tables, pair_cuts, pairs, pair_tables, base)


def score(model: Model, values: np.ndarray) -> np.ndarray:
    total = np.full(len(values), model.base)
    if model.tables:
        bins, coarse = _binned(values, model.cuts), _binned(values, model.pair_cuts)
        for j, own in enumerate(model.tables):
            total += own[bins[:, j]]
        for (i, j), own in zip(model.pairs, model.pair_tables, strict=True):
            total += own[coarse[:, i], coarse[:, j]]
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def described(texts: pd.Series) -> np.ndarray:
    rows = [describe(t if isinstance(t, str) else None) for t in texts]
    return np.array(rows, float).reshape(len(rows), len(FEATURES))


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    small_batches(documents.sparkSession)

    def features(batches):
        for frame in batches:
            yield pd.DataFrame({"features": list(described(frame["text"])), "label": frame["label"]})

    sample = training_rows(documents.select("doc_id", "text"), labels, "quality", 4, 2, rows)
    found = sample.mapInPandas(features, "features array<double>, label double").toPandas()
    values = np.array(found["features"].tolist(), float).reshape(len(found), len(FEATURES))
    # Rows in a fixed order, so that sums of floats agree in every run.
    order = np.lexsort((*values.T, found["label"].to_numpy(float)))
    return fit(values[order], found["label"].to_numpy(float)[order])


def quality(model: Model, text: Column) -> Column:
    """The score of a text column, 0 to 1."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(score(model, described(texts)))

    return scored(text)


@query("op5_quality_gam")
def op5_quality_gam(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = train(documents, table(spark, folder, "labels"))
    return documents.select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), quality(model, F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
