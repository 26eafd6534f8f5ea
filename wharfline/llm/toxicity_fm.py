"""Toxicity by a factorization machine over hashed terms.

The terms of a text are its lower-case words and their first four to seven
letters, hashed into ``BUCKETS`` numbers, each counted once per text. A
factorization machine learns a weight per term and a short vector per term; the
product of two vectors weighs a pair of terms, so an insult next to a group can
count for more than both alone.

It is fitted in two steps, both by logistic loss. First a machine over all
buckets at once, in small batches, whose weights and vectors shrink towards zero
by a constant with every step: only terms that matter, alone or beside others,
can grow. Vectors that have grown to ``GROWN`` times their random start, and terms
whose presence alone goes with the label (chi-squared), make the machine of the
second step, which is fitted to the end without that constant pull. A pair
neither of whose terms says anything alone is thus learnt, too.

The fit sees at most ``TRAIN_ROWS`` labelled rows with at most ``TRAIN_TERMS`` terms
in all, sparse, and is one task; the driver gets the model only. Nothing is shuffled
to score.

Defined cases: null and empty texts have no terms and get the score of such
texts; without labelled rows, or with one class only, every score is the share
of label 1 (0.5 if there is none); repeated rows are scored each.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wharfline.functions.durable import durable
from wharfline.llm.common import query, small_batches, table
from wharfline.llm.labelled import TRAIN_ROWS, fold, training_rows

BUCKETS = 1 << 18
TRAIN_TERMS = 20_000_000  # of all training rows; further rows, in a hashed order, are left out
STEMS = (4, 5, 6, 7)
FACTORS = 4
STEPS = 150
RATE = 0.05
SHRINK = 2e-4
CHI_SQUARED, LEAST_TEXTS = 20.0, 5  # a term with less goes with the label by chance
JOINT_STEPS, JOINT_BATCH, JOINT_RATE, JOINT_SHRINK = 240, 256, 0.05, 3e-3
START, GROWN = 0.02, 5.0
THRESHOLD = 0.5
REMEMBERED = 300_000
TERMS_AT_ONCE = 2_000_000


class Terms(dict):
    """Word -> buckets of the word and its stems (all, or those of a fixed choice); forgets all when full."""

    def __init__(self, chosen: np.ndarray | None = None):
        super().__init__()
        self.place = None if chosen is None else {int(b): i for i, b in enumerate(chosen)}
        self.find = re.compile(r"[^\W_]+").findall

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        parts = {f"={word}", *(word[:n] for n in STEMS if len(word) >= n)}
        buckets = {zlib.crc32(p.encode()) % BUCKETS for p in parts}
        if self.place is not None:
            buckets = {self.place[b] for b in buckets if b in self.place}
        out = self[word] = tuple(buckets)
        return out

    def of(self, text: str | None) -> list[int]:
        found: set[int] = set()
        for word in set(self.find((text or "").lower())):
            found.update(self[word])
        return sorted(found)


class Model(NamedTuple):
    chosen: np.ndarray
    base: float
    weights: np.ndarray
    factors: np.ndarray


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows between starts; empty ranges give zero."""
    total = np.concatenate((np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)))
    return total[starts[1:]] - total[starts[:-1]]


def margins(model: Model, terms: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Log-odds of texts whose terms lie between ``starts``."""
    v = model.factors[terms]
    sums = _sums(v, starts)
    pairs = 0.5 * ((sums**2).sum(axis=1) - _sums((v**2).sum(axis=1), starts))
    return model.base + _sums(model.weights[terms], starts) + pairs


def fit(chosen: np.ndarray, terms: np.ndarray, starts: np.ndarray, labels: np.ndarray, seed: int = 9) -> Model:
    """Logistic loss, full batches, Adam; the vectors start small and random."""
    share = float(labels.mean()) if len(labels) else 0.5
    share = min(max(share, 1e-6), 1 - 1e-6)
    base = np.array([np.log(share / (1 - share))])
    weights = np.zeros(len(chosen))
    factors = np.random.default_rng(seed).normal(0, 0.05, (len(chosen), FACTORS))
    if not len(chosen) or len(np.unique(labels)) < 2:
        return Model(chosen[:0], float(base[0]), weights[:0], factors[:0])
    row = np.repeat(np.arange(len(labels)), np.diff(starts))
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (base, weights, factors)]
    for step in range(1, STEPS + 1):
        model = Model(chosen, float(base[0]), weights, factors)
        wrong = (1 / (1 + np.exp(-np.clip(margins(model, terms, starts), -30, 30))) - labels) / len(labels)
        v = factors[terms]
        pull = wrong[row][:, None] * (_sums(v, starts)[row] - v)
        gradient_v = np.stack([np.bincount(terms, pull[:, f], len(chosen)) for f in range(FACTORS)], axis=1)
        gradients = (
            np.array([wrong.sum()]),
            np.bincount(terms, wrong[row], len(chosen)) + SHRINK * weights / len(chosen),
            gradient_v + SHRINK * factors,
        )
        for x, gradient, (mean, square) in zip((base, weights, factors), gradients, state, strict=True):
            mean += 0.1 * (gradient - mean)
            square += 0.001 * (gradient**2 - square)
            x -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Model(chosen, float(base[0]), weights, factors)


def _chunks(starts: np.ndarray) -> Iterator[slice]:
    """Rows in runs of some two million terms, so that no array is as long as the sample."""
    row = 0
    while row < len(starts) - 1:
        stop = max(row + 1, int(np.searchsorted(starts, starts[row] + TERMS_AT_ONCE, "right")) - 1)
        yield slice(row, stop)
        row = stop


def telling(terms: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Whether a bucket's presence alone goes with the label (chi-squared over texts)."""
    n, positive = len(labels), labels.sum()
    every, a = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for rows in _chunks(starts):
        own = terms[starts[rows.start] : starts[rows.stop]]
        every += np.bincount(own, minlength=BUCKETS)
        a += np.bincount(own, np.repeat(labels[rows], np.diff(starts[rows.start : rows.stop + 1])), BUCKETS)
    b = every - a
    c, d = positive - a, n - positive - b
    squared = n * (a * d - b * c) ** 2 / np.maximum((a + b) * (c + d) * positive * (n - positive), 1e-12)
    return (squared > CHI_SQUARED) & (a + b >= LEAST_TEXTS)


def grown(terms: np.ndarray, starts: np.ndarray, labels: np.ndarray, seed: int = 9) -> np.ndarray:
    """Whether a bucket's vector grows in a machine over all buckets that shrinks what does not matter."""
    rng, n = np.random.default_rng(seed), len(labels)
    rounds = -(-JOINT_STEPS * JOINT_BATCH // n)
    order = np.concatenate([rng.permutation(n) for _ in range(rounds)])
    share = labels.mean()
    base, base_square = np.log(share / (1 - share)), 1e-8
    values = np.zeros((BUCKETS, 1 + FACTORS))  # weight, then vector
    values[:, 1:] = rng.normal(0, START, (BUCKETS, FACTORS))
    squares = np.full_like(values, 1e-8)
    sizes = np.diff(starts)
    for step in range(JOINT_STEPS):
        rows = order[step * JOINT_BATCH : (step + 1) * JOINT_BATCH]
        size = sizes[rows]
        cuts = np.concatenate(([0], np.cumsum(size)))
        own, at = np.unique(terms[np.repeat(starts[rows] - cuts[:-1], size) + np.arange(cuts[-1])], return_inverse=True)
        if not len(own):
            continue
        part = Model(own, float(base), values[own, 0], values[own, 1:])
        wrong = (1 / (1 + np.exp(-np.clip(margins(part, at, cuts), -30, 30))) - labels[rows]) / len(rows)
        row = np.repeat(np.arange(len(rows)), size)
        v = part.factors[at]
        pull = wrong[row][:, None] * (_sums(v, cuts)[row] - v)
        gradient = np.stack([np.bincount(at, g, len(own)) for g in (wrong[row], *pull.T)], axis=1)
        squares[own] += gradient**2
        rate = JOINT_RATE / np.sqrt(squares[own])
        moved = values[own] - rate * gradient
        values[own] = np.sign(moved) * np.maximum(np.abs(moved) - rate * JOINT_SHRINK, 0)
        base_square += wrong.sum() ** 2
        base -= JOINT_RATE * wrong.sum() / np.sqrt(base_square)
    return np.sqrt((values[:, 1:] ** 2).sum(axis=1)) > GROWN * START * np.sqrt(FACTORS)


def learnt(terms: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> Model:
    """Both steps, from the sparse rows of the sample."""
    nothing = np.zeros(0, np.int64)
    if len(np.unique(labels)) < 2:
        return fit(nothing, nothing, np.zeros(len(labels) + 1, np.int64), labels)
    kept = telling(terms, starts, labels) | grown(terms, starts, labels)
    chosen = np.flatnonzero(kept)
    place = np.cumsum(kept) - 1
    few, sizes = [], []
    for rows in _chunks(starts):
        own = terms[starts[rows.start] : starts[rows.stop]]
        inside = kept[own]
        few.append(place[own[inside]])
        before = np.concatenate(([0], np.cumsum(inside)))
        sizes.append(np.diff(before[starts[rows.start : rows.stop + 1] - starts[rows.start]]))
    return fit(chosen, np.concatenate(few), np.concatenate(([0], np.cumsum(np.concatenate(sizes)))), labels)


def sparse_rows(sample: DataFrame, most: int = TRAIN_TERMS) -> DataFrame:
    """terms (32-bit integers as bytes) and label of the sample's rows, with at most so many terms in all."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            rows = [np.array(terms.of(t), np.int32) for t in batch.column("text").to_pylist()]
            columns = [pa.array([r.tobytes() for r in rows], pa.binary()), pa.array([len(r) for r in rows], pa.int64()), batch.column("label")]
            yield pa.RecordBatch.from_arrays(columns, names=["terms", "n", "label"])

    rows = durable(sample.select("text", "label").mapInArrow(found, "terms binary, n long, label double"))
    place = F.xxhash64("terms")
    if (rows.agg(F.sum("n")).first()[0] or 0) > most:
        total, last = 0, None
        for r in sorted((r["at"], r["n"]) for r in rows.select(place.alias("at"), "n").collect()):  # at most TRAIN_ROWS
            total += r[1]
            if total > most:
                break
            last = r[0]
        rows = rows.where(place < last if last is not None else F.lit(False))
    return rows.select("terms", "label")


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, most: int = TRAIN_TERMS) -> Model:
    small_batches(documents.sparkSession)

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A fixed order, so that sums of floats agree in every run.
        found = sorted(x for batch in batches for x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        starts, marks = np.cumsum([0, *(len(t) // 4 for t, _ in found)]), np.array([y for _, y in found])
        terms = np.frombuffer(b"".join(t for t, _ in found), np.int32)
        del found
        model = learnt(terms, starts, marks)
        parts = [model.chosen.astype(np.int64), model.weights, model.factors]
        columns = [pa.array([model.base]), *[pa.array([p.tobytes()], pa.binary()) for p in parts]]
        yield pa.RecordBatch.from_arrays(columns, names=["base", "chosen", "weights", "factors"])

    sample = sparse_rows(training_rows(documents.select("doc_id", "text"), labels, "toxic", 5, 0, rows), most)
    row = sample.coalesce(1).mapInArrow(fitted, "base double, chosen binary, weights binary, factors binary").first()
    if row is None:  # not even an empty partition
        return learnt(np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0))
    chosen = np.frombuffer(row["chosen"], np.int64)
    return Model(chosen, row["base"], np.frombuffer(row["weights"]), np.frombuffer(row["factors"]).reshape(len(chosen), FACTORS))


def toxicity(model: Model, text: Column) -> Column:
    """The score of a text column, 0 to 1."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        terms = Terms(model.chosen)
        for texts in batches:
            found = [terms.of(t if isinstance(t, str) else None) for t in texts]
            starts = np.cumsum([0, *map(len, found)])
            flat = np.fromiter((x for f in found for x in f), np.int64, starts[-1])
            yield pd.Series(1 / (1 + np.exp(-np.clip(margins(model, flat, starts), -30, 30))))

    return scored(text)


@query("op9_toxicity_fm")
def op9_toxicity_fm(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = train(documents, table(spark, folder, "labels"))
    return documents.select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), toxicity(model, F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
