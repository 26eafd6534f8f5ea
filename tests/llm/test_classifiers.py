import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wharfline.llm import labelled, quality_gam, toxicity_fm

FOLDER = "/root/testdata/sf0.01"


def ranked(labels, scores):
    """Area under the ROC curve by all pairs."""
    good, bad = scores[labels == 1], scores[labels == 0]
    return np.mean((good[:, None] > bad[None, :]) + 0.5 * (good[:, None] == bad[None, :]))


@pytest.mark.parametrize(
    ("query", "label", "folds", "out", "least"),
    [(quality_gam.op5_quality_gam, "quality", 4, 2, 0.97), (toxicity_fm.op9_toxicity_fm, "toxic", 5, 0, 0.85)],
)
def test_held_out_rows(spark, query, label, folds, out, least):
    got = query(spark, FOLDER)
    rows = got.toPandas()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert rows["score"].between(0, 1).all() and (rows["held_out"] == [zlib.crc32(str(i).encode()) % folds == out for i in rows["doc_id"]]).all()
    known = rows.merge(spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas(), on="doc_id")
    known = known[known["held_out"]]
    assert ranked(known[label].to_numpy(), known["score"].to_numpy()) >= least
    again = query(spark, FOLDER).toPandas()
    assert rows.sort_values("doc_id")["score"].tolist() == again.sort_values("doc_id")["score"].tolist()


def test_sample_is_bounded_and_leaves_out_the_held_out_fold(documents, labels):
    docs = documents([(i, f"t {i}") for i in range(200)] + [(None, "n"), (3, "again")])
    marks = labels([(i, i % 2, 0, "x", 0.5) for i in range(200)] + [(None, 1, 1, "x", 0.5), (4, None, None, "x", 0.5)])
    rows = labelled.training_rows(docs, marks, "quality", 4, 2, rows=30).collect()
    ids = {int(r.text.split()[1]) for r in rows if r.text != "again"}
    assert len(ids) <= 30 and all(zlib.crc32(str(i).encode()) % 4 != 2 for i in ids)


def test_sample_is_bounded_with_repeated_ids(documents, labels):
    docs = documents([(i % 5, f"t {i:03d}") for i in range(200)] + [(3, None)])
    marks = labels([(i, i % 2, 0, "x", 0.5) for i in range(5)])
    rows = labelled.training_rows(docs, marks, "quality", 4, 2, rows=30).collect()
    ids = [i for i in range(5) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert sorted(map(tuple, rows)) == sorted(("" if i == 3 else f"t {i:03d}", float(i % 2)) for i in ids)


@pytest.mark.parametrize("module", [quality_gam, toxicity_fm])
def test_degenerate_input(spark, documents, labels, module):
    docs = documents([(1, None), (2, ""), (3, "some words here"), (None, "x"), (3, "some words here"), (4, "long " * 50_000)])
    scored = module.quality if module is quality_gam else module.toxicity
    for marks in ([], [(1, 1, 1, "", 0.0), (3, 1, 1, "", 0.0)], [(i, i % 2, i % 2, "", 0.0) for i in range(1, 5)]):
        model = module.train(docs, labels(marks))
        values = [r.s for r in docs.select(scored(model, F.col("text")).alias("s")).collect()]
        assert len(values) == 6 and all(0 <= v <= 1 for v in values)
        if not marks:
            assert values == [0.5] * 6
    empty = documents([])
    model = module.train(empty, labels([(1, 1, 0, "", 0.0)]))
    assert empty.select(scored(model, F.col("text")).alias("s")).count() == 0


def test_additive_model_learns_a_pair():
    rng = np.random.default_rng(1)
    x = rng.random((4000, len(quality_gam.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.5)).astype(float)  # nothing in either feature alone
    model = quality_gam.fit(x[:3000], y[:3000])
    assert (0, 3) in model.pairs
    assert ranked(y[3000:], quality_gam.score(model, x[3000:])) > 0.97


def test_factors_learn_a_pair():
    rng = np.random.default_rng(1)
    bits = rng.random((3000, 12)) < 0.5
    y = (bits[:, 2] & bits[:, 5]).astype(float)
    terms = np.concatenate([np.flatnonzero(b) for b in bits])
    starts = np.cumsum([0, *bits.sum(axis=1)])
    model = toxicity_fm.fit(np.arange(12), terms, starts, y)
    weight = model.factors[2] @ model.factors[5]
    others = [model.factors[a] @ model.factors[b] for a in range(12) for b in range(a) if {a, b} != {2, 5}]
    assert weight > 0.5 and weight > max(others)
    assert ranked(y, toxicity_fm.margins(model, terms, starts)) > 0.99


@pytest.mark.parametrize("both", [lambda a, b: a != b, lambda a, b: a and b])
def test_a_pair_without_single_terms_is_learnt_from_a_table(spark, documents, labels, both):
    """Whether two words stand together decides, neither of them alone."""
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(60)]
    rows, marks = [], []
    for i in range(800):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        said = rng.sample(words, rng.randint(3, 12)) + ["grumble"] * a + ["lantern"] * b
        rng.shuffle(said)
        rows.append((i, " ".join(said)))
        marks.append((i, None, int(both(a, b)), "", 0.0))
    docs = documents(rows)
    model = toxicity_fm.train(docs, labels(marks))
    held = {r.doc_id: r.s for r in docs.select("doc_id", toxicity_fm.toxicity(model, F.col("text")).alias("s")).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    y = np.array([marks[i][2] for i in held])
    assert ranked(y, np.array(list(held.values()))) > 0.95


def test_training_terms_are_bounded(spark):
    sample = spark.createDataFrame([(f"some words number {i}", float(i % 2)) for i in range(50)], "text string, label double")
    whole, some = ([(bytes(r.terms), r.label) for r in toxicity_fm.sparse_rows(sample, *most).collect()] for most in ((), (200,)))
    assert len(whole) == 50 and 0 < sum(len(t) // 4 for t, _ in some) <= 200 and set(some) <= set(whole)
    assert toxicity_fm.sparse_rows(sample, 0).count() == 0


def test_scores_equal_plain_sums(spark, documents, labels):
    """Every score again from the fitted numbers, term by term, pair by pair, and bin by bin."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    marks = spark.read.parquet(f"{FOLDER}/labels.parquet")
    every = spark.read.parquet(f"{FOLDER}/documents.parquet")
    toxic, good = toxicity_fm.train(every, marks), quality_gam.train(every, marks)
    rows = docs.select("text", toxicity_fm.toxicity(toxic, F.col("text")).alias("t"), quality_gam.quality(good, F.col("text")).alias("q")).collect()
    place = {int(b): i for i, b in enumerate(toxic.chosen)}
    assert len(place) > 20
    for r in rows:
        own = {place[b] for b in toxicity_fm.Terms().of(r.text) if b in place}
        margin = toxic.base + sum(toxic.weights[i] for i in own)
        margin += sum(float(toxic.factors[i] @ toxic.factors[j]) for i in own for j in own if i < j)
        assert abs(r.t - 1 / (1 + np.exp(-margin))) < 1e-9
        values = quality_gam.describe(r.text)
        total = good.base
        for j, v in enumerate(values):
            total += good.tables[j][sum(v >= c for c in good.cuts[j])]
        for (i, j), own_table in zip(good.pairs, good.pair_tables, strict=True):
            total += own_table[sum(values[i] >= c for c in good.pair_cuts[i])][sum(values[j] >= c for c in good.pair_cuts[j])]
        assert abs(r.q - 1 / (1 + np.exp(-total))) < 1e-9


def test_terms():
    terms = toxicity_fm.Terms()
    assert terms.of("Idiot, IDIOT!") == terms.of("idiot") and terms.of(None) == terms.of(" .,") == []
    chosen = np.array(sorted(terms.of("idiot")))
    assert toxicity_fm.Terms(chosen).of("an idiot said") == list(range(len(chosen)))


def test_features_are_finite():
    rng = random.Random(1)
    for text in (None, "", " \n ", "a", "\x00" * 9, "!!!", "A" * 10_000, "é日😀", "\n\n", "".join(map(chr, (rng.randint(0, 900) for _ in range(500))))):
        values = quality_gam.describe(text)
        assert len(values) == len(quality_gam.FEATURES) and np.isfinite(values).all()
