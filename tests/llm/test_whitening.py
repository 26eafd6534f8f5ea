import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from row_helpers import by

from wharfline.llm import whitening


@pytest.fixture(scope="module")
def embeddings(spark):
    def made(rows):
        full = [(i, None if v is None else [None if c is None else float(c) for c in v], "x", 1) for i, v in rows]
        return spark.createDataFrame(full, "vec_id long, embedding array<double>, x string, component int")

    return made


def plain(rows, wanted=4):
    """Eigenvectors of the covariance of the different integer vectors, by numpy."""
    usable = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    distinct = np.array(sorted({tuple(x) for _, x in usable}), float)
    n, mean = len(distinct), distinct.mean(axis=0)
    values, vectors = np.linalg.eigh((distinct - mean).T @ (distinct - mean) / n)
    sums = [sum(int(r[k]) for r in distinct) for k in range(distinct.shape[1])]
    out = {}
    for i, x in usable:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        for k in range(min(wanted, len(values))):
            if values[-1 - k] > 1e-12 * values[-1]:
                out.setdefault((i, k + 1), []).append((n, deviation, abs((np.array(x) - mean) @ vectors[:, -1 - k]) / math.sqrt(values[-1 - k]), values[-1 - k] / values.sum()))
    return out


def check(embeddings, rows, tolerance=1e-9):
    got, want = whitening.whiten(embeddings(rows)).collect(), plain(rows)
    assert len(got) == sum(map(len, want.values())) > 0
    for r in got:
        same = [w for w in want[r["vec_id"], r["component"]] if w[:2] == (r["n"], r["deviation"])]
        assert same and r["identity_error"] < 1e-10 and abs(r["explained"] - same[0][3]) < 1e-12
        assert any(abs(abs(r["whitened"]) - w[2]) < tolerance for w in same)
    return got


def test_whitening_equals_eigenvectors(embeddings):
    rng = np.random.default_rng(0)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(300, 20)) * np.linspace(1, 3, 20) + 7)]
    rows += [(1000 + i, rows[i][1]) for i in range(40)] + [(7, rows[9][1]), (None, rows[3][1])]  # copies count once
    rows += [(2000, None), (2001, [None] * 20), (2002, [math.nan] * 20), (2003, [math.inf] * 20), (2004, [1.0] * 3), (2005, [])]
    usable = [r for r in rows if r[0] is None or r[0] < 2004]
    got = check(embeddings, usable)
    again = whitening.whiten(embeddings(rows))
    assert sorted(map(str, again.collect())) == sorted(map(str, got)) or again.count() == len(got)
    signs = {(r["vec_id"], r["component"]): r["whitened"] for r in got}
    assert abs(np.corrcoef([signs[i, 1] for i in range(300)], [signs[i, 2] for i in range(300)])[0, 1]) < 0.1


def test_large_means_lose_no_digits(embeddings):
    rng = np.random.default_rng(1)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(60, 5)) * [5, 4, 3, 2, 1] + 1e9)]
    usable = whitening.whiten(embeddings(rows))
    shifted = whitening.whiten(embeddings([(i, np.asarray(v) - 1e9) for i, v in rows]))
    a, b = ({(r["vec_id"], r["component"]): r for r in f.collect()} for f in (usable, shifted))
    assert all(abs(a[k]["whitened"] - b[k]["whitened"]) < 0.02 and a[k]["identity_error"] < 1e-9 for k in a)


def test_equal_eigenvalues_are_all_found(embeddings):
    """Points on the axes: every direction has the same deviation."""
    rows = [(2 * k + s, [(1 - 2 * s) * (j == k) for j in range(6)]) for k in range(6) for s in range(2)]
    got = by(whitening.whiten(embeddings(rows)), "vec_id", "component")
    assert len(got) == 12 * 4 and {round(r["explained"], 12) for r in got} == {round(1 / 6, 12)}
    assert max(r["identity_error"] for r in got) < 1e-12


def test_few_vectors_have_few_components(embeddings):
    got = whitening.whiten(embeddings([(1, [0, 0, 0, 5]), (2, [1, 0, 0, 5]), (3, [0, 1, 0, 5])])).collect()
    assert {r["component"] for r in got} == {1, 2} and len(got) == 6
    assert abs(sum(r["explained"] for r in got if r["vec_id"] == 1) - 1) < 1e-12
    assert whitening.whiten(embeddings([(1, [1, 2]), (2, [1, 2])])).collect() == []
    assert whitening.whiten(embeddings([(1, None), (2, [])])).collect() == []
    assert whitening.whiten(embeddings([])).collect() == []


def test_one_dimension(embeddings):
    check(embeddings, [(i, [i * i]) for i in range(9)])


def test_deviations_above_a_long_are_null(embeddings):
    rows = [(1, [1e300]), (2, [-1e300]), (3, [0.0])]
    assert {r["deviation"] for r in whitening.whiten(embeddings(rows)).collect() if r["vec_id"] < 3} == {None}


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 40), st.lists(st.lists(st.integers(-(2**31), 2**31) | st.integers(-9, 9), min_size=3, max_size=3), min_size=1, max_size=6))
def test_deviations_are_exact(n, rows):
    sums = [sum(r[k] for r in rows) for k in range(3)]
    got = whitening.deviations(
        np.array(rows, np.int64), n, sums, np.array([s // n for s in sums], np.int64), np.array([s % n / n for s in sums])
    )
    exact = [sum((n * x - s) ** 2 for x, s in zip(r, sums, strict=True)) for r in rows]
    assert got == [e if e < 2**63 else None for e in exact]


def bidiagonal(matrix, wanted=4, seed=0):
    run, steps = whitening.Bidiagonal(matrix.shape[1], np.random.default_rng(seed), wanted), 0
    while not run.done:
        p = matrix @ run.direction()
        run.take(matrix.T @ p, float(p @ p))
        steps += 1
    return run, steps


def test_bidiagonalisation_keeps_right_angles():
    matrix = np.random.default_rng(2).normal(size=(500, 40)) * np.logspace(0, -8, 40)
    run, steps = bidiagonal(matrix)
    v, w = np.stack(run.v[: len(run.alpha)], axis=1), np.stack(run.w, axis=1)
    u = matrix @ w
    assert np.abs(v.T @ v - np.eye(v.shape[1])).max() < 1e-13
    assert np.abs(u.T @ u - np.eye(u.shape[1])).max() < 1e-6  # U is X W, and X is nearly singular
    assert np.abs(matrix @ v - u @ run.matrix()).max() < 1e-12
    _, _, right = np.linalg.svd(matrix, full_matrices=False)
    assert np.abs(np.abs((run.vectors() * right[:4].T).sum(axis=0)) - 1).max() < 1e-12 and steps < 30


def test_a_vanishing_beta_starts_anew():
    run, steps = bidiagonal(np.diag([3.0, 3.0, 2.0, 1.0, 1.0, 0.0, 0.0]))
    assert np.allclose(np.linalg.svd(run.matrix())[1][:4], [3, 3, 2, 1]) and steps <= 7
