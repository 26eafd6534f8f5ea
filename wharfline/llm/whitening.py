"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries become integers (``floor(SCALE * c)``). Each different vector is a row of X
once; X is centred and never squared into a covariance matrix. From a start v the
iteration alternates two products,

    p = X v_j - beta_{j-1} u_{j-1},   alpha_j = |p|, u_j = p / alpha_j
    r = X' u_j - alpha_j v_j,         beta_j  = |r|, v_{j+1} = r / beta_j

with full reorthogonalisation of p against all u and of r against all v, so that
X V = U B with a small upper bidiagonal B. Its singular values are deviations along the
components, V times its right singular vectors the components.

The u are as long as the corpus, but every u is X w for a w as short as a vector. So
U is kept as W, and one pass over the rows gives both products: a task computes
p = X q for its rows and sends back X' p and |p|^2, a number per dimension. Inner products
with all u follow on the driver, as u_i . p = w_i . X' p. What the driver and the
broadcasts hold grows with dimensions times steps, not with rows; a pass reads the
integer rows from blocks written once. A lost task is run again by itself.

One start finds one vector per eigenvalue, however often that occurs. So as many
starts as wanted components run side by side in the same passes, and a last product
settles which of their vectors are the leading ones (Rayleigh-Ritz). An iteration ends
when its leading residuals, beta_k times the last entries of the left singular
vectors, vanish, or when it spans all dimensions; where beta vanishes first, it goes
on from a new start at right angles to all v.

Defined cases: null vectors and those with null or non-finite entries are dropped;
so are vectors of another length than most (ties: the longer), as they have no
common components; a null vec_id is kept as it is, repeated rows each have their rows of
the result; extra columns are not read. Components of no deviation (fewer different
vectors than components, constant dimensions) are left out, so equal vectors alone
and empty tables give no rows. A deviation that exceeds a long is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wharfline.functions.durable import durable
from wharfline.llm.common import query, table

SCALE = 256  # fixed by the result contract
COMPONENTS = 4  # fixed by the result contract
BLOCK_BYTES = 1 << 22
TASK_BYTES = 1 << 26
CONVERGED = 1e-13  # residual, as a part of the largest singular value
VANISHED = 1e-12  # an eigenvalue, as a part of the largest one
SEED = 11


# ----------------------------------------------------------------- fit list


def whole_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and x: integer vectors of usable rows."""
    entry = F.col("embedding")
    finite = ~F.exists(entry, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole: Callable[[Column], Column] = lambda c: F.floor(c.cast("double") * scale).cast("long")
    return embeddings.where(F.coalesce(finite, F.lit(False))).select("vec_id", F.transform(entry, whole).alias("x"))


def packed_rows(vectors: DataFrame, width: int) -> DataFrame:
    """Vectors in blocks: the number of rows and their entries, in as few bytes as they need."""
    at_once = max(1, BLOCK_BYTES // (8 * width))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).flatten().to_numpy().reshape(-1, width)
            for at in range(0, len(rows), at_once):
                part = rows[at : at + at_once]
                low, high = int(part.min()), int(part.max())
                kind = next(k for k in ("<i2", "<i4", "<i8") if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind]), pa.array([part.astype(kind).tobytes()], pa.binary())], names=["kind", "data"]
                )

    return vectors.select("x").mapInArrow(blocks, "kind string, data binary")


def _rows_of(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    for kind, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        yield np.frombuffer(data, kind).reshape(-1, width)


@dataclass
class FitList:
    """Blocks of the different vectors, their number, the sums of their dimensions, and how many tasks read them."""

    blocks: DataFrame
    width: int
    n: int
    sums: list[int]
    tasks: int = 1

    @property
    def middle(self) -> np.ndarray:
        """Whole part of the mean."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """What the mean has beyond its whole part."""
        return np.array([s % self.n / self.n for s in self.sums])

    def total(self, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
        """The sum of ``part(centred rows)`` over all rows, as an array of the given shape."""
        width, middle, rest, size = self.width, self.middle, self.rest, int(np.prod(shape))

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = None
            for batch in batches:
                for rows in _rows_of(batch, width):
                    own = part(centred(rows, middle, rest)).reshape(-1)
                    out = own if out is None else out + own
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(out)], names=["place", "value"])

        added = self.blocks.coalesce(self.tasks).mapInArrow(summed, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
        out = np.zeros(size)
        for row in added.collect():  # as many rows as the array has entries
            out[row["place"]] = row["value"]
        return out.reshape(shape)

    def product(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """X'Xq / n and the squared lengths of Xq / sqrt(n), for each column of q."""

        def both(rows: np.ndarray) -> np.ndarray:
            p = rows @ q
            return np.vstack((rows.T @ p, (p * p).sum(axis=0)))

        out = self.total(both, (self.width + 1, q.shape[1])) / self.n
        return out[:-1], out[-1]


def centred(rows: np.ndarray, middle: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Rows less their mean. The whole part goes first, as integers, so large means cost no digits."""
    if rows.itemsize == 8 and max(abs(int(rows.min(initial=0))), abs(int(rows.max(initial=0)))) >= 2**62:
        return rows.astype(np.float64) - middle - rest
    return (rows - middle) - rest


def fit_list(vectors: DataFrame) -> FitList | None:
    """Each different vector once, and exact sums; None where there is none."""
    lengths = vectors.where(F.size("x") > 0).groupBy(F.size("x").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("width")).first()
    if most is None:
        return None
    width = int(most["width"])
    blocks = durable(packed_rows(vectors.where(F.size("x") == width).select("x").distinct(), width))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, size, sums = 0, 0, [0] * width
        for batch in batches:
            for rows in _rows_of(batch, width):
                n, size = n + len(rows), size + rows.nbytes
                # Halves of 32 bits add up without overflow in a block of any size.
                high, low = (rows.astype(np.int64) >> 32).sum(axis=0), (rows.astype(np.int64) & 0xFFFFFFFF).sum(axis=0)
                sums = [s + (int(h) << 32) + int(m) for s, h, m in zip(sums, high, low, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width + 2)), pa.array([str(s) for s in [*sums, n, size]])], names=["place", "sum"])

    parts = blocks.mapInArrow(added, "place long, sum string")
    found = parts.groupBy("place").agg(F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum")).collect()
    exact = {r["place"]: int(r["sum"]) for r in found}
    # Passes are many: a few tasks of many blocks each, however many partitions the shuffle had.
    return FitList(blocks, width, exact[width], [exact[i] for i in range(width)], -(-exact[width + 1] // TASK_BYTES))


# ----------------------------------------------------------- bidiagonalisation


def _at_right_angles(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """v less its parts along an orthonormal basis; twice, as rounding leaves some the first time."""
    if basis:
        b = np.stack(basis)
        for _ in range(2):
            v = v - (b @ v) @ b
    return v


class Bidiagonal:
    """One iteration. ``direction`` says what to multiply next, ``take`` takes the product."""

    def __init__(self, width: int, rng: np.random.Generator, wanted: int):
        self.width, self.rng, self.wanted = width, rng, wanted
        self.v: list[np.ndarray] = []
        self.w: list[np.ndarray] = []  # u = X w
        self.t: list[np.ndarray] = []  # X' u
        self.alpha: list[float] = []
        self.beta: list[float] = []
        self.largest = 0.0
        self.done = not self._start_anew()

    def _start_anew(self) -> bool:
        if len(self.v) == self.width:
            return False
        fresh = _at_right_angles(self.rng.standard_normal(self.width), self.v)
        self.v.append(_at_right_angles(fresh / np.linalg.norm(fresh), self.v))
        self.v[-1] /= np.linalg.norm(self.v[-1])
        self.fresh = True
        return True

    def direction(self) -> np.ndarray:
        if self.done:
            return np.zeros(self.width)
        return self.v[-1] if self.fresh else self.v[-1] - self.beta[-1] * self.w[-1]

    def take(self, z: np.ndarray, square: float) -> None:
        """z = X' p and square = p . p of p = X times ``direction``."""
        if self.done:
            return
        q = self.direction()
        if self.w:
            w, t = np.stack(self.w), np.stack(self.t)
            for _ in range(2):
                along = w @ z  # u_i . p
                q, z, square = q - along @ w, z - along @ t, square - float(along @ along)
        alpha = float(np.sqrt(max(square, 0.0)))
        self.largest = max(self.largest, alpha)
        if alpha <= CONVERGED * self.largest:
            if self.fresh:  # a random direction that X does not see: X sees nothing else
                self.v.pop()
                self.done = True
                return
            alpha, q, z = 0.0, np.zeros_like(q), np.zeros_like(z)
        else:
            q, z = q / alpha, z / alpha
        self.w.append(q), self.t.append(z), self.alpha.append(alpha)
        r = _at_right_angles(z - alpha * self.v[-1], self.v)
        beta = float(np.linalg.norm(r))
        self.largest = max(self.largest, beta)
        ended = len(self.v) == self.width
        if ended or beta <= CONVERGED * self.largest:
            self.beta.append(0.0)
            self.done = ended or not self._start_anew()
            return
        self.fresh = False
        self.beta.append(beta)
        left, sigma, _ = np.linalg.svd(self.matrix())
        self.largest = max(self.largest, float(sigma[0]))
        if len(self.alpha) > self.wanted and (beta * np.abs(left[-1, : self.wanted]) <= CONVERGED * sigma[0]).all():
            self.done = True
            return
        self.v.append(r / beta)

    def matrix(self) -> np.ndarray:
        """B, upper bidiagonal."""
        return np.diag(self.alpha) + np.diag(self.beta[: len(self.alpha) - 1], 1)

    def vectors(self) -> np.ndarray:
        """The leading right singular vectors as columns."""
        if not self.alpha:
            return np.zeros((self.width, 0))
        _, _, right = np.linalg.svd(self.matrix())
        return np.stack(self.v[: len(self.alpha)]).T @ right[: self.wanted].T


@dataclass
class Whitening:
    """Components as columns, their eigenvalues, their parts of the trace, and how far the result is from white."""

    fit: FitList
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float


def components(fit: FitList, wanted: int = COMPONENTS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The leading eigenvectors of the covariance as columns, and their eigenvalues, falling."""
    runs = [Bidiagonal(fit.width, np.random.default_rng([seed, i]), wanted) for i in range(wanted)]
    while not all(run.done for run in runs):
        z, squares = fit.product(np.stack([run.direction() for run in runs], axis=1))
        for i, run in enumerate(runs):
            run.take(z[:, i], float(squares[i]))
    found = np.hstack([run.vectors() for run in runs])
    if not found.shape[1]:
        return np.zeros((fit.width, 0)), np.zeros(0)
    # Runs agree on simple eigenvalues; their common span, then the best of it.
    basis, size, _ = np.linalg.svd(found, full_matrices=False)
    basis = basis[:, size > 1e-6]
    z, _ = fit.product(basis)
    inner = basis.T @ z
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    first = np.argsort(-values, kind="stable")[:wanted]
    values, vectors = values[first], basis @ turn[:, first]
    some = values > VANISHED * values[0] if values[0] > 0 else np.zeros(len(values), bool)
    vectors, values = vectors[:, some], values[some]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return vectors * signs, values


def whitening(fit: FitList, wanted: int = COMPONENTS, seed: int = SEED) -> Whitening:
    """Components with their figures, measured on the whole fit list."""
    vectors, values = components(fit, wanted, seed)
    k = len(values)
    if not k:
        return Whitening(fit, vectors, values, values, 0.0)
    scaled = vectors / np.sqrt(values)
    trace = float(fit.total(lambda rows: np.array([(rows * rows).sum()]), (1,))[0]) / fit.n
    mean = fit.total(lambda rows: (rows @ scaled).sum(axis=0), (k,)) / fit.n

    def products(rows: np.ndarray) -> np.ndarray:
        own = rows @ scaled - mean
        return own.T @ own

    error = float(np.abs(fit.total(products, (k, k)) / fit.n - np.eye(k)).max())
    return Whitening(fit, vectors, values, values / trace, error)


# -------------------------------------------------------------------- result


def deviations(rows: np.ndarray, n: int, sums: list[int], middle: np.ndarray, rest: np.ndarray) -> list[int | None]:
    """Sum of (n x - S)^2 per row, exact; None above a long."""
    about = ((centred(rows, middle, rest) * float(n)) ** 2).sum(axis=1)
    # 64-bit arithmetic wraps around, so it is exact wherever the result fits in.
    wrap = (1 << 64) - 1
    s = np.array([x & wrap for x in sums], np.uint64)
    off = rows.astype(np.int64).view(np.uint64) * np.uint64(n & wrap) - s
    out: list[int | None] = (off * off).sum(axis=1, dtype=np.uint64).tolist()
    for i in np.flatnonzero(about > 0.99 * 2**63).tolist():
        exact = sum((n * int(x) - t) ** 2 for x, t in zip(rows[i].tolist(), sums, strict=True)) if about[i] < 1.01 * 2**63 else 2**63
        out[i] = exact if exact < 2**63 else None
    return out


def whitened(vectors: DataFrame, model: Whitening) -> DataFrame:
    """Per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    fit, k = model.fit, len(model.eigenvalues)
    width, n, sums, middle, rest = fit.width, fit.n, fit.sums, fit.middle, fit.rest
    scaled, explained, error = model.components / np.sqrt(model.eigenvalues), model.explained, model.identity_error

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1).flatten().to_numpy().reshape(-1, width)
            each, every = np.repeat(np.arange(len(rows)), k), np.tile(np.arange(k), len(rows))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)), pa.array((every + 1).astype(np.int32)), pa.array(np.full(len(each), n)),
                    pa.array(deviations(rows, n, sums, middle, rest), pa.int64()).take(pa.array(each)),
                    pa.array((centred(rows, middle, rest) @ scaled).reshape(-1)), pa.array(explained[every]),
                    pa.array(np.full(len(each), error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return vectors.where(F.size("x") == width).where(F.lit(k > 0)).mapInArrow(projected, schema)


def whiten(embeddings: DataFrame, wanted: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """Rows of embeddings projected on their leading components, each to deviation one."""
    vectors = whole_vectors(embeddings.select("vec_id", "embedding"), scale)
    fit = fit_list(vectors)
    if fit is None:
        fit = FitList(vectors, 1, 1, [0])
        return whitened(vectors, Whitening(fit, np.zeros((1, 0)), np.zeros(0), np.zeros(0), 0.0))
    return whitened(vectors, whitening(fit, wanted))


@query("op11_whitening")
def op11_whitening(spark, folder):
    return whiten(table(spark, folder, "embeddings"))
