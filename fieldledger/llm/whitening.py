"""Embedding whitening: Jacobi-Davidson on a covariance that is never formed, only multiplied with."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fieldledger.llm.store import keep
from fieldledger.llm.vectors import is_usable, matrix, whole_vector
from fieldledger.operators.columns import quoted

SLICE_VALUES = 1 << 20
EPS = float(np.finfo(float).eps)


@dataclass(frozen=True)
class Center:
    """Number of rows and the exact sum of each dimension."""

    n: int
    sums: tuple[int, ...]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - sums / n``: the whole part is taken off in longs, so no digit is lost however far the mean is from 0."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([float(Fraction(s % self.n, self.n)) for s in self.sums])
        return (x - whole).astype(float) - rest

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Exact sum over dimensions of ``(n * x - sums) ** 2`` of each row, in longs where all fit, else in big numbers."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([s % self.n for s in self.sums], dtype=np.int64)
        off = x - whole
        most = (int(np.abs(off).max(initial=0)) + 1) * self.n
        if x.shape[1] * most * most < 1 << 63:
            total = ((off * self.n - rest) ** 2).sum(axis=1)
        else:
            total = ((off.astype(object) * self.n - rest.astype(object)) ** 2).sum(axis=1)
            return pa.array([str(t) for t in total], pa.string()).cast(pa.decimal128(38, 0))
        return pa.array(total, pa.int64()).cast(pa.decimal128(38, 0))


def slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of batches with their vectors as a matrix of about ``SLICE_VALUES`` numbers."""
    step = max(1, SLICE_VALUES // max(1, width))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield part, matrix(part.column("x"), width)


def center_of(rows: DataFrame) -> Center:
    """Row count and sums; raises if vectors differ in length."""
    n, least, most = rows.agg(F.count(F.lit(1)), F.min(F.size("x")), F.max(F.size("x"))).first()
    if least != most:
        raise ValueError(f"Vectors have {least} to {most} components; whitening needs one length")
    if not n:
        return Center(0, ())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(most, dtype=object)
        for _, x in slices(batches, most):
            total = total + x.sum(axis=0).astype(object)
        at = pa.array(range(most), pa.int32())
        yield pa.RecordBatch.from_arrays([at, pa.array([str(t) for t in total], pa.string()).cast(pa.decimal128(38, 0))], ["at", "s"])

    parts = rows.select("x").mapInArrow(run, "at int, s decimal(38,0)")
    sums = {r["at"]: int(r["s"]) for r in parts.groupBy("at").agg(F.sum("s").alias("s")).collect()}
    return Center(n, tuple(sums[d] for d in range(most)))


def summed(rows: DataFrame, width: int, shape: tuple[int, int], add: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of what ``add`` gives for a slice of them, a matrix of ``shape``.

    A task sends one matrix, a row of it per record; records are summed by Spark, so the driver gets ``shape`` numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for _, x in slices(batches, width):
            total += add(x)
        yield pa.RecordBatch.from_arrays([pa.array(range(shape[0]), pa.int32()), pa.array(list(total))], ["at", "part"])

    parts = rows.select("x").mapInArrow(run, "at int, part array<double>")
    each = [F.sum(F.get("part", F.lit(k))).alias(f"s{k}") for k in range(shape[1])]
    out = np.zeros(shape)
    for r in parts.groupBy("at").agg(*each).collect():
        out[r["at"]] = r[1:]
    return out


def centred_product(rows: DataFrame, center: Center, block: np.ndarray) -> np.ndarray:
    """The covariance times a block of vectors, from the rows: the mean of ``y (y . block)`` over centred rows ``y``."""

    def add(x: np.ndarray) -> np.ndarray:
        y = center.centred(x)
        return y.T @ (y @ block)

    return summed(rows, len(center.sums), block.shape, add) / center.n


def orthogonal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Orthonormal vectors that span what of ``block`` is not in the span of ``against``."""
    for _ in range(2):
        block = block - against @ (against.T @ block)
        norms = np.linalg.norm(block, axis=0)
        block = block[:, norms > 0] / norms[norms > 0]
    if not block.size:
        return block
    u, s, _ = np.linalg.svd(block, full_matrices=False)
    u = u[:, s > 1e-8 * s[0]]
    u = u - against @ (against.T @ u)
    return np.linalg.qr(u)[0]


def minres(operator: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, goal: float) -> np.ndarray:
    """Minimal residual solutions of one symmetric system per column, all advanced by one product a step.

    The Lanczos recurrence of each column is reduced by plane rotations as it grows; columns end when their residual has
    fallen to ``goal`` of the right side.
    """

    def over(a, b):
        return np.divide(a, b, out=np.zeros_like(a), where=b > 0)

    n_cols = right.shape[1]
    beta = first = np.linalg.norm(right, axis=0)
    old, new = np.zeros_like(right), over(right, np.broadcast_to(beta, right.shape))
    cosine, sine = -np.ones(n_cols), np.zeros(n_cols)
    diagonal, above = np.zeros(n_cols), np.zeros(n_cols)
    left = first.copy()
    solution = np.zeros_like(right)
    direction, before = np.zeros_like(right), np.zeros_like(right)
    for step in range(steps):
        image = operator(new) - (beta if step else 0) * old
        alpha = (image * new).sum(axis=0)
        image = image - alpha * new
        beta = np.linalg.norm(image, axis=0)
        # The two rotations before act on the new column of the tridiagonal matrix, a third one clears what is below it.
        far, near, corner = above, cosine * diagonal + sine * alpha, sine * diagonal - cosine * alpha
        above, diagonal = sine * beta, -cosine * beta
        length = np.hypot(corner, beta)
        cosine, sine = over(corner, length), over(beta, length)
        direction, before = over(new - far * before - near * direction, np.broadcast_to(length, right.shape)), direction
        solution = solution + (cosine * left) * direction
        left = sine * left
        old, new = new, over(image, np.broadcast_to(beta, right.shape))
        if (left <= goal * first).all():
            break
    return solution


def jacobi_davidson(
    apply: Callable[[np.ndarray], np.ndarray],
    size: int,
    wanted: int,
    tolerance: float = 64 * EPS,
    inner: int = 8,
    goal: float = 0.05,
    most_rounds: int = 200,
    seed: int = 7,
) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric operator on ``size`` numbers, falling, and unit eigenvectors.

    A round takes the Ritz pairs of the subspace, locks the leading ones whose residual is at most ``tolerance`` times the
    largest Ritz value, and adds to the subspace the solutions of the correction equations of the others, projected
    against locked and current vectors and solved by a few steps of MINRES. All columns share one product a step.
    The subspace is cut back to the best Ritz vectors when it is four times the vectors sought. A residual that rounding
    keeps above the tolerance counts as converged once three rounds have not made it smaller, if it is below 1e-10.
    """
    random = np.random.default_rng(seed)
    locked = np.zeros((size, 0))
    basis = np.linalg.qr(random.standard_normal((size, wanted)))[0]
    image = apply(basis)
    top, smallest, idle = 0.0, np.inf, 0
    for _ in range(most_rounds):
        ritz = basis.T @ image
        values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        sought = min(wanted - locked.shape[1], basis.shape[1])
        top = max(top, float(values[0]))
        residual = image - basis * values
        residual = residual - locked @ (locked.T @ residual)
        norms = np.linalg.norm(residual[:, :sought], axis=0)
        good = norms <= tolerance * top
        leading = sought if good.all() else int(np.argmin(good))
        worst = float(norms.max(initial=0.0))
        smallest, idle = (worst, 0) if worst < 0.5 * smallest or leading else (smallest, idle + 1)
        if idle >= 3 and worst <= 1e-10 * top:
            leading = sought
        locked = np.hstack([locked, basis[:, :leading]])
        if locked.shape[1] == wanted:
            return _polished(apply, locked)
        keep_ = slice(leading, min(basis.shape[1], leading + 2 * wanted) if basis.shape[1] >= 4 * wanted else None)
        residual = residual[:, leading:sought]
        shifts = values[leading:sought]
        basis, image = basis[:, keep_], image[:, keep_]
        current = np.hstack([locked, basis[:, : sought - leading]])

        def project(block: np.ndarray, out: np.ndarray = current) -> np.ndarray:
            return block - out @ (out.T @ block)

        def operator(block: np.ndarray, shifts: np.ndarray = shifts) -> np.ndarray:
            inside = project(block)
            return project(apply(inside) - inside * shifts)

        right = project(-residual)
        if current.shape[1] < size and np.linalg.norm(right) > 0:
            added = orthogonal(minres(operator, right, min(inner, size - current.shape[1]), goal), np.hstack([locked, basis]))
        else:
            added = np.zeros((size, 0))
        if not added.shape[1]:
            # Nothing new to look at: a fresh direction, or the space is whole and its Ritz pairs are exact but for rounding.
            added = orthogonal(random.standard_normal((size, 1)), np.hstack([locked, basis]))
            if locked.shape[1] + basis.shape[1] >= size:
                image = apply(basis)
                continue
        basis, image = np.hstack([basis, added]), np.hstack([image, apply(added)])
        # Locked vectors stay out of the subspace, also by rounding.
        image = image - locked @ (locked.T @ image)
    raise ArithmeticError(f"{wanted - locked.shape[1]} eigenvectors did not converge in {most_rounds} rounds")


def _polished(apply: Callable[[np.ndarray], np.ndarray], vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ritz pairs of converged vectors, which also puts them in order."""
    vectors = np.linalg.qr(vectors)[0]
    ritz = vectors.T @ apply(vectors)
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    return values[::-1], vectors @ turn[:, ::-1]


@dataclass(frozen=True)
class Whitening:
    """What whitens a row: the centre, unit eigenvectors (columns) and eigenvalues, and the trace of the covariance."""

    center: Center
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.center.centred(x) @ self.vectors / np.sqrt(self.values)


def fit(rows: DataFrame, components: int = 32) -> Whitening:
    """Fit on kept rows ``x``: exact sums, then Jacobi-Davidson with one Spark job per product.

    Components without variance (to rounding) cannot be whitened and are left out.
    """
    center = center_of(rows)
    width = len(center.sums)
    if not width:
        return Whitening(center, np.zeros((0, 0)), np.zeros(0), 0.0)
    values, vectors = jacobi_davidson(lambda block: centred_product(rows, center, block), width, min(components, width))
    squares = summed(rows, width, (1, 1), lambda x: np.array([[(center.centred(x) ** 2).sum()]]))
    given = values > 64 * EPS * width * max(values[0], 0.0)
    return Whitening(center, vectors[:, given], values[given], float(squares[0, 0]) / center.n)


def identity_error(rows: DataFrame, fitted: Whitening) -> float:
    """Largest entry of the covariance of whitened rows, computed from them, less the identity."""
    count = len(fitted.values)

    def add(x: np.ndarray) -> np.ndarray:
        w = fitted.whiten(x)
        return np.vstack([w.T @ w, w.sum(axis=0)])

    got = summed(rows, len(fitted.center.sums), (count + 1, count), add) / fitted.center.n
    cov = got[:-1] - np.outer(got[-1], got[-1])
    return float(np.abs(cov - np.eye(count)).max())


def whiten(
    df: DataFrame,
    components: int = 32,
    scale: int = 64,
    offset: int = 1_000_000,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Whitened components of each row, one row each: ``vec_id``, ``component`` (from 1, falling eigenvalue), ``n``,
    ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Vectors become ``x = floor(scale * c) + offset``, as longs, which are written once. The covariance (divisor ``n``) is never
    formed: each step multiplies it with a block of vectors in one Spark job over all rows, centred first. On the driver
    are the subspace vectors only, some times ``components`` by the dimensions, however many rows there are; a lost
    executor repeats tasks of one product. ``deviation`` is the exact sum of ``(n * x - sums) ** 2``, as decimal(38,0).

    Rows with a null vector or a null or non-finite component take no part. A null id stays null, rows that repeat count
    each and are whitened alike. Vectors of different lengths stop the job, as do components beyond 2**40 when scaled.
    Dimensions without variance add nothing; components without variance have no rows, so one row alone, equal rows and
    an empty table give none. Other columns are not carried.
    """
    named = df.select(quoted(vec_id).alias("id"), quoted(vector).alias("_vector"))
    usable = named.where(is_usable(F.col("_vector")))
    rows = keep(usable.select("id", whole_vector(F.col("_vector"), scale, offset).alias("x")), "whitening-rows")
    fitted = fit(rows, components)
    width, count = len(fitted.center.sums), len(fitted.values)
    error = identity_error(rows, fitted) if count else 0.0
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in slices(batches, width):
            columns = [part.column("id"), fitted.center.deviations(x), pa.array(list(fitted.whiten(x)))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "deviation", "parts"])

    schema = f"id {kind}, deviation decimal(38,0), parts array<double>"
    done = (rows if count else rows.limit(0)).mapInArrow(run, schema)
    share = F.array(*[F.lit(float(v / fitted.trace)) for v in fitted.values]).cast("array<double>")
    return done.select("id", "deviation", F.posexplode("parts").alias("_at", "whitened")).select(
        F.col("id").alias("vec_id"),
        (F.col("_at") + 1).alias("component"),
        F.lit(fitted.center.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(share, F.col("_at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
