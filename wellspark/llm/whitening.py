"""Whitening of embeddings by a pivoted Cholesky factor and one-sided Jacobi rotations.

Entries become whole numbers x = floor(1024 * c) + 100000, so counts and sums are exact. The
scatter of the centred vectors is summed by tasks over all rows; only its width x width numbers
reach the driver. There it is factored, P'VP = LL', with the largest remaining variance as pivot.
One-sided Jacobi turns pairs of L's columns until all are orthogonal: the squared norms are the
eigenvalues, the normalised columns the components. V itself is never rotated, so small
eigenvalues keep their digits.

Defined results: vectors that are null, or hold null, NaN, infinite or out-of-range entries (2**52
and more, for which x is no long) are left out, also vectors without entries and those of another
width than most (of two widths that are as frequent, the larger counts). Repeated rows and rows
without an id count and return like others. Components of no variance are not returned: equal
vectors, or a single one, give none. An empty table gives no rows. ``deviation`` is exact; it is
null where it has more than 38 digits. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspark.llm.rows import named
from wellspark.llm.vectors import finite, listed, matrices, usual_width

SCALE = 1024
SHIFT = 100_000
#: Entries below this give a long.
BELOW = 2.0**52
COMPONENTS = 8
#: Cosine of two columns that counts as orthogonal, and the most rounds over all pairs.
ORTHOGONAL = 1e-15
SWEEPS = 60


@dataclass(frozen=True)
class Whitening:
    """A fitted model; ``components`` has one column for each, by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def width(self) -> int:
        return len(self.sums)


def whole(vectors: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * vectors).astype(np.int64) + SHIFT


def _exact_sums(x: np.ndarray) -> np.ndarray:
    small = int(np.abs(x).max(initial=0)) < (1 << 62) // max(1, len(x))
    return (x if small else x.astype(object)).sum(axis=0).astype(object)


def _centring(n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The whole part of the mean, and what is left of it."""
    low = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([s % n for s in sums], dtype=object)
    return low, rest


def _centred(x: np.ndarray, n: int, low: np.ndarray, rest: np.ndarray) -> np.ndarray:
    return (x - low).astype(np.float64) - (rest / n).astype(np.float64)


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, int]:
    """(vec_id, embedding) of the vectors that take part, and their width."""
    good = vectors.select(named(vec_id).alias("vec_id"), named(embedding).alias("embedding"))
    good = good.where(finite(F.col("embedding"), BELOW))
    width = usual_width(good, F.col("embedding"))
    return good.where((F.size("embedding") == width) & (F.size("embedding") > 0)), width


def exact_sums(vectors: DataFrame, width: int) -> tuple[int, tuple[int, ...]]:
    """The number of vectors and the sum of each entry over them."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, dtype=object)
        for _, some in matrices(batches, 0, width):
            x = whole(some)
            n, total = n + len(x), total + _exact_sums(x)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(width), pa.int32()),
                pa.array(np.full(width, n), pa.int64()),
                pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0)),
            ],
            ["entry", "n", "total"],
        )

    parts = vectors.select("embedding").mapInArrow(partial, "entry int, n long, total decimal(38,0)")
    # One row for each entry of a vector, whatever the number of vectors.
    rows = parts.groupBy("entry").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    by_entry = {r.entry: r for r in rows}
    if not by_entry:
        return 0, ()
    return by_entry[0].n, tuple(int(by_entry[i].total) for i in range(width))


def scatter(vectors: DataFrame, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """The sum over all vectors of the products of their centred entries."""
    width = len(sums)
    low, rest = _centring(n, sums)
    above = np.triu_indices(width)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for _, some in matrices(batches, 0, width):
            y = _centred(whole(some), n, low, rest)
            total += y.T @ y
        yield pa.RecordBatch.from_arrays(
            [pa.array(above[0], pa.int32()), pa.array(above[1], pa.int32()), pa.array(total[above])],
            ["i", "j", "value"],
        )

    parts = vectors.select("embedding").mapInArrow(partial, "i int, j int, value double")
    out = np.zeros((width, width))
    for r in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        out[r.i, r.j] = out[r.j, r.i] = r.value
    return out


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, L) with a[order][:, order] = L L', as many columns as ``a`` has rank."""
    size = len(a)
    order = np.arange(size)
    factor = np.zeros((size, size))
    left = a.diagonal().copy()
    least = size * np.finfo(float).eps * left.max(initial=0.0)
    for k in range(size):
        pivot = k + int(np.argmax(left[k:]))
        if left[pivot] <= least:
            return order, factor[:, :k]
        for part in (order, left, factor):
            part[[k, pivot]] = part[[pivot, k]]
        factor[k, k] = np.sqrt(left[k])
        known = factor[k + 1 :, :k] @ factor[k, :k]
        factor[k + 1 :, k] = (a[order[k + 1 :], order[k]] - known) / factor[k, k]
        left[k + 1 :] -= factor[k + 1 :, k] ** 2
    return order, factor


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """``factor`` times a rotation that makes its columns orthogonal.

    A round meets every column with one other, so its rotations are independent of each other and
    done together; the columns then move on as in a round-robin tournament.
    """
    columns = factor.shape[1]
    even = columns + columns % 2
    out = np.zeros((len(factor), even))
    out[:, :columns] = factor
    seats = np.arange(even)
    for _ in range(SWEEPS if columns > 1 else 0):
        turned = False
        for _ in range(even - 1):
            p, q = seats[: even // 2], seats[even // 2 :][::-1]
            a, b = out[:, p], out[:, q]
            aa, bb, ab = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            skew = np.abs(ab) > ORTHOGONAL * np.sqrt(aa * bb)
            if skew.any():
                turned = True
                p, q, a, b = p[skew], q[skew], a[:, skew], b[:, skew]
                zeta = (bb[skew] - aa[skew]) / (2 * ab[skew])
                tangent = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                cosine = 1 / np.hypot(1.0, tangent)
                out[:, p], out[:, q] = cosine * (a - tangent * b), cosine * (tangent * a + b)
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if not turned:
            break
    return out[:, :columns]


def fitted(vectors: DataFrame, width: int) -> Whitening:
    """The model of all ``vectors`` of ``usable``: three aggregates of the width's size."""
    n, sums = exact_sums(vectors, width)
    if not n:
        return Whitening(0, sums, np.zeros(0), np.zeros((width, 0)), 0.0)
    spread = scatter(vectors, n, sums)
    order, factor = pivoted_cholesky(spread)
    turned = one_sided_jacobi(factor)
    norms = np.sqrt((turned * turned).sum(axis=0))
    falling = np.argsort(-norms, kind="stable")
    components = np.zeros_like(turned)
    components[order] = turned[:, falling] / norms[falling]
    return Whitening(n, sums, norms[falling] ** 2 / n, components, float(np.trace(spread)) / n)


def transformed(vectors: DataFrame, model: Whitening, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, deviation decimal, whitened array<double>) of vectors of the model's width."""
    used = min(components, len(model.eigenvalues))
    schema = T.StructType(
        [
            vectors.schema["vec_id"],
            T.StructField("deviation", T.DecimalType(38, 0)),
            T.StructField("whitened", T.ArrayType(T.DoubleType())),
        ]
    )
    if not model.n:
        return vectors.sparkSession.createDataFrame([], schema)
    low, rest = _centring(model.n, model.sums)
    turn = model.components[:, :used] / np.sqrt(model.eigenvalues[:used])
    n, width, most = model.n, model.width, 10**38

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, some in matrices(batches, 1, width):
            x = whole(some)
            far = (int(np.abs(x - low).max(initial=0)) + 1) * n
            z = x - low if width * far * far < 1 << 63 else (x - low).astype(object)
            z = z * n - (rest.astype(np.int64) if z.dtype != object else rest)
            deviation = [Decimal(int(v)) if v < most else None for v in (z * z).sum(axis=1)]
            made = _centred(x, n, low, rest) @ turn
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(deviation, pa.decimal128(38, 0)), listed(made, pa.float64())],
                schema.names,
            )

    return vectors.select("vec_id", "embedding").mapInArrow(run, schema)


def identity_error(vectors: DataFrame, model: Whitening, components: int = COMPONENTS) -> float:
    """The largest absolute entry of the covariance of what ``transformed`` gives, less the
    identity; measured over all rows. The whitened values are centred, as the vectors were."""
    used = min(components, len(model.eigenvalues))
    if not used:
        return 0.0

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((used, used))
        for _, w in matrices(batches, 0, used):
            total += w.T @ w
        i, j = np.indices((used, used)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], ["i", "j", "value"]
        )

    made = transformed(vectors, model, components).select("whitened")
    parts = made.mapInArrow(partial, "i int, j int, value double")
    rows = parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
    return max(abs(r.value / model.n - (r.i == r.j)) for r in rows)


def whitened(
    vectors: DataFrame,
    *,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """For each vector that takes part and each component: vec_id, component (from 1), n,
    deviation (decimal), whitened, explained and identity_error."""
    good, width = usable(vectors, vec_id, embedding)
    model = fitted(good, width)
    error = identity_error(good, model, components)
    used = min(components, len(model.eigenvalues))
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues[:used]])
    return (
        transformed(good, model, components)
        .select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
        .select(
            "vec_id",
            (F.col("place") + 1).alias("component"),
            F.lit(model.n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(shares, F.col("place")).cast("double").alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
