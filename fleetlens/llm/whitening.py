"""Whitening of vectors: covariance gathered by Spark, leading eigenvectors by tridiagonalisation.

The fit list is every distinct vector once, on a grid of whole numbers, so that sums are exact. Its centred
covariance is added up per task and then by row of the matrix. The driver holds that matrix alone (its
size is the square of a vector's length, whatever the number of vectors): Householder reflections make it tridiagonal,
Sturm counts bisect for the leading eigenvalues, and inverse iteration gives their vectors, made orthogonal
again within clusters of close eigenvalues. The projection travels to the tasks with their code.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import map_arrow, small_batches, stored

COMPONENTS = 16
# An entry c becomes the whole number floor(64 c) + 1,000,000.
STEPS, ORIGIN = 64, 1_000_000
# Grid values stay within this distance of zero, beyond the reach of any usual vector.
FARTHEST = float(1 << 40)
_EPS = np.finfo(float).eps


@dataclass(frozen=True)
class Whitener:
    n: int
    # Exact sums per dimension over the fit list.
    sums: list[int]
    # One column per component, unit vectors; eigenvalues fall.
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float


def on_grid(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows with a usable vector and its grid values in ``_grid``; null vectors and vectors with
    null or non-finite entries go."""
    values = F.col(vector).cast("array<double>")
    usable = F.forall(values, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))

    def placed(c):
        far = F.least(F.greatest(c * STEPS, F.lit(-FARTHEST)), F.lit(FARTHEST))
        return F.floor(far).cast("bigint") + F.lit(ORIGIN).cast("bigint")

    return rows.where(F.col(vector).isNotNull() & usable).withColumn("_grid", F.transform(values, placed))


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit vectors of the Householder reflections of a symmetric matrix."""
    a = np.array(matrix, dtype=float)
    d = len(a)
    reflections = []
    for k in range(d - 2):
        v = a[k + 1 :, k].copy()
        size = np.linalg.norm(v)
        v[0] += size if v[0] >= 0 else -size
        length = np.linalg.norm(v)
        if size == 0 or length == 0:
            reflections.append(np.zeros(d - k - 1))
            continue
        v /= length
        part = a[k + 1 :, k + 1 :]
        p = part @ v
        w = 2 * (p - (v @ p) * v)
        part -= np.outer(v, w) + np.outer(w, v)
        a[k + 1 :, k] -= 2 * v * (v @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
        reflections.append(v)
    return np.diagonal(a).copy(), np.diagonal(a, -1).copy(), reflections


def _below(diagonal: np.ndarray, squares: np.ndarray, at: np.ndarray, least: float) -> np.ndarray:
    """Sturm count: how many eigenvalues lie below each value of ``at``."""
    q = diagonal[0] - at
    count = (q < 0).astype(int)
    for a, s in zip(diagonal[1:], squares):
        q = np.where(np.abs(q) < least, -least, q)
        q = a - at - s / q
        count += q < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k greatest eigenvalues of a tridiagonal matrix, falling, by bisection down to neighbouring doubles."""
    d = len(diagonal)
    around = np.zeros(d)
    around[:-1] += np.abs(off)
    around[1:] += np.abs(off)
    width = max(float(np.max(np.abs(diagonal) + around)), np.finfo(float).tiny)
    low = np.full(k, float(np.min(diagonal - around)) - width * _EPS * d)
    high = np.full(k, float(np.max(diagonal + around)) + width * _EPS * d)
    # The i-th greatest eigenvalue is below x if more than d - 1 - i lie below x.
    rank = d - np.arange(k)
    least = max(width * _EPS * _EPS, np.finfo(float).tiny)
    for _ in range(200):
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high)):
            break
        under = _below(diagonal, off * off, middle, least) >= rank
        high, low = np.where(under, middle, high), np.where(under, low, middle)
    return low + (high - low) / 2


def _solved(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """(T - shift) x = right by elimination with row exchanges, pivots of zero replaced by ``least``."""
    d = len(diagonal)
    pivot, one, two = diagonal - shift, np.append(off, 0.0), np.zeros(d)
    x = right.copy()
    for i in range(d - 1):
        below, middle, after = off[i], pivot[i + 1], one[i + 1]
        if abs(pivot[i]) >= abs(below):
            if abs(pivot[i]) < least:
                pivot[i] = least
            factor = below / pivot[i]
            pivot[i + 1] = middle - factor * one[i]
            x[i + 1] -= factor * x[i]
        else:
            factor = pivot[i] / below
            pivot[i], one[i], two[i], old = below, middle, after, one[i]
            pivot[i + 1] = old - factor * middle
            one[i + 1] = -factor * after
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
    if abs(pivot[-1]) < least:
        pivot[-1] = least
    for i in range(d - 1, -1, -1):
        if i + 1 < d:
            x[i] -= one[i] * x[i + 1]
        if i + 2 < d:
            x[i] -= two[i] * x[i + 2]
        x[i] /= pivot[i]
    return x


def leading_components(matrix: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The k greatest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns.

    The entry of greatest size of each vector is positive (the first of equal ones)."""
    d = len(matrix)
    k = min(k, d)
    diagonal, off, reflections = tridiagonal(matrix)
    values = leading_eigenvalues(diagonal, off, k)
    size = max(float(np.max(np.abs(diagonal))), float(np.max(np.abs(off), initial=0.0)), np.finfo(float).tiny)
    least, rng = size * _EPS, np.random.default_rng(0)
    found: list[np.ndarray] = []
    cluster, shift = 0, np.inf
    for i, value in enumerate(values):
        if i and values[i - 1] - value > 1e-3 * size:
            cluster = i
        # Equal eigenvalues get shifts a few roundings apart, so that their vectors can differ.
        shift = min(value, shift - 10 * least) if i > cluster else value
        x = rng.standard_normal(d)
        for _ in range(5):
            x = _solved(diagonal, off, shift, x / np.linalg.norm(x), least)
            for _ in range(2):
                for other in found[cluster:]:
                    x -= (other @ x) * other
        found.append(x / np.linalg.norm(x))
    vectors = np.array(found).T
    for at in range(len(reflections) - 1, -1, -1):
        v = reflections[at]
        vectors[at + 1 :] -= 2 * np.outer(v, v @ vectors[at + 1 :])
    vectors /= np.linalg.norm(vectors, axis=0)
    sign = vectors[np.argmax(np.abs(vectors), axis=0), np.arange(k)] < 0
    return values, np.where(sign, -vectors, vectors)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, totals = 0, [0] * d
        for batch in batches:
            n += batch.num_rows
            totals = [t + int(s) for t, s in zip(totals, _matrix(batch.column(0), d).sum(axis=0))]
        if n:
            arrays = [pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array(map(str, totals))]
            yield pa.RecordBatch.from_arrays(arrays, names=["at", "n", "total"])

    parts = fit.mapInArrow(run, "at int, n bigint, total string").groupBy("at")
    rows = parts.agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    rows.sort(key=lambda r: r.at)
    return (rows[0].n, [int(r.total) for r in rows]) if rows else (0, [0] * d)


def _centre(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Means as whole numbers and the rest, so that ``x - whole`` is exact before the rest is taken off."""
    whole = [round(Fraction(s, n)) for s in sums]
    rest = [float(Fraction(s, n) - w) for s, w in zip(sums, whole)]
    return np.array(whole, dtype=np.int64), np.array(rest)


def _covariance(fit: DataFrame, d: int, n: int, sums: list[int]) -> np.ndarray:
    whole, rest = _centre(n, sums)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        seen = False
        for batch in batches:
            x = (_matrix(batch.column(0), d) - whole).astype(float) - rest
            total += x.T @ x
            seen = seen or batch.num_rows > 0
        if seen:
            rows = [pa.array(range(d), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(rows, names=["at", "line"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, line in zip(batch.column(0).to_pylist(), _matrix(batch.column(1), d)):
                lines[at] = lines[at] + line if at in lines else line
        if lines:
            rows = [pa.array(list(lines), pa.int32()), pa.array(list(lines.values()), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(rows, names=["at", "line"])

    kind = "at int, line array<double>"
    # A row of the matrix is added up in one task, from as many parts as there were tasks.
    parts = fit.mapInArrow(products, kind).repartition("at").mapInArrow(added, kind)
    out = np.zeros((d, d))
    for at, line in parts.toLocalIterator():
        out[at] = line
    out /= n
    return (out + out.T) / 2


def fit(grid: DataFrame, d: int, components: int = COMPONENTS) -> Whitener | None:
    """Fit on each distinct ``_grid`` vector of length ``d`` once; None if there is none or none varies.

    Eigenvalues not above rounding have no component: their direction can't be scaled to one."""
    small_batches(grid.sparkSession)
    distinct = stored(grid.where(F.size("_grid") == d).select("_grid").distinct(), "whitening-fit")
    n, sums = _sums(distinct, d)
    if not n or not d:
        return None
    matrix = _covariance(distinct, d, n, sums)
    trace = float(np.trace(matrix))
    if trace <= 0:
        return None
    values, vectors = leading_components(matrix, components)
    known = values > d * _EPS * max(float(values[0]), np.finfo(float).tiny)
    values, vectors = values[known], vectors[:, known]
    if not len(values):
        return None
    scaled = vectors / np.sqrt(values)
    error = float(np.max(np.abs(scaled.T @ matrix @ scaled - np.eye(len(values)))))
    return Whitener(n, sums, vectors, values, values / trace, error)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n x - S)^2 per row, exactly; None beyond a long."""
    total = np.array(sums, dtype=object)
    far = max(int(np.max(np.abs(x), initial=0)) * n + max(map(abs, sums)), 1)
    if far < 1 << 62:
        off = x * np.int64(n) - total.astype(np.int64)
        if int(np.max(np.abs(off), initial=0)) ** 2 * x.shape[1] < 1 << 63:
            return (off * off).sum(axis=1).tolist()
    off = x.astype(object) * n - total
    return [s if s < 1 << 63 else None for s in (off * off).sum(axis=1).tolist()]


def whiten(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per usable vector and component: key, component (from 1, by falling eigenvalue), n, deviation,
    whitened, explained, identity_error.

    Null vectors and vectors with null or non-finite entries are left out. Vectors whose length isn't the commonest one
    (the greater of equally common ones) can't be compared with the others and are left out too. Repeated rows
    each keep their rows; only the fit counts them once. Null keys stay null. There are as many components as
    ``components``, the length and the rank of the covariance allow; a table without two different vectors, or an
    empty one, gives no rows. A deviation beyond a long is null; grid values end at 2^40 on either side.
    ``identity_error`` is the greatest distance of the whitened fit list's covariance from the identity.
    """
    spark = rows.sparkSession
    kind = rows.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, "
        "explained double, identity_error double"
    )
    grid = on_grid(rows.select(F.col(key).alias("key"), F.col(vector).alias("vector")), "vector").select("key", "_grid")
    lengths = grid.groupBy(F.size("_grid").alias("d")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    model = fit(grid, common[0].d, components) if common else None
    if model is None:
        return spark.createDataFrame([], schema)
    d, k = common[0].d, len(model.eigenvalues)
    whole, rest = _centre(model.n, model.sums)
    projection = model.components / np.sqrt(model.eigenvalues)

    def run(batch: pa.RecordBatch) -> dict:
        x = _matrix(batch.column(1), d)
        size = len(x)
        white = ((x - whole).astype(float) - rest) @ projection
        deviation = _deviations(x, model.n, model.sums)
        return {
            key: batch.column(0).take(pa.array(np.repeat(np.arange(size), k))),
            "component": np.tile(np.arange(1, k + 1, dtype=np.int32), size),
            "n": np.full(size * k, model.n),
            "deviation": [v for v in deviation for _ in range(k)],
            "whitened": white.ravel(),
            "explained": np.tile(model.explained, size),
            "identity_error": np.full(size * k, model.identity_error),
        }

    return map_arrow(grid.where(F.size("_grid") == d), run, schema)
