"""Embedding whitening by shifted CholeskyQR: Gram passes over centred rows, triangular solves, and the SVD of the composed R."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierweave.llm.common import staged

#: An entry c becomes the integer floor(SCALE * c). A constant added to all entries would change neither covariance nor deviations.
SCALE = 64
COMPONENTS = 16
#: Passes after the shifted one go on until the Gram matrix is the identity up to this, times the dimensions; so many at most.
ORTHOGONAL, MOST_PASSES = 1e-14, 8
#: A component whose variance is below this share of the largest one is rounding noise, not a direction of the data.
LEAST_SHARE = 1e-13
#: Integers whose square sums stay below this are handled as 64-bit numbers, others as Python's.
_SAFE = 2.0**62
_LONG = 2**63

POINTS = "vec_id bigint, n_dims int, point binary"
RESULT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def lattice_points(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_dims, point): each vector's integers floor(64 c), packed in the fewest bytes that hold all of them, so equal vectors are equal bytes.

    Vectors that are null, empty, or hold a null, a non-finite entry or one beyond any long are dropped.
    """
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.mapInArrow(_pack, POINTS)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = batch.column("vector")
        ends = vectors.offsets.to_numpy()
        values = np.floor(vectors.values.to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
        bad = np.concatenate(([0], np.cumsum(~(np.abs(values) < _SAFE))))
        good = (bad[ends[1:]] == bad[ends[:-1]]) & (np.diff(ends) > 0) & vectors.is_valid().to_numpy(zero_copy_only=False)
        points, dims = [], []
        for i in np.flatnonzero(good):
            point = values[ends[i] : ends[i + 1]]
            most = max(-point.min(), point.max() + 1)
            width = 1 if most <= 2**7 else 2 if most <= 2**15 else 4 if most <= 2**31 else 8
            points.append(bytes([width]) + point.astype(f"<i{width}").tobytes())
            dims.append(len(point))
        ids = batch.column("vec_id").filter(pa.array(good))
        yield pa.RecordBatch.from_arrays([ids, pa.array(dims, pa.int32()), pa.array(points, pa.binary())], ["vec_id", "n_dims", "point"])


def _unpacked(points: pa.Array, dims: int) -> np.ndarray:
    """Packed points as rows of 64-bit integers."""
    raw = points.to_pylist()
    out = np.empty((len(raw), dims), np.int64)
    widths = np.array([p[0] for p in raw], np.int64)
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        out[at] = np.frombuffer(b"".join(raw[i][1:] for i in at), f"<i{width}").reshape(len(at), dims)
    return out


def integer_sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of fitted points and their exact sum per dimension; a task gives one row a dimension."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = [0] * dims, 0
        for batch in batches:
            points = _unpacked(batch.column(0), dims)
            if not len(points):
                continue
            safe = float(np.abs(points).max()) * len(points) < _SAFE
            part = (points if safe else points.astype(object)).sum(axis=0)
            total, rows = [a + int(b) for a, b in zip(total, part)], rows + len(points)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dims), pa.int32()), pa.array(map(Decimal, total), pa.decimal128(38, 0)), pa.array([rows] * dims, pa.int64())], ["dim", "total", "rows"]
        )

    parts = fit.select("point").mapInArrow(sums, "dim int, total decimal(38,0), rows bigint")
    whole = parts.groupBy("dim").agg(F.sum("total").alias("total"), F.sum("rows").alias("rows")).orderBy("dim").collect()
    return (int(whole[0].rows), [int(r.total) for r in whole]) if whole else (0, [0] * dims)


def triangular_solve(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """rows times the inverse of the upper triangular r, by forward substitution over the columns."""
    out = np.empty_like(rows)
    for j in range(r.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def gram(fit: DataFrame, dims: int, width: int, rows_of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of the outer products of rows_of(points), `width` columns wide. A task gives one triangle, the sums meet by place, and only they reach the driver."""
    upper, right = np.triu_indices(width)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            rows = rows_of(_unpacked(batch.column(0), dims))
            total += rows.T @ rows
        yield pa.RecordBatch.from_arrays([pa.array(upper * width + right, pa.int64()), pa.array(total[upper, right])], ["place", "value"])

    parts = fit.select("point").mapInArrow(products, "place bigint, value double")
    sums = parts.groupBy("place").agg(F.sum("value").alias("value")).toPandas()
    out = np.zeros(width * width)
    out[sums["place"].to_numpy()] = sums["value"].to_numpy()
    out = out.reshape(width, width)
    return np.triu(out) + np.triu(out, 1).T


@dataclass(frozen=True)
class Whitening:
    """``project`` holds a column per component: the unit eigenvector over the root of its variance."""

    n: int
    sums: tuple[int, ...]
    project: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float


def centred_by(n: int, sums: tuple[int, ...]) -> Callable[[np.ndarray], np.ndarray]:
    """points - sums / n, from the exact integers n * point - sum where 64 bits hold them."""
    shift, most = np.array(sums, object), max(map(abs, sums), default=0)

    def centred(points: np.ndarray) -> np.ndarray:
        if n * float(np.abs(points).max(initial=0)) + most < _SAFE:
            return (points * n - shift.astype(np.int64)) / n
        return ((points.astype(object) * n - shift) / n).astype(np.float64)

    return centred


def fit_whitening(fit: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the points of a staged frame, each row one point; None if there is no point.

    With A the centred points over the root of n, the covariance is A'A. Each pass takes A's rows through the triangular solves with all R
    so far and gathers the Gram matrix of the result, Q'Q; its Cholesky factor is the next R. The first pass adds a shift, which keeps the
    factor positive however ill-conditioned A is; a later one does so only if it has to. Once Q'Q is the identity, A = QR for the composed
    R, whose singular values and right vectors are A's, without the squared condition number of the covariance itself.

    Directions in which the points do not vary have no component, so there may be fewer than `components`.
    """
    n, sums = integer_sums(fit, dims)
    if not n:
        return None
    centred, scale = centred_by(n, tuple(sums)), np.sqrt(n)
    factors: list[np.ndarray] = []

    def orthogonalised(points: np.ndarray) -> np.ndarray:
        rows = centred(points) / scale
        for r in factors:
            rows = triangular_solve(rows, r)
        return rows

    whole, unit = np.eye(dims), np.eye(dims)
    for step in range(MOST_PASSES):
        square = gram(fit, dims, dims, orthogonalised)
        if not step and not square.any():
            return Whitening(n, tuple(sums), np.zeros((dims, 0)), np.zeros(0), np.zeros(0), 0.0)
        done = step and np.abs(square - unit).max() <= ORTHOGONAL * dims
        shift = min(11 * (n * dims + dims * (dims + 1)) * np.finfo(float).eps, 0.01) * np.linalg.norm(square, 2)
        try:
            r = np.linalg.cholesky(square + (0 if step else shift) * unit).T
        except np.linalg.LinAlgError:
            r = np.linalg.cholesky(square + shift * unit).T
        factors.append(r)
        whole = r @ whole
        if done:
            break
    _, singular, right = np.linalg.svd(whole)
    variances = singular**2
    taken = int((variances[:components] > LEAST_SHARE * variances[0]).sum())
    vectors = right[:taken].T
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(taken)])
    project = vectors / singular[:taken]
    check = gram(fit, dims, taken, lambda points: centred(points) @ project) / n
    return Whitening(n, tuple(sums), project, variances[:taken], variances[:taken] / variances.sum(), float(np.abs(check - np.eye(taken)).max()))


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per kept row and component: vec_id, component (from 1, by falling variance), n, deviation, whitened, explained, identity_error.

    The fit counts each distinct point once, so copies, however many, weigh as one; they are combined before the shuffle. Its model is a matrix of
    dimensions times components. Rows are not deduplicated: repeated rows and ids come back as often as they are given, null ids as null.

    Vectors that are null, empty, or hold a null or non-finite entry are dropped, and so are vectors of another length than the most frequent one
    (of equally frequent lengths the larger). A deviation beyond a long is null. Equal variances give some basis of their
    directions, the same for all rows. An empty table, or one distinct point, gives an empty result. Other columns are never read.
    """
    spark = embeddings.sparkSession
    points = staged(lattice_points(embeddings, id_col, vector_col))
    length = points.groupBy("n_dims").count().orderBy(F.desc("count"), F.desc("n_dims")).first()
    if length is None:
        return spark.createDataFrame([], RESULT)
    dims = length.n_dims
    points = points.where(F.col("n_dims") == dims).drop("n_dims")
    model = fit_whitening(staged(points.select("point").distinct()), dims, components)
    taken = len(model.variances)
    if not taken:
        return spark.createDataFrame([], RESULT)
    return points.mapInArrow(_applied(model, dims, taken), RESULT)


def _applied(model: Whitening, dims: int, taken: int) -> Callable:
    centred, most = centred_by(model.n, model.sums), max(map(abs, model.sums))

    def deviations(points: np.ndarray) -> list[int | None]:
        edge = model.n * float(np.abs(points).max(initial=0)) + most
        if edge * edge * dims < _SAFE:
            return ((points * model.n - np.array(model.sums, np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((points.astype(object) * model.n - np.array(model.sums, object)) ** 2).sum(axis=1)
        return [int(d) if d < _LONG else None for d in exact]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _unpacked(batch.column("point"), dims)
            rows = len(points)
            each = np.repeat(np.arange(rows), taken)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, taken + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * taken, model.n)),
                    pa.array(deviations(points), pa.int64()).take(pa.array(each)),
                    pa.array((centred(points) @ model.project).ravel()),
                    pa.array(np.tile(model.explained, rows)),
                    pa.array(np.full(rows * taken, model.identity_error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return apply
