"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

Spark makes the list of distinct vectors and two sums over it: that of the vectors, exact,
and that of the outer products of the centred vectors, the scatter. Each task adds its
rows up before anything travels, and the cells of the partial sums are added by groups.
The driver gets the scatter matrix, whose size depends on the number of dimensions alone.

The scatter is factored by Cholesky with diagonal pivots, which reveals its rank. Rotating
the columns of the triangular factor until they are orthogonal gives the eigenvalues as
their squared norms and the eigenvectors as their directions; the factor's product is never
formed again, so small eigenvalues keep their digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabproof.llm.spool import spool
from tabproof.llm.vectors import packed, summed, unpacked, whole_rows

#: What an entry is multiplied by, and the most components.
SCALE = 256
COMPONENTS = 4
#: Rotations end when no two columns have a cosine above this, or after so many rounds.
PARALLEL = 4 * np.finfo(float).eps
SWEEPS = 60


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``order, factor`` with ``matrix[order][:, order] = factor @ factor.T``.

    ``factor`` is lower triangular with as many columns as ``matrix`` has rank: the largest
    remaining diagonal entry comes next, and what is left ends at rounding size.
    """
    rest = np.array(matrix, float)
    size = len(rest)
    order = np.arange(size)
    factor = np.zeros((size, size))
    least = max(np.diag(rest).max(initial=0.0), 0.0) * size * np.finfo(float).eps
    for k in range(size):
        diagonal = np.diag(rest)[k:]
        pivot = k + int(diagonal.argmax())
        if rest[pivot, pivot] <= least:
            return order, factor[:, :k]
        swap = [k, pivot], [pivot, k]
        rest[swap[0]] = rest[swap[1]]
        rest[:, swap[0]] = rest[:, swap[1]]
        factor[swap[0]] = factor[swap[1]]
        order[swap[0]] = order[swap[1]]
        factor[k:, k] = rest[k:, k] / np.sqrt(rest[k, k])
        rest[k + 1:, k + 1:] -= np.outer(factor[k + 1:, k], factor[k + 1:, k])
    return order, factor


def _pairings(count: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of columns in rounds of disjoint ones."""
    ring = list(range(count + count % 2))
    for _ in range(len(ring) - 1):
        half = len(ring) // 2
        pairs = [(a, b) for a, b in zip(ring[:half], ring[:half - 1:-1], strict=True) if max(a, b) < count]
        yield tuple(np.array(side, int) for side in zip(*pairs, strict=True))
        ring.insert(1, ring.pop())


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """``factor`` with its columns rotated in pairs until all are orthogonal."""
    turned = np.array(factor, float)
    if turned.shape[1] < 2:
        return turned
    for _ in range(SWEEPS):
        steepest = 0.0
        for left, right in _pairings(turned.shape[1]):
            a, b = turned[:, left], turned[:, right]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            cosine = np.abs(ab) / np.sqrt(np.maximum(aa * bb, np.finfo(float).tiny))
            steepest = max(steepest, cosine.max())
            turn = cosine > PARALLEL
            slope = (bb - aa) / np.where(turn, 2 * ab, 1.0)
            tangent = np.where(slope >= 0, 1.0, -1.0) / (np.abs(slope) + np.hypot(1.0, slope))
            tangent = np.where(turn, tangent, 0.0)
            cos = 1 / np.hypot(1.0, tangent)
            turned[:, left], turned[:, right] = cos * (a - tangent * b), cos * (b + tangent * a)
        if steepest <= PARALLEL:
            break
    return turned


def principal_components(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above rounding size in falling order, and unit eigenvectors as columns.

    Each vector's entry of largest size is positive.
    """
    order, factor = pivoted_cholesky(covariance)
    turned = one_sided_jacobi(factor)
    norms = np.sqrt((turned * turned).sum(0))
    falling = np.argsort(-norms, kind="stable")
    vectors = np.zeros_like(turned)
    vectors[order] = turned / norms
    vectors = vectors[:, falling]
    if vectors.size:
        largest = np.abs(vectors).argmax(0)
        vectors = vectors * np.sign(vectors[largest, np.arange(vectors.shape[1])])
    return norms[falling] ** 2, vectors


@dataclass(frozen=True)
class Whitening:
    """What is fitted: everything a task needs to whiten its rows."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """``x - S/n``; the whole part is taken off exactly."""
        whole, part = self._mean()
        return (rows - whole) - part / self.n

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        return self.centred(rows) @ (self.vectors / np.sqrt(self.eigenvalues))

    def deviation(self, rows: np.ndarray) -> list[int | None]:
        """Sum of ``(n*x - S)**2``, exact; None where 64 bits do not hold it."""
        whole, part = self._mean()
        near = rows - whole
        size = (float(self.n) * (np.abs(near) + 1.0)) ** 2
        small = size.sum(1) < 2.0**62
        steps = near[small] * self.n - part
        out = np.empty(len(rows), object)
        out[small] = (steps * steps).sum(1)
        for i in np.flatnonzero(~small):
            exact = sum((self.n * int(x) - int(p)) ** 2 for x, p in zip(near[i], part, strict=True))
            out[i] = exact if exact < 2**63 else None
        return out.tolist()

    def _mean(self) -> tuple[np.ndarray, np.ndarray]:
        pairs = [divmod(s, self.n) for s in self.sums]
        return np.array([q for q, _ in pairs], np.int64), np.array([r for _, r in pairs], np.int64)


def _distinct(embeddings: DataFrame) -> DataFrame:
    """Column ``x``: every usable vector once, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in whole_rows(batch.column(0), SCALE)[1]:
                yield pa.RecordBatch.from_arrays([packed(rows)], ["x"])

    return spool(embeddings.select("embedding").mapInArrow(run, "x binary").distinct(), "whitening-fit")


def fit_whitening(embeddings: DataFrame, components: int = COMPONENTS) -> tuple[Whitening | None, DataFrame]:
    """The fit over the distinct vectors, and these vectors.

    None if there is no vector or all are equal. If vectors differ in length, those of the
    most frequent length count (of equally frequent ones the longest).
    """
    fit = _distinct(embeddings)
    lengths = fit.groupBy((F.octet_length("x") / 4).cast("int").alias("d")).count()
    top = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    if top is None:
        return None, fit
    dimensions, n = top["d"], top["count"]
    fit = fit.where(F.octet_length("x") == 4 * dimensions)
    sums = tuple(map(int, summed(fit, lambda batch: unpacked(batch.column(0), dimensions).sum(0), True)))
    centre = Whitening(n, sums, np.empty(0), np.empty((dimensions, 0)), 0.0)
    upper = np.triu_indices(dimensions)

    def scatter(batch: pa.RecordBatch) -> np.ndarray:
        centred = centre.centred(unpacked(batch.column(0), dimensions))
        return (centred.T @ centred)[upper]

    covariance = np.zeros((dimensions, dimensions))
    covariance[upper] = summed(fit, scatter, False) / n
    covariance.T[upper] = covariance[upper]
    eigenvalues, vectors = principal_components(covariance)
    if not len(eigenvalues):
        return None, fit
    return Whitening(n, sums, eigenvalues[:components], vectors[:, :components], float(np.trace(covariance))), fit


def identity_error(fitted: Whitening, fit: DataFrame) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    k = len(fitted.eigenvalues)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        white = fitted.whitened(unpacked(batch.column(0), len(fitted.sums)))
        return np.concatenate([white.sum(0), (white.T @ white).reshape(-1)])

    found = summed(fit, moments, False) / fitted.n
    covariance = found[k:].reshape(k, k) - np.outer(found[:k], found[:k])
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: ``vec_id, component, n, deviation,
    whitened, explained, identity_error``.

    Vectors that are null or empty, or hold null or non-finite entries, are left out, as are
    those of another length than the most frequent one. Entries become ``floor(256 * c)``,
    within ``LARGEST`` of zero. Covariances are over the distinct vectors, so repeated
    vectors weigh once; each of their rows is returned, whatever its ``vec_id``, null and
    repeated ones too. ``component`` counts from 1 by falling eigenvalue up to
    ``components`` or to the rank if that is lower; vectors without any spread give no
    rows, and so does an empty table. ``deviation`` is null where it does not fit 64 bits.
    Other columns are not looked at.
    """
    schema = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double")
    fitted, fit = fit_whitening(embeddings, components)
    if fitted is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    error = identity_error(fitted, fit)
    k, dimensions = len(fitted.eigenvalues), len(fitted.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, parts = whole_rows(batch.column(1), SCALE, dimensions)
            rows = parts[0]
            if not len(rows):
                continue
            ids = batch.column(0).take(pa.array(np.repeat(places, k)))
            deviation = pa.array(fitted.deviation(rows), pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), k)))
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                pa.array(np.full(len(rows) * k, fitted.n)), deviation,
                pa.array(fitted.whitened(rows).reshape(-1)),
                pa.array(np.tile(fitted.eigenvalues / fitted.trace, len(rows))),
                pa.array(np.full(len(rows) * k, error)),
            ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    return rows.mapInArrow(run, schema)
