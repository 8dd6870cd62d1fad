"""Centroid clustering over zone maps along a Hilbert curve.

Vectors are ordered along a Hilbert curve by a range shuffle and cut into blocks, each with
its box (least and largest entry per dimension) and its sum. In a round, the least and the
largest distance from a box to each centroid leave the centroids that can be nearest to a
vector inside. A block with one candidate adds its sum and its size and is not looked
into; the vectors of others are compared with the candidates exactly, in whole numbers.
Tasks add up their part, and the driver gets the sums of a few centroids per round.

Equal vectors have one place on the curve. The range shuffle deals them out by a second
number per row, so a vector that fills a third of the table is split over tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabproof.llm.spool import spool
from tabproof.llm.vectors import packed, summed, unpacked, whole_rows

#: Entries of a vector, what they are multiplied by, centroids and rounds.
DIMENSIONS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
#: Vectors of a block, and bits of each dimension that order the curve.
BLOCK = 128
CURVE_BITS = 4
#: Below this, products of entries add up exactly as 64-bit floating-point numbers.
_EXACT = 2**20


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve, as rows of bytes in ascending order.

    ``cells`` has one row per point with numbers below ``2**bits``. The known transform of
    axes to curve bits is applied to all points at once: bit by bit, each axis either
    flips the lower bits of the first axis or swaps them with its own; then a Gray code
    runs across the axes.
    """
    axes = np.array(cells, np.int64).T
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for axis in axes:
            is_set = (axis >> bit) & 1 == 1
            moved = np.where(is_set, 0, (axes[0] ^ axis) & low)
            axes[0] ^= np.where(is_set, low, moved)
            axis ^= moved
    np.bitwise_xor.accumulate(axes, axis=0, out=axes)
    flips = np.zeros(axes.shape[1], np.int64)
    for bit in range(bits - 1, 0, -1):
        flips ^= np.where((axes[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    axes ^= flips
    planes = [(axes >> bit) & 1 for bit in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def _bounds(embeddings: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """Least and largest entry of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            rows = whole_rows(batch.column(0), SCALE, DIMENSIONS)[1][0]
            if len(rows):
                low = rows.min(0) if low is None else np.minimum(low, rows.min(0))
                high = rows.max(0) if high is None else np.maximum(high, rows.max(0))
        if low is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(DIMENSIONS)), pa.array(low), pa.array(high)], ["place", "low", "high"])

    found = embeddings.select("embedding").mapInArrow(run, "place bigint, low bigint, high bigint")
    found = found.groupBy("place").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("place").collect()
    if not found:
        return None
    return np.array([r["low"] for r in found]), np.array([r["high"] for r in found])


def _along_the_curve(embeddings: DataFrame, low: np.ndarray, high: np.ndarray) -> DataFrame:
    """``vec_id, x, key, deal``: usable vectors, their place on the curve, and a number that
    deals equal ones out."""
    cells = 1 << CURVE_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, (rows,) = whole_rows(batch.column(1), SCALE, DIMENSIONS)
            if not len(rows):
                continue
            at = (rows - low) * cells // (high - low + 1)
            keys = hilbert_keys(at, CURVE_BITS)
            pick = pa.array(places)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pick), packed(rows), pa.array([k.tobytes() for k in keys], pa.binary()),
                 batch.column(2).take(pick)], ["vec_id", "x", "key", "deal"])

    # Rows may repeat their id as well, so the place in the table counts too.
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding",
                             F.xxhash64("vec_id", F.monotonically_increasing_id()).alias("deal"))
    return spool(rows.mapInArrow(run, "vec_id bigint, x binary, key binary, deal bigint"), "cluster-vectors")


def _blocks(ordered: DataFrame) -> DataFrame:
    """``ids, x, low, high, total``: one row per block of neighbours on the curve."""

    def block(ids: list, rows: np.ndarray) -> tuple:
        return (ids, rows.astype("<i4").tobytes(), rows.min(0).astype("<i4").tobytes(),
                rows.max(0).astype("<i4").tobytes(), rows.sum(0).astype("<i8").tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rest = [], np.empty((0, DIMENSIONS), np.int64)

        def out(count: int) -> Iterator[pa.RecordBatch]:
            nonlocal ids, rest
            made = [block(ids[i:i + BLOCK], rest[i:i + BLOCK]) for i in range(0, count, BLOCK)]
            ids, rest = ids[count:], rest[count:]
            if made:
                kinds = [pa.list_(pa.int64()), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)],
                    ["ids", "x", "low", "high", "total"])

        for batch in batches:
            ids += batch.column(0).to_pylist()
            rest = np.concatenate([rest, unpacked(batch.column(1), DIMENSIONS)])
            yield from out(len(ids) // BLOCK * BLOCK)
        yield from out(len(ids))

    dealt = ordered.repartitionByRange("key", "deal").sortWithinPartitions("key", "deal").select("vec_id", "x")
    return spool(dealt.mapInArrow(
        run, "ids array<bigint>, x binary, low binary, high binary, total binary"), "cluster-blocks")


def first_centroids(ordered: DataFrame, count: int) -> np.ndarray:
    """The vectors with the smallest hash of their id, in the order of the hashes."""
    rank = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = ordered.select(rank.alias("rank"), "x").orderBy("rank", "x").limit(count).collect()
    return np.array([np.frombuffer(r["x"], "<i4") for r in chosen], np.int64)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Which centroids can be nearest to a vector in each box: booleans, a row per box.

    A centroid whose least distance to the box is above another one's largest cannot.
    """
    least = np.empty((len(low), len(centroids)), np.int64)
    most = np.empty_like(least)
    for k, centroid in enumerate(centroids):
        below, above = low - centroid, centroid - high
        gap = np.maximum(np.maximum(below, above), 0)
        reach = np.maximum(np.abs(below), np.abs(above))
        least[:, k], most[:, k] = (gap * gap).sum(1), (reach * reach).sum(1)
    return least <= most.min(1)[:, None]


def distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all centroids."""
    if max(np.abs(rows).max(initial=0), np.abs(centroids).max(initial=0)) < _EXACT:
        a, b = rows.astype(float), centroids.astype(float)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((rows - c) ** 2).sum(1) for c in centroids], 1)


def _nearest(batch: pa.RecordBatch, centroids: np.ndarray, measured: bool
             ) -> Iterator[tuple[int, np.ndarray | None, np.ndarray | None, np.ndarray | None, int]]:
    """For each block of a batch its place, rows, nearest centroids, distances and, if all
    its rows have one nearest centroid by its box, that one (else -1).

    Such blocks are opened only if distances are ``measured``.
    """
    low, high = unpacked(batch.column("low"), DIMENSIONS), unpacked(batch.column("high"), DIMENSIONS)
    possible = candidates(low, high, centroids)
    for i, data in enumerate(batch.column("x")):
        own = np.flatnonzero(possible[i])
        if len(own) == 1 and not measured:
            yield i, None, None, None, int(own[0])
            continue
        rows = np.frombuffer(data.as_buffer(), "<i4").reshape(-1, DIMENSIONS).astype(np.int64)
        away = distances(rows, centroids[own])
        nearest = away.argmin(1)
        yield i, rows, own[nearest], away[np.arange(len(rows)), nearest], -1


def _moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round; empty ones stay."""
    count = len(centroids)

    def terms(batch: pa.RecordBatch) -> np.ndarray:
        sizes, sums = np.zeros(count, np.int64), np.zeros((count, DIMENSIONS), np.int64)
        for i, rows, nearest, _, single in _nearest(batch, centroids, False):
            if rows is None:
                sizes[single] += len(batch.column("x")[i].as_buffer()) // (4 * DIMENSIONS)
                sums[single] += np.frombuffer(batch.column("total")[i].as_buffer(), "<i8")
            else:
                sizes += np.bincount(nearest, minlength=count)
                np.add.at(sums, nearest, rows)
        return np.concatenate([sizes, sums.reshape(-1)])

    found = summed(blocks.select("x", "low", "high", "total"), terms, True)
    sizes, sums = found[:count], found[count:].reshape(count, DIMENSIONS)
    return np.array([[int(s) // int(n) for s in row] if n else old
                     for n, row, old in zip(sizes, sums, centroids.tolist(), strict=True)], np.int64)


def _inertia(blocks: DataFrame, centroids: np.ndarray) -> list[int]:
    """Sum of the distances of each centroid's vectors."""
    count = len(centroids)

    def terms(batch: pa.RecordBatch) -> np.ndarray:
        total = np.zeros(count, object)
        for _, _, nearest, away, _ in _nearest(batch, centroids, True):
            # In two halves, whose sums over a block fit 64 bits.
            for shift, part in ((32, away >> 32), (0, away & 0xFFFFFFFF)):
                of = np.zeros(count, np.int64)
                np.add.at(of, nearest, part)
                total += of.astype(object) * 2**shift
        return total

    return [int(t) for t in summed(blocks.select("x", "low", "high"), terms, True)]


def cluster(embeddings: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per usable vector: ``vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256``.

    Vectors with exactly 64 entries, none null or non-finite, are kept; entries become
    ``floor(64 * c)``, within ``LARGEST`` of zero. The first centroids are the vectors
    whose id has the smallest hash; a null id counts as an empty one, rows that repeat an
    id are ordered by their entries, and with fewer vectors than centroids there are fewer
    centroids. Of equally near centroids the one with the smaller number is taken. Sums
    that do not fit 64 bits are null. Each row is returned, repeated ones too; without
    usable vectors there are no rows. Other columns are not looked at.
    """
    schema = ("vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, "
              "centroid_sha256 string")
    bounds = _bounds(embeddings)
    if bounds is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    ordered = _along_the_curve(embeddings, *bounds)
    now = first_centroids(ordered, centroids)
    blocks = _blocks(ordered)
    for _ in range(rounds):
        now = _moved(blocks, now)
    inertia = _inertia(blocks, now)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now.tolist()]
    of_cluster = pa.array([i if i < 2**63 else None for i in inertia], pa.int64())
    whole = sum(inertia) if sum(inertia) < 2**63 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(nearest, away) for _, _, nearest, away, _ in _nearest(batch, now, True)]
            if not found:
                continue
            number = np.concatenate([n for n, _ in found])
            of = pa.array(number)
            yield pa.RecordBatch.from_arrays([
                batch.column("ids").flatten(), pa.array(number.astype(np.int32)),
                pa.array(np.concatenate([a for _, a in found])), of_cluster.take(of),
                pa.array([whole], pa.int64()).take(pa.array(np.zeros(len(number), np.int64))),
                pa.array(digests).take(of),
            ], ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return blocks.select("ids", "x", "low", "high").mapInArrow(run, schema)
