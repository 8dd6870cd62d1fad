import hashlib
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabproof.llm import clustering
from tabproof.llm.clustering import candidates, cluster, distances, hilbert_keys

SCHEMA = "vec_id bigint, embedding array<float>"
COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@pytest.mark.parametrize(("dimensions", "bits"), [(1, 3), (2, 1), (2, 4), (3, 3), (5, 2)])
def test_curve_visits_neighbours(dimensions, bits):
    """Along a Hilbert curve each cell comes once and the next one is a neighbour."""
    cells = np.array(list(itertools.product(range(2**bits), repeat=dimensions)))
    keys = [k.tobytes() for k in hilbert_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    walk = cells[sorted(range(len(cells)), key=lambda i: keys[i])]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_boxes_lose_no_nearest_centroid():
    rng = np.random.default_rng(3)
    for spread in (1, 10, 200):
        centroids = rng.integers(-50, 50, (16, 64))
        rows = rng.integers(-50, 50, 64) + rng.integers(-spread, spread + 1, (40, 64))
        own = candidates(rows.min(0)[None], rows.max(0)[None], centroids)[0]
        assert own[distances(rows, centroids).argmin(1)].all()
    near = centroids[3] + rng.integers(-1, 2, (40, 64))
    assert candidates(near.min(0)[None], near.max(0)[None], centroids)[0].sum() == 1


def test_distances_are_exact_for_large_entries():
    rows = np.array([[2**27, -2**27] * 32, [0] * 64, [2**27 - 1, -2**27] * 32])
    found = distances(rows, rows).tolist()
    assert found == [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, y, strict=True)) for y in rows] for x in rows]


def by_hand(rows, count=16, rounds=3):
    kept = [(i, [int(np.floor(64 * float(np.float32(c)))) for c in v]) for i, v in rows]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(),
                                        np.array(r[1], "<i4").tobytes()))
    now = [v for _, v in order[:count]]

    def assign(v):
        away = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in now]
        return min(range(len(now)), key=lambda k: (away[k], k)), min(away)

    for _ in range(rounds):
        groups = [[] for _ in now]
        for _, v in kept:
            groups[assign(v)[0]].append(v)
        now = [[sum(x) // len(g) for x in zip(*g, strict=True)] if g else c for g, c in zip(groups, now, strict=True)]
    found = [(i, *assign(v)) for i, v in kept]
    inertia = [sum(d for _, c, d in found if c == k) for k in range(len(now))]
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    return sorted(((i, c, d, inertia[c], sum(inertia), shas[c]) for i, c, d in found), key=repr)


@pytest.fixture
def vectors():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(5, 64)) * 0.4
    rows = [(i, [float(np.float32(x)) for x in centres[i % 5] + rng.normal(size=64) * 0.05]) for i in range(250)]
    rows += [(300 + i, rows[0][1]) for i in range(200)] + [(7, rows[1][1]), (None, rows[2][1]), (None, rows[3][1]), (8, rows[8][1])]
    bad = [(600, None), (601, []), (602, [0.5] * 63), (603, [0.5] * 65), (604, [None] + [0.5] * 63),
           (605, [float("nan")] + [0.5] * 63), (606, [float("inf")] + [0.5] * 63)]
    return rows, bad


@pytest.mark.parametrize("block", [1, 16, 128])
def test_equals_brute_force(spark, vectors, monkeypatch, block):
    monkeypatch.setattr(clustering, "BLOCK", block)
    rows, bad = vectors
    table = spark.createDataFrame(rows + bad, SCHEMA).repartition(4).withColumns({"x": F.lit(1), "key": F.lit("k"), "ids": F.lit(0)})
    found = cluster(table)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect()), key=repr) == by_hand(rows)


def test_few_empty_and_large(spark):
    few = [(i, [float(i % 3)] * 64) for i in range(5)]
    assert sorted(map(tuple, cluster(spark.createDataFrame(few, SCHEMA)).collect()), key=repr) == by_hand(few)
    assert cluster(spark.createDataFrame([], SCHEMA)).columns == COLUMNS
    assert cluster(spark.createDataFrame([(1, None), (2, [1.0])], SCHEMA)).count() == 0
    huge = [(i, [3e38 * (-1) ** i] * 64) for i in range(40)] + [(50 + i, [0.1 * i] * 64) for i in range(20)]
    found = cluster(spark.createDataFrame(huge, SCHEMA), centroids=1).collect()
    assert len(found) == 60 and all(r["distance"] >= 0 for r in found)
