import numpy as np
import pytest
from pyspark.sql import functions as F

from tabproof.llm.whitening import one_sided_jacobi, pivoted_cholesky, principal_components, whiten

SCHEMA = "vec_id bigint, embedding array<float>"
COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def matrix(size, rank, seed):
    half = np.random.default_rng(seed).normal(size=(size, rank)) * np.geomspace(100, 1e-3, rank)
    return half @ half.T


@pytest.mark.parametrize(("size", "rank"), [(1, 1), (2, 2), (7, 7), (7, 3), (30, 30), (64, 64), (9, 1)])
def test_factor_and_components(size, rank):
    found = matrix(size, rank, size + rank)
    order, factor = pivoted_cholesky(found)
    assert factor.shape[1] >= rank
    assert np.allclose(factor @ factor.T, found[np.ix_(order, order)], rtol=0, atol=1e-10 * np.abs(found).max())
    assert np.allclose(np.triu(factor, 1), 0)
    turned = one_sided_jacobi(factor)
    cosines = turned.T @ turned / np.outer(*[np.linalg.norm(turned, axis=0)] * 2)
    assert np.abs(cosines - np.eye(len(cosines))).max() < 1e-13
    values, vectors = principal_components(found)
    expected = np.linalg.eigvalsh(found)[::-1]
    assert np.allclose(values[:rank], expected[:rank], rtol=1e-9, atol=1e-12 * expected[0])
    assert np.allclose(found @ vectors[:, :rank], vectors[:, :rank] * values[:rank], atol=1e-9 * expected[0])


def test_no_spread():
    values, vectors = principal_components(np.zeros((3, 3)))
    assert len(values) == 0 and vectors.shape == (3, 0)


@pytest.fixture
def vectors():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(200, 6)) * [3, 2, 1, 0.5, 0.3, 0.1] + [1000, 0, -7, 0, 0, 0]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(base)]
    rows += [(300 + i, rows[0][1]) for i in range(150)] + [(5, rows[7][1]), (None, rows[3][1]), (None, rows[3][1])]
    bad = [(400, None), (401, []), (402, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (403, [float("nan")] + [0.0] * 5),
           (404, [0.0] * 5 + [float("-inf")]), (405, [1.0, 2.0])]
    return rows, bad


def by_numpy(rows):
    x = np.floor(256 * np.array([v for _, v in rows], np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    values, directions = np.linalg.eigh(np.cov(fit.T, bias=True))
    values, directions = values[::-1], directions[:, ::-1]
    return x, n, sums, values, directions


def test_equals_numpy(spark, vectors):
    rows, bad = vectors
    table = spark.createDataFrame(rows + bad, SCHEMA).repartition(5).withColumns({"x": F.lit(1), "n": F.lit("a")})
    result = whiten(table)
    assert result.columns == COLUMNS
    found = result.collect()
    x, n, sums, values, directions = by_numpy(rows)
    assert len(found) == 4 * len(rows) and {r["n"] for r in found} == {n}
    assert {r["identity_error"] for r in found} == {found[0]["identity_error"]}
    assert found[0]["identity_error"] < 1e-9
    shares = {r["component"]: r["explained"] for r in found}
    assert [shares[c] for c in (1, 2, 3, 4)] == pytest.approx((values[:4] / values.sum()).tolist(), rel=1e-9)
    white = (x - sums / n) @ directions[:, :4] / np.sqrt(values[:4])
    deviation = [int(d) for d in ((n * x - sums) ** 2).sum(1)]
    for c in range(4):
        own = sorted(((r["vec_id"] is None, r["vec_id"] or 0, r["deviation"], r["whitened"]) for r in found if r["component"] == c + 1))
        expected = sorted((i is None, i or 0, d, w) for (i, _), d, w in zip(rows, deviation, white[:, c], strict=True))
        assert [o[:3] for o in own] == [e[:3] for e in expected]
        signs = {1.0 if abs(o[3] - e[3]) < abs(o[3] + e[3]) else -1.0 for o, e in zip(own, expected, strict=True) if abs(e[3]) > 1e-6}
        assert len(signs) == 1
        sign = signs.pop()
        assert [o[3] for o in own] == pytest.approx([sign * e[3] for e in expected], abs=1e-8)


def test_same_result_however_dealt(spark, vectors):
    rows, bad = vectors
    one, two = (
        sorted(((r["vec_id"] or -1, r["component"], r["deviation"], round(r["whitened"], 9))
                for r in whiten(spark.createDataFrame(rows + bad, SCHEMA).repartition(k)).collect()))
        for k in (1, 7))
    assert one == two


def test_low_rank_large_entries_and_empty(spark):
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0, 1.0]) for i in range(20)], SCHEMA)
    found = whiten(flat).collect()
    assert {r["component"] for r in found} == {1} and len(found) == 20
    assert found[0]["explained"] == pytest.approx(1)
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).count() == 0
    assert whiten(spark.createDataFrame([], SCHEMA)).columns == COLUMNS
    assert whiten(spark.createDataFrame([(1, None)], SCHEMA)).count() == 0
    huge = spark.createDataFrame([(i, [1e30 * (i % 2), float(i)]) for i in range(100)], SCHEMA)
    # (n * 2**26)**2 is beyond 64 bits, and such entries are the limit.
    assert whiten(huge).where("deviation IS NULL").count() == whiten(huge).count() == 200
    lengths = spark.createDataFrame([(i, [float(i), float(i * i)]) for i in range(9)] + [(50 + i, [0.5 * i]) for i in range(4)], SCHEMA)
    assert {r["vec_id"] for r in whiten(lengths).collect()} == set(range(9))
