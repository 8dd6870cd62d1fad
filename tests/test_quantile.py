import numpy as np
import pytest
from pyspark.sql import functions as F

from tabproof.operators import quantile
from tabproof.operators.quantile import exact_medians, exact_modes, propose_medians, settle_medians


def random_columns(rng, kind, n):
    return {
        "uniform": rng.random(n),
        "skewed": rng.pareto(0.5, n) * 10.0 ** rng.integers(-8, 8),
        "ties": rng.integers(0, 4, n).astype(float),
        "hot": np.where(rng.random(n) < 0.4, 7.0, rng.random(n) * 14),
        "constant": np.full(n, 3.5),
        "negative": -rng.random(n) * 1e6,
    }[kind]


KINDS = ["uniform", "skewed", "ties", "hot", "constant", "negative"]


@pytest.mark.parametrize("n", [1, 2, 5, 1000, 1001])
def test_medians_equal_numpy(spark, n):
    rng = np.random.default_rng(n * 7)
    data = {k: random_columns(rng, k, n) for k in KINDS}
    df = spark.createDataFrame(
        [tuple(float(data[k][i]) for k in KINDS) for i in range(n)],
        ", ".join(f"{k} double" for k in KINDS)).repartition(3)
    found = exact_medians(df, KINDS)
    for kind, value in zip(KINDS, found):
        assert value == pytest.approx(np.median(data[kind]), rel=1e-15, abs=0), kind


def test_medians_skip_nulls_and_report_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (4.0, None)], "a double, b double")
    assert exact_medians(df, ["a", "b"]) == [2.5, None]


def test_median_of_a_large_narrowed_column(spark):
    df = spark.range(300_001).select((F.col("id") * 7 % 300_001).cast("double").alias("x"))
    assert exact_medians(df, ["x"]) == [150_000.0]
    even = spark.range(300_000).select(F.col("id").cast("double").alias("x"))
    assert exact_medians(even, ["x"]) == [149_999.5]


def test_medians_at_the_ends_of_the_range(spark):
    values = [-1.7e308, -5e-324, -0.0, 0.0, 5e-324, 1e-300, 1.7e308, 1.7e308, 1.7976e308]
    for last in range(1, len(values) + 1):
        df = spark.createDataFrame([(v,) for v in values[:last]], "x double")
        assert exact_medians(df, ["x"]) == [float(np.median(values[:last]))], last


def test_medians_need_no_sketch_and_few_scans(spark):
    """Doubles that differ in the last bits only are told apart in a handful of rounds."""
    base = 0.1
    values = [base + i * 2.0**-56 for i in range(501)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert exact_medians(df, ["x"]) == [values[250]]


def test_modes_take_the_smallest_of_ties(spark):
    df = spark.createDataFrame(
        [(2.0, 1.0, None), (2.0, 3.0, None), (1.0, None, None), (1.0, 3.0, None)],
        "a double, b double, c double")
    assert exact_modes(df, ["a", "b", "c"]) == [1.0, 3.0, None]


def test_bounds_that_miss_the_middle_are_found_out(spark):
    """The counting scan proves the proposal; a wrong one costs scans, not the result."""
    values = [float(i % 1000) for i in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    for low, high in [(0.0, 10.0), (700.0, 900.0), (499.0, 499.0), (500.0, 600.0), (-5.0, 5000.0), (2000.0, 3000.0)]:
        searches = propose_medians(df, ["x"])
        searches[0].bound(low, high)
        assert settle_medians(df, ["x"], searches) == [499.5]


def test_medians_take_two_scans(spark, monkeypatch):
    rounds = []
    counted = quantile._middle_cells
    monkeypatch.setattr(quantile, "_middle_cells", lambda *a: rounds.append(1) or counted(*a))
    df = spark.range(200_000).select(
        F.rand(3).alias("u"), F.exp(F.randn(4) * 20).alias("e"), (F.col("id") % 7).cast("double").alias("t"))
    df = df.repartition(6).cache()
    expected = df.agg(*[F.expr(f"median({c})") for c in df.columns]).first()
    assert exact_medians(df, df.columns) == list(expected)
    assert len(rounds) <= 2
    df.unpersist()


def test_medians_with_infinite_values(spark):
    inf = float("inf")
    df = spark.createDataFrame([(-inf, 1.0, inf), (2.0, inf, inf), (5.0, -inf, inf)], "a double, b double, c double")
    assert exact_medians(df, ["a", "b", "c"]) == [2.0, 1.0, inf]
