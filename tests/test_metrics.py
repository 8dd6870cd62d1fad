import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tabproof.errors import EvaluationError
from tabproof.operators.align import align_scores, alignment_summary
from tabproof.operators.compare import (
    compare_models, comparison_table, comparison_text, confusion_table, stack_evaluations,
)
from tabproof.operators.metrics import (
    binary_metrics, confusion_cells, confusion_counts, hard_predictions, positive_rate,
    pr_points, roc_points,
)


@pytest.fixture
def scored(spark):
    def build(labels, scores):
        return spark.createDataFrame(
            [(int(y), float(s)) for y, s in zip(labels, scores)], "y int, s double")
    return build


def one(df, **options):
    return binary_metrics(df, "y", "s", **options).first()


# Published expectations for small label and score vectors.
CASES = [
    ([0, 0, 1, 1], [.1, .2, .8, .9],
     dict(accuracy=1, precision=1, recall=1, f1=1, specificity=1, roc_auc=1, pr_auc=1)),
    ([0, 0, 1, 1], [.1, .9, .2, .8],
     dict(accuracy=.5, precision=.5, recall=.5, f1=.5, specificity=.5,
          true_positives=1, false_positives=1, true_negatives=1, false_negatives=1)),
    ([0, 0, 1, 0], [.1, .2, .3, .9], dict(roc_auc=2 / 3, accuracy=.5)),
    ([0, 1], [.5, .5], dict(true_positives=1, false_positives=1, roc_auc=.5)),
    ([0, 0, 1, 1], [.1, .2, .3, .4], dict(precision=None, f1=None, undefined=["precision", "f1"])),
    ([1, 1, 1], [.2, .5, .9],
     dict(precision=1, recall=2 / 3, roc_auc=None, pr_auc=None, specificity=None)),
    ([1, 1], [.9, .8], dict(undefined=["specificity", "roc_auc", "pr_auc"])),
    ([0, 0, 0], [.9, .8, .7],
     dict(undefined=["recall", "sensitivity", "f1", "roc_auc", "pr_auc"])),
    ([0, 0, 1, 1], [.1, .4, .35, .8], dict(roc_auc=.75, pr_auc=0.8333333333333333)),
    ([0, 1], [.9, .1], dict(precision=0, recall=0, f1=None, undefined=["f1"])),
]


@pytest.mark.parametrize("labels, scores, expected", CASES)
def test_known_vectors(scored, labels, scores, expected):
    row = one(scored(labels, scores))
    for name, value in expected.items():
        assert row[name] == (pytest.approx(value) if isinstance(value, float) else value), name
    assert row["n_samples"] == len(labels) and row["recall"] == row["sensitivity"]


def reference_curve(y, s):
    order = np.argsort(-s, kind="stable")
    y, s = y[order], s[order]
    ends = np.r_[np.where(np.diff(s))[0], len(s) - 1]
    tps = np.cumsum(y)[ends].astype(float)
    return tps, 1 + ends - tps, s[ends]


@pytest.mark.parametrize("distinct", [3, 50, 100_000])
def test_ranking_metrics_and_curves_equal_numpy(scored, distinct):
    rng = np.random.default_rng(distinct)
    y = (rng.random(800) < 0.3).astype(int)
    s = np.floor((rng.random(800) * 0.6 + 0.4 * y * rng.random(800)) * distinct) / distinct
    df = scored(y, s).repartition(3).cache()
    tps, fps, thresholds = reference_curve(y, s)
    P, N = y.sum(), len(y) - y.sum()
    tpr, fpr = np.r_[0, tps / P], np.r_[0, fps / N]
    precision, recall = tps / (tps + fps), tps / P

    row = one(df)
    assert row["roc_auc"] == pytest.approx(np.trapezoid(tpr, fpr))
    assert row["pr_auc"] == pytest.approx(np.sum(np.diff(np.r_[0, recall]) * precision))
    assert row["true_positives"] == int(((s >= .5) & (y == 1)).sum())

    keep = np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True]
    expected = [(0.0, 0.0, math.inf)] + list(zip(fps[keep] / N, tps[keep] / P, thresholds[keep]))
    found = [tuple(r) for r in roc_points(df, "y", "s").orderBy(F.desc("threshold")).collect()]
    np.testing.assert_allclose(found, expected)

    found = [tuple(r) for r in pr_points(df, "y", "s").orderBy(F.desc("threshold")).collect()]
    np.testing.assert_allclose([r[:2] for r in found[:-1]], list(zip(recall, precision)))
    assert found[-1] == (0.0, 1.0, None)


def test_auc_ignores_the_threshold_and_row_order(scored):
    df = scored([0, 1, 0, 1, 1], [.1, .7, .6, .4, .9])
    rows = [one(df, threshold=t) for t in (.2, .5, .8)]
    assert len({r["roc_auc"] for r in rows}) == 1 and len({r["accuracy"] for r in rows}) > 1
    assert one(df.orderBy(F.desc("s")))["roc_auc"] == rows[0]["roc_auc"]


def test_concentrated_scores(spark):
    """A third of all rows share one score, the rest sit in a narrow band."""
    df = spark.range(3000).select(
        (F.col("id") % 5 == 0).cast("int").alias("y"),
        F.when(F.col("id") % 3 == 0, 0.25).otherwise(0.3 + F.col("id") * 1e-12).alias("s"))
    row = one(df)
    pdf = df.toPandas()
    ranks = pdf["s"].rank()
    P = int(pdf["y"].sum())
    auc = (ranks[pdf["y"] == 1].sum() - P * (P + 1) / 2) / (P * (3000 - P))
    assert row["roc_auc"] == pytest.approx(auc)


def test_groups_include_a_null_key(spark):
    df = spark.createDataFrame(
        [("a", 0, .1), ("a", 1, .9), (None, 0, .8), (None, 1, .3)], "m string, y int, s double")
    rows = {r["m"]: r for r in binary_metrics(df, "y", "s", by="m").collect()}
    assert rows["a"]["roc_auc"] == 1.0 and rows[None]["roc_auc"] == 0.0
    assert {r["m"] for r in roc_points(df, "y", "s", by="m").collect()} == {"a", None}


def test_probability_vectors_and_arrays(spark, scored):
    expected = one(scored([0, 1, 1], [.2, .4, .9]))
    vectors = spark.createDataFrame(
        [(y, Vectors.dense([1 - s, s])) for y, s in ((0, .2), (1, .4), (1, .9))], ["y", "s"])
    arrays = scored([0, 1, 1], [.2, .4, .9]).withColumn("s", F.array(1 - F.col("s"), F.col("s")))
    assert one(vectors) == expected and one(arrays) == expected
    three = arrays.withColumn("s", F.array_append("s", 0.1))
    with pytest.raises(EvaluationError, match="two probabilities"):
        one(three)


def test_rejected_inputs(spark, scored):
    good = scored([0, 1], [.1, .9])
    for threshold in (0.0, 1.0, -0.1, 1.5):
        with pytest.raises(EvaluationError, match="threshold"):
            one(good, threshold=threshold)
    with pytest.raises(EvaluationError, match="not 0 or 1"):
        one(scored([0, 2], [.1, .9]))
    with pytest.raises(EvaluationError, match="not 0 or 1"):
        one(good.withColumn("y", F.lit(1.5)))
    with pytest.raises(EvaluationError, match="outside"):
        one(scored([0, 1], [.1, 1.4]))
    with pytest.raises(EvaluationError, match="not finite"):
        one(scored([0, 1], [.1, math.nan]))
    with pytest.raises(EvaluationError, match="not finite"):
        one(good.withColumn("s", F.lit(None).cast("double")))
    with pytest.raises(EvaluationError, match="no observations"):
        one(good.limit(0))
    with pytest.raises(EvaluationError, match="not numeric"):
        one(good.withColumn("s", F.lit("x")))
    with pytest.raises(EvaluationError, match="both classes"):
        roc_points(scored([1, 1], [.1, .2]), "y", "s")
    with pytest.raises(EvaluationError, match="no observations"):
        pr_points(good.limit(0), "y", "s")


def test_pr_curve_without_positives(scored):
    rows = pr_points(scored([0, 0], [.1, .2]), "y", "s").collect()
    assert sorted((r["recall"], r["precision"]) for r in rows) == [(0.0, 1.0), (1.0, 0.0), (1.0, 0.0)]


def test_hard_predictions_and_confusion(scored):
    predicted = hard_predictions(scored([0, 1, 1, 0], [.5, .49, .9, .1]), "s", .5)
    counts = confusion_counts(predicted, "y", "predicted")
    assert counts.first().asDict() == dict(
        true_positives=1, false_positives=1, true_negatives=1, false_negatives=1, total=4)
    cells = {(r["actual"], r["predicted"]): (r["n"], r["share"]) for r in confusion_cells(counts).collect()}
    assert cells == {(a, p): (1, "25.0%") for a in (0, 1) for p in (0, 1)}
    empty = confusion_cells(confusion_counts(predicted.limit(0), "y", "predicted"))
    assert {r["share"] for r in empty.collect()} == {"n/a"}
    with pytest.raises(EvaluationError, match="other than 0 and 1"):
        confusion_counts(predicted.withColumn("predicted", F.lit(2)), "y", "predicted")
    assert positive_rate(predicted, "y").first()[0] == 0.5


def test_alignment(spark):
    truth = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "id int, y int")
    scores = spark.createDataFrame([(3, .3), (1, .1), (2, .2)], "id int, s double")
    rows = sorted(tuple(r) for r in align_scores(truth, scores, "id", "y", "s").collect())
    assert rows == [(1, 0, .1), (2, 1, .2), (3, 1, .3)]
    lame = scores.where("id != 2").unionByName(spark.createDataFrame([(9, .9), (3, .4)], scores.schema))
    assert tuple(alignment_summary(truth, lame, "id", "y", "s").first()) == (1, 1, 1, 1)
    with pytest.raises(EvaluationError, match="1 id.* without a score, 1 without a label, 1 repeated"):
        align_scores(truth, lame, "id", "y", "s")


def evaluation(spark, scored, model, scores):
    return binary_metrics(scored([0, 0, 1, 1], scores), "y", "s").withColumn("model", F.lit(model))


def test_comparison(spark, scored):
    rows = stack_evaluations([
        evaluation(spark, scored, "low", [.9, .8, .2, .1]),
        evaluation(spark, scored, "tie-a", [.1, .2, .3, .9]),
        evaluation(spark, scored, "tie-b", [.1, .2, .4, .8]),
        binary_metrics(scored([1], [.9]), "y", "s").withColumn("model", F.lit("gap")),
    ])
    ranked = {r["model"]: r["rank"] for r in compare_models(rows).collect()}
    assert ranked == {"tie-a": 1, "tie-b": 2, "low": 3, "gap": None}
    by_recall = {r["model"]: r["rank"] for r in compare_models(rows, "recall").collect()}
    assert by_recall == {"gap": 1, "tie-a": 2, "tie-b": 3, "low": 4}
    comparison = compare_models(rows)
    assert comparison_table(comparison).columns == [
        "rank", "model", "accuracy", "precision", "recall", "f1", "specificity", "roc_auc",
        "pr_auc", "n_samples"]
    text = {r["model"]: r for r in comparison_text(comparison).collect()}
    assert text["gap"]["roc_auc"] == "n/a" and text["tie-a"]["roc_auc"] == "1.0000"
    assert confusion_table(comparison).columns == ["model", "tn", "fp", "fn", "tp"]


def test_comparison_faults(spark, scored):
    rows = stack_evaluations([binary_metrics(scored([1], [.9]), "y", "s").withColumn("model", F.lit("m"))])
    with pytest.raises(EvaluationError, match="unknown"):
        compare_models(rows, "loss")
    with pytest.raises(Exception, match="no evaluation defines roc_auc"):
        compare_models(rows).collect()
    with pytest.raises(EvaluationError):
        stack_evaluations([])
