"""Ranking several models by one metric; a handful of rows from here on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabproof.errors import EvaluationError
from tabproof.functions.columns import json_text, metric_text
from tabproof.operators.metrics import METRIC_NAMES


def stack_evaluations(evaluations: list[DataFrame]) -> DataFrame:
    """Metric rows of several models under each other, with their given order."""
    if not evaluations:
        raise EvaluationError("there is no evaluation")
    numbered = [e.withColumn("ordinal", F.lit(i)) for i, e in enumerate(evaluations)]
    return reduce(DataFrame.unionByName, numbered)


def compare_models(metrics: DataFrame, metric: str = "roc_auc") -> DataFrame:
    """Metric rows plus ``rank``: best first, equal values in ``ordinal`` order.

    A model whose metric is undefined has no rank. When no model has one, the query
    fails rather than present an order that means nothing.
    """
    if metric not in METRIC_NAMES:
        raise EvaluationError(f"unknown metric {metric!r}; expected one of {list(METRIC_NAMES)}")
    everything = Window.partitionBy(F.lit(0))
    best_first = everything.orderBy(F.desc_nulls_last(metric), "ordinal")
    nothing = F.raise_error(F.lit(f"no evaluation defines {metric}"))
    rank = F.when(F.max(metric).over(everything).isNull(), nothing.cast("int")).when(
        F.col(metric).isNotNull(), F.row_number().over(best_first))
    return metrics.withColumn("rank", rank).withColumn("ranking_metric", F.lit(metric))


def comparison_table(comparison: DataFrame, model: str = "model") -> DataFrame:
    """Model and metric columns in table order."""
    return comparison.select("rank", model, *METRIC_NAMES, "n_samples")


def comparison_text(comparison: DataFrame, model: str = "model") -> DataFrame:
    """The comparison with rendered cells: four decimals, ``n/a`` for a gap."""
    return comparison.select("rank", model, *[
        metric_text(F.col(name)).alias(name) for name in METRIC_NAMES
    ])


def confusion_table(comparison: DataFrame, model: str = "model") -> DataFrame:
    """Confusion cells per model."""
    return comparison.select(
        model, F.col("true_negatives").alias("tn"), F.col("false_positives").alias("fp"),
        F.col("false_negatives").alias("fn"), F.col("true_positives").alias("tp"))


def comparison_json(comparison: DataFrame, model: str = "model") -> DataFrame:
    """One row with a JSON text: ranking metric, ranked names best first, unranked names
    and every model's metrics, undefined ones as null."""
    name, cells = F.col(model), [c for c in comparison.columns if c not in ("ordinal", "rank", "ranking_metric")]
    placed = F.array_sort(F.collect_list(F.struct(
        F.coalesce("rank", F.lit(2**31 - 1)).alias("place"), "ordinal", "rank", name.alias("name"),
        F.struct(*cells).alias("evaluation"))))
    listed = comparison.agg(F.first("ranking_metric").alias("ranking_metric"), placed.alias("models"))

    def names(ranked: bool):
        kept = F.filter("models", lambda m: m["rank"].isNotNull() == F.lit(ranked))
        return F.transform(kept, lambda m: m["name"])

    # The names of the entries.
    return listed.select(json_text(
        "ranking_metric", names(True).alias("order"), names(False).alias("unranked"),
        F.col("models.evaluation").alias("evaluations")).alias("value"))


def write_comparison_json(comparison: DataFrame, path: str, mode: str = "error", model: str = "model") -> None:
    """Write :func:`comparison_json` as text."""
    comparison_json(comparison, model).write.mode(mode).text(path)
