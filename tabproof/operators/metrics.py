"""Binary classification metrics and curve points, exact and fully distributed.

A metric without a value stays null and its name is listed in ``undefined``.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabproof.errors import EvaluationError
from tabproof.functions.columns import is_finite, is_numeric, quoted, safe_ratio, share_text
from tabproof.operators.ordered import cell_facts, range_edges, running_counts, score_counts
from tabproof.operators.quantile import coarse_cell
from tabproof.sources.shared import stored

# Fixed value: the conventional cut-off.
DECISION_THRESHOLD = 0.5
# Metric names in the order of a comparison table.
METRIC_NAMES = ("accuracy", "precision", "recall", "f1", "specificity", "roc_auc", "pr_auc")
# The order in which undefined metrics are named.
UNDEFINED_ORDER = ("precision", "recall", "sensitivity", "specificity", "f1", "roc_auc", "pr_auc")


def _score_parts(df: DataFrame, score: str) -> tuple[Column, Column]:
    """(positive-class score, whether the row has the right number of probabilities)."""
    kind, column = df.schema[score].dataType, quoted(score)
    if isinstance(kind, VectorUDT):
        column = vector_to_array(column)
    elif not isinstance(kind, T.ArrayType):
        if not is_numeric(kind):
            raise EvaluationError(f"score column '{score}' is {kind.simpleString()}, not numeric")
        return column.cast("double"), F.lit(True)
    return F.get(column, F.lit(1)).cast("double"), F.size(column) == 2


def positive_score(df: DataFrame, score: str) -> Column:
    """Score of the positive class: a plain score, or the second of two probabilities."""
    return _score_parts(df, score)[0]


def _check_threshold(threshold: float) -> None:
    if not 0.0 < threshold < 1.0:
        raise EvaluationError(f"threshold {threshold} is not above 0 and below 1")


def _is_binary(column: Column) -> Column:
    return F.coalesce(column.cast("double").isin(0.0, 1.0), F.lit(False))


def hard_predictions(
    df: DataFrame, score: str, threshold: float = DECISION_THRESHOLD, name: str = "predicted"
) -> DataFrame:
    """Add the 0/1 prediction; a score equal to the threshold is positive."""
    _check_threshold(threshold)
    return df.withColumn(name, (positive_score(df, score) >= F.lit(threshold)).cast("int"))


def _checked(df: DataFrame, label: str, score: str, by=()):
    """Label and score columns and the facts of one pass that checks both.

    The facts hold ``rows``, ``positives``, the range ``edges`` of the scores and whether
    some group has a ``single`` class. Edges are drawn over all groups together, so a range
    holds no more rows of one group than of all. With groups, what the pass counts is
    stored, as there may be any number of them.
    """
    if not is_numeric(df.schema[label].dataType):
        raise EvaluationError(f"label column '{label}' is not numeric")
    truth = quoted(label)
    value, right_width = _score_parts(df, score)
    usable = F.when(is_finite(value), value)
    checks = {
        "rows": F.count(F.lit(1)),
        "positives": F.count_if(truth.cast("double") == 1.0),
        "labels": F.count_if(~_is_binary(truth)),
        "widths": F.count_if(~F.coalesce(right_width, F.lit(False))),
        "infinite": F.count_if(~is_finite(value)),
        "outside": F.count_if(is_finite(value) & ~value.between(0.0, 1.0)),
    }
    cells = df.groupBy(*by, coarse_cell(usable).alias("__cell")).agg(
        *[count.alias(f"__{name}") for name, count in checks.items()], *cell_facts(usable))
    single = False
    if by:
        groups = stored(cells, "score-cells")
        classes = groups.groupBy(*by).agg(F.sum("__rows").alias("__rows"), F.sum("__positives").alias("__positives"))
        single = bool(classes.where("__positives = 0 OR __positives = __rows").limit(1).count())
        cells = groups.groupBy("__cell").agg(
            *[F.sum(f"__{name}").alias(f"__{name}") for name in checks],
            F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    cells = cells.collect()
    facts = {name: sum(cell[f"__{name}"] for cell in cells) for name in checks}
    if not facts["rows"]:
        raise EvaluationError("there are no observations")
    for count, problem in (
        (facts["labels"], "label(s) are not 0 or 1"),
        (facts["widths"], "row(s) do not have exactly two probabilities"),
        (facts["infinite"], "score(s) are missing or not finite"),
        (facts["outside"], "score(s) lie outside [0, 1]"),
    ):
        if count:
            raise EvaluationError(f"{count} {problem}")
    facts["edges"] = range_edges(df, usable, cells)
    facts["single"] = single or facts["positives"] in (0, facts["rows"])
    return truth, value, facts


def confusion_counts(df: DataFrame, label: str, predicted: str, by=()) -> DataFrame:
    """The four confusion cells and their total, one row (per group)."""
    truth, guess = quoted(label), quoted(predicted)
    # Cast first: a boolean is a label like any other.
    bad = df.agg(
        F.count_if(~_is_binary(truth)).alias("label"), F.count_if(~_is_binary(guess)).alias("guess"),
    ).first()
    for count, name in ((bad["label"], label), (bad["guess"], predicted)):
        if count:
            raise EvaluationError(f"column '{name}' has {count} value(s) other than 0 and 1")
    t, g = truth.cast("int"), guess.cast("int")
    return df.groupBy(*by).agg(
        F.count_if((t == 1) & (g == 1)).alias("true_positives"),
        F.count_if((t == 0) & (g == 1)).alias("false_positives"),
        F.count_if((t == 0) & (g == 0)).alias("true_negatives"),
        F.count_if((t == 1) & (g == 0)).alias("false_negatives"),
        F.count(F.lit(1)).alias("total"),
    )


def confusion_cells(counts: DataFrame, by=()) -> DataFrame:
    """The confusion matrix as four rows, each cell with its share of the total."""
    cells = F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n"))
        for a, p, c in (
            (0, 0, "true_negatives"), (0, 1, "false_positives"),
            (1, 0, "false_negatives"), (1, 1, "true_positives"),
        )
    ])
    return counts.select(*by, "total", F.inline(cells)).select(
        *by, "actual", "predicted", "n", share_text(F.col("n"), F.col("total")).alias("share"))


def binary_metrics(
    df: DataFrame, label: str, score: str, threshold: float = DECISION_THRESHOLD, by=(),
) -> DataFrame:
    """Every metric in one row (per group named in ``by``, such as the model).

    ROC-AUC and average precision come from the scores, never from hard predictions.
    """
    _check_threshold(threshold)
    truth, value, facts = _checked(df, label, score)
    by = [by] if isinstance(by, str) else list(by)
    ranked = running_counts(score_counts(df, truth, value, by), facts["edges"], by)
    pos, neg = F.col("pos"), F.col("neg")
    cum_pos, cum_neg = F.col("cum_pos").cast("double"), F.col("cum_neg").cast("double")
    chosen = F.col("score") >= F.lit(threshold)
    none = F.lit(0).cast("bigint")
    cells = ranked.groupBy(*by).agg(
        F.sum(F.when(chosen, pos).otherwise(none)).alias("true_positives"),
        F.sum(F.when(chosen, neg).otherwise(none)).alias("false_positives"),
        F.sum(F.when(~chosen, neg).otherwise(none)).alias("true_negatives"),
        F.sum(F.when(~chosen, pos).otherwise(none)).alias("false_negatives"),
        F.sum(pos + neg).alias("n_samples"),
        F.sum(neg * (cum_pos - pos / 2)).alias("pairs"),
        F.sum(pos * cum_pos / (cum_pos + cum_neg)).alias("steps"),
    )
    tp, fp = F.col("true_positives"), F.col("false_positives")
    tn, fn = F.col("true_negatives"), F.col("false_negatives")
    positives, negatives = (tp + fn).cast("double"), (tn + fp).cast("double")
    two_classes = (positives > 0) & (negatives > 0)
    rated = cells.select(
        *by,
        safe_ratio(tp + tn, F.col("n_samples")).alias("accuracy"),
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, tp + fn).alias("recall"),
        safe_ratio(tn, tn + fp).alias("specificity"),
        F.when(two_classes, F.try_divide(F.col("pairs"), positives * negatives)).alias("roc_auc"),
        F.when(two_classes, F.try_divide(F.col("steps"), positives)).alias("pr_auc"),
        "true_positives", "false_positives", "true_negatives", "false_negatives", "n_samples",
    )
    f1 = safe_ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    full = rated.withColumn("sensitivity", F.col("recall")).withColumn("f1", f1)
    undefined = F.array_compact(F.array(*[
        F.when(F.col(name).isNull(), F.lit(name)) for name in UNDEFINED_ORDER
    ]))
    return full.select(
        *by, "accuracy", "precision", "recall", "f1", "specificity", "sensitivity",
        "roc_auc", "pr_auc", F.lit(float(threshold)).alias("threshold"),
        "true_positives", "false_positives", "true_negatives", "false_negatives",
        "n_samples", undefined.alias("undefined"),
    )


def roc_points(df: DataFrame, label: str, score: str, by=()) -> DataFrame:
    """ROC curve: (fpr, tpr, threshold), corners only, starting at (0, 0, +inf).

    Points in the middle of a straight run of single steps are left out.
    """
    by = [by] if isinstance(by, str) else list(by)
    truth, value, facts = _checked(df, label, score, by)
    if facts["single"]:
        raise EvaluationError("a ROC curve needs both classes; only one is present")
    ranked = running_counts(score_counts(df, truth, value, by), facts["edges"], by)
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    last = F.col("next_pos").isNull()
    corner = (F.col("pos") != F.col("next_pos")) | (F.col("neg") != F.col("next_neg"))
    point = F.struct(
        safe_ratio(F.col("cum_neg"), F.col("all_neg")).alias("fpr"),
        safe_ratio(F.col("cum_pos"), F.col("all_pos")).alias("tpr"),
        F.col("score").alias("threshold"),
    )
    origin = F.struct(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold"))
    points = F.when(first, F.array(origin, point)).otherwise(F.array(point))
    return ranked.where(first | last | corner).select(*by, F.inline(points))


def pr_points(df: DataFrame, label: str, score: str, by=()) -> DataFrame:
    """Precision-recall curve: (recall, precision, threshold).

    One point per distinct score plus the end point (0, 1) without a threshold.
    Recall is 1 everywhere when there are no positives.
    """
    truth, value, facts = _checked(df, label, score)
    by = [by] if isinstance(by, str) else list(by)
    ranked = running_counts(score_counts(df, truth, value, by), facts["edges"], by)
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    point = F.struct(
        F.coalesce(safe_ratio(F.col("cum_pos"), F.col("all_pos")), F.lit(1.0)).alias("recall"),
        safe_ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        F.col("score").alias("threshold"),
    )
    end = F.struct(
        F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision"),
        F.lit(None).cast("double").alias("threshold"))
    points = F.when(first, F.array(point, end)).otherwise(F.array(point))
    return ranked.select(*by, F.inline(points))


def positive_rate(df: DataFrame, label: str) -> DataFrame:
    """Share of positives: the baseline of a precision-recall curve."""
    return df.agg(F.avg(quoted(label).cast("double")).alias("positive_rate"))
