"""Predictions, metrics, curves, alignment and comparison."""

from pyspark.sql import functions as F

from tabproof.operators.align import align_by_position, align_scores, alignment_summary
from tabproof.operators.compare import (
    compare_models, comparison_table, comparison_text, confusion_table, stack_evaluations,
    write_comparison_json,
)
from tabproof.operators.metrics import (
    binary_metrics, confusion_cells, confusion_counts, hard_predictions, positive_rate,
    pr_points, roc_points,
)
from tabproof.sources.shared import shared_folder
from workload.tables import LINEITEM_SQL, SCORED_SQL, lineitem, scored_lineitem, table

RATIOS = [
    "accuracy", "precision", "recall", "f1", "specificity", "sensitivity", "roc_auc", "pr_auc",
]
CELLS = ["true_positives", "false_positives", "true_negatives", "false_negatives", "n_samples"]
DIGITS = 9


def _shown(metrics, *keys):
    return metrics.select(
        *keys, *[F.round(c, DIGITS).alias(c) for c in RATIOS], "threshold", *CELLS,
        F.array_join("undefined", ",").alias("undefined"))


def _metrics_sql(rows, by=(), threshold=0.5):
    """Metrics of ``rows``, a query with label, score and the group columns."""
    keys = "".join(f"{c}, " for c in by)
    partition = f"PARTITION BY {', '.join(by)} " if by else ""
    group = f"GROUP BY {', '.join(by)}" if by else ""
    return f"""
    WITH r AS ({rows}),
    d AS (SELECT {keys}score, sum(label)::BIGINT AS pos, (count(*) - sum(label))::BIGINT AS neg
          FROM r GROUP BY {keys}score),
    w AS (SELECT *, sum(pos) OVER ({partition}ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cp,
                 sum(neg) OVER ({partition}ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cn
          FROM d),
    c AS (SELECT {keys}
                 coalesce(sum(pos) FILTER (score >= {threshold}), 0)::BIGINT AS tp,
                 coalesce(sum(neg) FILTER (score >= {threshold}), 0)::BIGINT AS fp,
                 coalesce(sum(neg) FILTER (score < {threshold}), 0)::BIGINT AS tn,
                 coalesce(sum(pos) FILTER (score < {threshold}), 0)::BIGINT AS fn,
                 sum(pos)::DOUBLE AS total_pos, sum(neg)::DOUBLE AS total_neg,
                 sum(neg::DOUBLE * (cp::DOUBLE - pos::DOUBLE / 2)) AS pairs,
                 sum(pos::DOUBLE * cp::DOUBLE / (cp::DOUBLE + cn::DOUBLE)) AS steps
          FROM w {group}),
    m AS (SELECT {keys}(tp + tn)::DOUBLE / (tp + fp + tn + fn) AS accuracy,
                 tp::DOUBLE / nullif(tp + fp, 0) AS precision,
                 tp::DOUBLE / nullif(tp + fn, 0) AS recall,
                 tn::DOUBLE / nullif(tn + fp, 0) AS specificity,
                 CASE WHEN total_pos > 0 AND total_neg > 0 THEN pairs / (total_pos * total_neg) END AS roc_auc,
                 CASE WHEN total_pos > 0 AND total_neg > 0 THEN steps / total_pos END AS pr_auc,
                 tp, fp, tn, fn FROM c),
    n AS (SELECT *, 2 * precision * recall / nullif(precision + recall, 0) AS f1 FROM m)
    SELECT {keys}round(accuracy, {DIGITS}) AS accuracy, round(precision, {DIGITS}) AS precision,
           round(recall, {DIGITS}) AS recall, round(f1, {DIGITS}) AS f1,
           round(specificity, {DIGITS}) AS specificity, round(recall, {DIGITS}) AS sensitivity,
           round(roc_auc, {DIGITS}) AS roc_auc, round(pr_auc, {DIGITS}) AS pr_auc,
           CAST({threshold} AS DOUBLE) AS threshold,
           tp AS true_positives, fp AS false_positives, tn AS true_negatives, fn AS false_negatives,
           tp + fp + tn + fn AS n_samples,
           concat_ws(',', CASE WHEN precision IS NULL THEN 'precision' END,
                     CASE WHEN recall IS NULL THEN 'recall' END,
                     CASE WHEN recall IS NULL THEN 'sensitivity' END,
                     CASE WHEN specificity IS NULL THEN 'specificity' END,
                     CASE WHEN f1 IS NULL THEN 'f1' END,
                     CASE WHEN roc_auc IS NULL THEN 'roc_auc' END,
                     CASE WHEN pr_auc IS NULL THEN 'pr_auc' END) AS undefined
    FROM n"""


def predictions(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.round(5 * F.col("l_discount") + 2 * F.col("l_tax"), 4).alias("score"))
    return hard_predictions(df, "score", 0.5)


PREDICTIONS_SQL = """
    WITH s AS (SELECT l_orderkey, l_linenumber, round(5 * l_discount + 2 * l_tax, 4) AS score FROM lineitem)
    SELECT *, CAST(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS INTEGER) AS predicted FROM s
"""


def _predicted(spark, sf_dir):
    return hard_predictions(scored_lineitem(spark, sf_dir), "tied", 0.5)


def confusion(spark, sf_dir):
    return confusion_counts(_predicted(spark, sf_dir), "label", "predicted")


CONFUSION_SQL = f"""
    SELECT CAST(count(*) FILTER (label = 1 AND tied >= 0.5) AS BIGINT) AS true_positives,
           CAST(count(*) FILTER (label = 0 AND tied >= 0.5) AS BIGINT) AS false_positives,
           CAST(count(*) FILTER (label = 0 AND tied < 0.5) AS BIGINT) AS true_negatives,
           CAST(count(*) FILTER (label = 1 AND tied < 0.5) AS BIGINT) AS false_negatives,
           CAST(count(*) AS BIGINT) AS total
    FROM ({SCORED_SQL})
"""


def confusion_matrix(spark, sf_dir):
    return confusion_cells(confusion(spark, sf_dir))


CONFUSION_MATRIX_SQL = f"""
    WITH s AS ({SCORED_SQL}),
    c AS (SELECT label AS actual, CASE WHEN tied >= 0.5 THEN 1 ELSE 0 END AS predicted, count(*) AS n
          FROM s GROUP BY ALL),
    k AS (SELECT a.v AS actual, p.v AS predicted
          FROM (VALUES (0), (1)) AS a(v), (VALUES (0), (1)) AS p(v))
    SELECT CAST(k.actual AS INTEGER) AS actual, CAST(k.predicted AS INTEGER) AS predicted,
           CAST(coalesce(n, 0) AS BIGINT) AS n,
           printf('%.1f%%', 100.0::DOUBLE * coalesce(n, 0) / (SELECT count(*) FROM s)) AS share
    FROM k LEFT JOIN c ON c.actual = k.actual AND c.predicted = k.predicted
"""


def metrics_tied(spark, sf_dir):
    return _shown(binary_metrics(scored_lineitem(spark, sf_dir), "label", "tied"))


def metrics_fine(spark, sf_dir):
    return _shown(binary_metrics(scored_lineitem(spark, sf_dir), "label", "fine", threshold=0.3))


def metrics_from_probabilities(spark, sf_dir):
    """The same metrics from a column of two probabilities per row."""
    df = scored_lineitem(spark, sf_dir).select(
        "label", F.array(1 - F.col("tied"), F.col("tied")).alias("probability"))
    return _shown(binary_metrics(df, "label", "probability"))


MODELS = ("coarse", "fine", "tied")


def _long(spark, sf_dir):
    """Three scores of the same rows under each other, as three models produce them."""
    df = scored_lineitem(spark, sf_dir)
    scores = F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(m).alias("model"), F.col(m).alias("score"))
        for i, m in enumerate(MODELS)
    ])
    return df.select("label", F.inline(scores))


LONG_SQL = f"WITH s AS ({SCORED_SQL}) " + " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS ordinal, '{m}' AS model, label, {m} AS score FROM s"
    for i, m in enumerate(MODELS))


def metrics_by_model(spark, sf_dir):
    by = ["ordinal", "model"]
    return _shown(binary_metrics(_long(spark, sf_dir), "label", "score", by=by), *by)


METRICS_BY_MODEL_SQL = _metrics_sql(LONG_SQL, ("ordinal", "model"))


def undefined_metrics(spark, sf_dir):
    """Scores of returned lines only: one class is absent."""
    df = scored_lineitem(spark, sf_dir).where("label = 1")
    return _shown(binary_metrics(df, "label", "tied", threshold=0.9))


UNDEFINED_SQL = _metrics_sql(
    f"SELECT label, tied AS score FROM ({SCORED_SQL}) WHERE label = 1", threshold=0.9)


def _points(df, names):
    return df.select(*[F.round(c, DIGITS).alias(c) for c in names], "threshold")


def roc_tied(spark, sf_dir):
    return _points(roc_points(scored_lineitem(spark, sf_dir), "label", "tied"), ["fpr", "tpr"])


def roc_fine(spark, sf_dir):
    return _points(roc_points(scored_lineitem(spark, sf_dir), "label", "fine"), ["fpr", "tpr"])


def pr_tied(spark, sf_dir):
    return _points(pr_points(scored_lineitem(spark, sf_dir), "label", "tied"), ["recall", "precision"])


def pr_fine(spark, sf_dir):
    return _points(pr_points(scored_lineitem(spark, sf_dir), "label", "fine"), ["recall", "precision"])


def _curve_cte(score):
    return f"""
    WITH r AS ({SCORED_SQL}),
    d AS (SELECT {score} AS score, sum(label)::BIGINT AS pos, (count(*) - sum(label))::BIGINT AS neg
          FROM r GROUP BY {score}),
    w AS (SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)::DOUBLE AS cp,
                 sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)::DOUBLE AS cn,
                 lead(pos) OVER (ORDER BY score DESC) AS next_pos,
                 lead(neg) OVER (ORDER BY score DESC) AS next_neg,
                 row_number() OVER (ORDER BY score DESC) AS i,
                 sum(pos) OVER ()::DOUBLE AS all_pos, sum(neg) OVER ()::DOUBLE AS all_neg
          FROM d)"""


def _roc_sql(score):
    return _curve_cte(score) + f"""
    SELECT round(cn / all_neg, {DIGITS}) AS fpr, round(cp / all_pos, {DIGITS}) AS tpr, score AS threshold
    FROM w WHERE i = 1 OR next_pos IS NULL OR pos <> next_pos OR neg <> next_neg
    UNION ALL SELECT 0.0::DOUBLE, 0.0::DOUBLE, 'infinity'::DOUBLE"""


def _pr_sql(score):
    return _curve_cte(score) + f"""
    SELECT round(cp / all_pos, {DIGITS}) AS recall, round(cp / (cp + cn), {DIGITS}) AS precision,
           score AS threshold
    FROM w UNION ALL SELECT 0.0::DOUBLE, 1.0::DOUBLE, NULL"""


def roc_by_segment(spark, sf_dir):
    """A curve per line status of scores whose ranges are very unequal."""
    return roc_points(_segments(spark, sf_dir), "label", "score", "segment").select(
        "segment", *[F.round(c, DIGITS).alias(c) for c in ("fpr", "tpr")], "threshold")


def _segments(spark, sf_dir):
    scored = scored_lineitem(spark, sf_dir)
    return scored.select(
        "label", F.col("l_linestatus").alias("segment"),
        F.when(F.col("l_linestatus") == "O", F.col("fine") / 1e6).otherwise(F.col("fine")).alias("score"))


_SEGMENTS_SQL = f"""
    SELECT label, l_linestatus AS segment,
           CASE WHEN l_linestatus = 'O' THEN fine / 1e6::DOUBLE ELSE fine END AS score FROM ({SCORED_SQL})
"""
ROC_BY_SEGMENT_SQL = f"""
    WITH d AS (SELECT segment, score, sum(label)::BIGINT AS pos, (count(*) - sum(label))::BIGINT AS neg
               FROM ({_SEGMENTS_SQL}) GROUP BY segment, score),
    w AS (SELECT *, sum(pos) OVER down AS cp, sum(neg) OVER down AS cn, row_number() OVER down AS i,
                 lead(pos) OVER down AS next_pos, lead(neg) OVER down AS next_neg,
                 sum(pos) OVER one::DOUBLE AS all_pos, sum(neg) OVER one::DOUBLE AS all_neg
          FROM d WINDOW down AS (PARTITION BY segment ORDER BY score DESC), one AS (PARTITION BY segment))
    SELECT segment, round(cn / all_neg, {DIGITS}) AS fpr, round(cp / all_pos, {DIGITS}) AS tpr, score AS threshold
    FROM w WHERE i = 1 OR next_pos IS NULL OR pos <> next_pos OR neg <> next_neg
    UNION ALL SELECT DISTINCT segment, 0.0::DOUBLE, 0.0::DOUBLE, 'infinity'::DOUBLE FROM d
"""


def returned_rate(spark, sf_dir):
    return _points_rate(positive_rate(lineitem(spark, sf_dir), "returned"))


def _points_rate(df):
    return df.select(F.round("positive_rate", DIGITS).alias("positive_rate"))


RATE_SQL = f"SELECT round(avg(returned), {DIGITS}) AS positive_rate FROM ({LINEITEM_SQL})"


def alignment(spark, sf_dir):
    """How documents and labels pair up; most documents have no label."""
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("n_chars").cast("double").alias("score"))
    return alignment_summary(
        table(spark, sf_dir, "labels"), documents, "doc_id", "quality", "score")


ALIGNMENT_SQL = """
    WITH j AS (SELECT l.doc_id AS a, d.doc_id AS b FROM labels l FULL JOIN documents d ON l.doc_id = d.doc_id)
    SELECT CAST(count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS BIGINT) AS matched,
           CAST(count(*) FILTER (b IS NULL) AS BIGINT) AS truth_only,
           CAST(count(*) FILTER (a IS NULL) AS BIGINT) AS scores_only,
           CAST(0 AS BIGINT) AS repeated
    FROM j
"""


def aligned_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    truth = orders.select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("label"))
    scores = orders.select("o_orderkey", (F.col("o_totalprice") / 1e6).alias("score"))
    return align_scores(truth, scores, "o_orderkey", "label", "score")


ALIGNED_SQL = """
    SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS label, o_totalprice / 1e6::DOUBLE AS score
    FROM orders
"""


def _comparison(spark, sf_dir):
    by = ["ordinal", "model"]
    return compare_models(binary_metrics(_long(spark, sf_dir), "label", "score", by=by), "roc_auc")


COMPARED = ["accuracy", "precision", "recall", "f1", "specificity", "roc_auc", "pr_auc"]


def compared(spark, sf_dir):
    shown = comparison_table(_comparison(spark, sf_dir))
    return shown.select(
        "rank", "model", *[F.round(c, DIGITS).alias(c) for c in COMPARED], "n_samples")


COMPARED_SQL = f"""
    SELECT CAST(row_number() OVER (ORDER BY roc_auc DESC, ordinal) AS INTEGER) AS rank, model,
           {", ".join(COMPARED)}, n_samples
    FROM ({METRICS_BY_MODEL_SQL})
"""


def compared_text(spark, sf_dir):
    return comparison_text(_comparison(spark, sf_dir))


COMPARED_TEXT_SQL = "SELECT rank, model, " + ", ".join(
    f"coalesce(printf('%.4f', {c}), 'n/a') AS {c}" for c in COMPARED) + f" FROM ({COMPARED_SQL})"


def compared_confusion(spark, sf_dir):
    return confusion_table(_comparison(spark, sf_dir))


COMPARED_CONFUSION_SQL = f"""
    SELECT model, true_negatives AS tn, false_positives AS fp, false_negatives AS fn,
           true_positives AS tp FROM ({METRICS_BY_MODEL_SQL})
"""

def aligned_by_position(spark, sf_dir):
    """Labels and scores in files of their own, in the same order and without ids."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        (F.col("o_totalprice") / 1e6).alias("score"))

    def written(column, parts):
        folder = shared_folder(spark, f"{column}-by-position")
        ordered = orders.repartitionByRange(parts, "o_orderkey").sortWithinPartitions("o_orderkey")
        ordered.select(column).write.parquet(folder)
        return spark.read.parquet(folder)

    return align_by_position(written("label", 3), written("score", 5), "label", "score")


POSITION_SQL = """
    SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS position,
           CAST(o_orderstatus = 'F' AS INTEGER) AS label, o_totalprice / 1e6::DOUBLE AS score
    FROM orders
"""


def stacked_evaluations(spark, sf_dir):
    """Models evaluated apart, with thresholds of their own, stacked and ranked."""
    scored = scored_lineitem(spark, sf_dir)
    evaluations = [
        binary_metrics(scored, "label", name, threshold).withColumn("model", F.lit(name))
        for name, threshold in STACKED]
    ranked = compare_models(stack_evaluations(evaluations), "accuracy")
    return _shown(ranked, "rank", "ordinal", "model")


STACKED = (("coarse", 0.7), ("tied", 0.5), ("fine", 0.3))
STACKED_SQL = "SELECT CAST(row_number() OVER (ORDER BY accuracy DESC, ordinal) AS INTEGER) AS rank, * FROM (" + (
    " UNION ALL ".join(
        f"SELECT {i} AS ordinal, '{name}' AS model, * FROM ("
        + _metrics_sql(f"SELECT label, {name} AS score FROM ({SCORED_SQL})", threshold=threshold) + ")"
        for i, (name, threshold) in enumerate(STACKED))) + ")"


def comparison_json(spark, sf_dir):
    """A comparison written as JSON and read back; ``returned_only`` cannot be ranked."""
    rows = _long(spark, sf_dir).select("ordinal", "model", "label", "score")
    one_class = scored_lineitem(spark, sf_dir).where("label = 1").select(
        F.lit(9).alias("ordinal"), F.lit("returned_only").alias("model"), "label", F.col("coarse").alias("score"))
    metrics = binary_metrics(rows.unionByName(one_class), "label", "score", by=["ordinal", "model"])
    folder = shared_folder(spark, "comparison")
    write_comparison_json(compare_models(metrics, "roc_auc"), folder)
    found = spark.read.json(folder)
    order = F.array_join("order", ",").alias("ranked_names")
    each = found.select("ranking_metric", order, F.array_join("unranked", ",").alias("unranked_names"),
                        F.posexplode("evaluations").alias("place", "e"))
    return each.select(
        "ranking_metric", "ranked_names", "unranked_names", "place", F.col("e.model").alias("model"),
        *[F.round(f"e.{c}", DIGITS).alias(c) for c in COMPARED], F.col("e.n_samples").alias("n_samples"))


_WITH_UNRANKED_SQL = f"""
    SELECT model, ordinal, {", ".join(COMPARED)}, n_samples FROM ({METRICS_BY_MODEL_SQL})
    UNION ALL SELECT 'returned_only', 9, {", ".join(COMPARED)}, n_samples
    FROM ({_metrics_sql(f"SELECT label, coarse AS score FROM ({SCORED_SQL}) WHERE label = 1")})
"""
COMPARISON_JSON_SQL = f"""
    WITH m AS ({_WITH_UNRANKED_SQL})
    SELECT 'roc_auc' AS ranking_metric,
           (SELECT string_agg(model, ',' ORDER BY roc_auc DESC, ordinal) FROM m WHERE roc_auc IS NOT NULL) AS ranked_names,
           (SELECT string_agg(model, ',' ORDER BY ordinal) FROM m WHERE roc_auc IS NULL) AS unranked_names,
           CAST(row_number() OVER (ORDER BY roc_auc DESC NULLS LAST, ordinal) - 1 AS INTEGER) AS place,
           model, {", ".join(COMPARED)}, n_samples
    FROM m
"""

QUERIES = {
    "roc_points_by_segment": roc_by_segment,
    "aligned_by_position": aligned_by_position,
    "stacked_evaluations": stacked_evaluations,
    "comparison_json": comparison_json,
    "hard_predictions": predictions,
    "confusion_counts": confusion,
    "confusion_matrix": confusion_matrix,
    "binary_metrics": metrics_tied,
    "binary_metrics_fine_scores": metrics_fine,
    "binary_metrics_from_probabilities": metrics_from_probabilities,
    "binary_metrics_by_model": metrics_by_model,
    "undefined_metrics": undefined_metrics,
    "roc_points": roc_tied,
    "roc_points_fine_scores": roc_fine,
    "pr_points": pr_tied,
    "pr_points_fine_scores": pr_fine,
    "positive_rate": returned_rate,
    "align_truth_scores": alignment,
    "aligned_scores": aligned_orders,
    "compare_models": compared,
    "comparison_text": compared_text,
    "confusion_table": compared_confusion,
}

ORACLES = {
    "roc_points_by_segment": ROC_BY_SEGMENT_SQL,
    "aligned_by_position": POSITION_SQL,
    "stacked_evaluations": STACKED_SQL,
    "comparison_json": COMPARISON_JSON_SQL,
    "hard_predictions": PREDICTIONS_SQL,
    "confusion_counts": CONFUSION_SQL,
    "confusion_matrix": CONFUSION_MATRIX_SQL,
    "binary_metrics": _metrics_sql(f"SELECT label, tied AS score FROM ({SCORED_SQL})"),
    "binary_metrics_fine_scores": _metrics_sql(
        f"SELECT label, fine AS score FROM ({SCORED_SQL})", threshold=0.3),
    "binary_metrics_from_probabilities": _metrics_sql(
        f"SELECT label, tied AS score FROM ({SCORED_SQL})"),
    "binary_metrics_by_model": METRICS_BY_MODEL_SQL,
    "undefined_metrics": UNDEFINED_SQL,
    "roc_points": _roc_sql("tied"),
    "roc_points_fine_scores": _roc_sql("fine"),
    "pr_points": _pr_sql("tied"),
    "pr_points_fine_scores": _pr_sql("fine"),
    "positive_rate": RATE_SQL,
    "align_truth_scores": ALIGNMENT_SQL,
    "aligned_scores": ALIGNED_SQL,
    "compare_models": COMPARED_SQL,
    "comparison_text": COMPARED_TEXT_SQL,
    "confusion_table": COMPARED_CONFUSION_SQL,
}
