"""Training and evaluating the baselines on labelled documents.

SQL cannot say what a learner fits. It can say which rows are held out and what has to be
true of the result: the gradient at the optimum, how predictions follow from probabilities,
and metrics that are counted again from the stored scores.
"""

import json
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabproof.operators.compare import compare_models, comparison_table
from tabproof.plans.training import (
    evaluate_models, load_metadata, load_model, metadata_frame, save_model, train_models,
    write_evaluation,
)
from tabproof.sources.csv import fingerprint
from tabproof.sources.shared import shared_folder, stored
from tabproof.streaming.scoring import (
    read_scores, running_confusion, score_stream, write_scores,
)
from workload.tables import (
    DOCUMENTS, LABELLED_SPLIT_SQL, LABELLED_SQL, labelled_documents,
)

NAMES = ("logistic_regression", "random_forest", "gradient_boosted_trees")


def _train(spark, sf_dir, *names, digest=""):
    return train_models(
        labelled_documents(spark, sf_dir), DOCUMENTS, "doc_id", names=names, source="documents", digest=digest)


def _sound(probability, predicted):
    """Probabilities are a distribution and the prediction follows the threshold."""
    p = vector_to_array(probability)
    sums = F.abs(p[0] + p[1] - 1) < 1e-9
    return sums & p[1].between(0, 1) & (predicted == (p[1] >= 0.5).cast("int"))


def _held_out_scores(name):
    def query(spark, sf_dir):
        experiment = _train(spark, sf_dir, name)
        predicted = experiment.models[0].predict(experiment.test)
        rows = stored(predicted.select(
            "doc_id", "quality", _sound(F.col("probability"), F.col("predicted")).alias("sound")), "scores")
        experiment.release()
        return rows
    return query


HELD_OUT_SQL = f"""
    SELECT doc_id, quality, TRUE AS sound FROM ({LABELLED_SPLIT_SQL}) WHERE partition = 'test'
"""


def optimum_gradient(spark, sf_dir):
    """Gradient of the penalised loss at the fitted coefficients, per feature, to 4 places.

    The loss is the mean over the training rows plus the penalty of ``C = 1``; both are
    taken on the standardised features that the fitted pipeline makes.
    """
    experiment = _train(spark, sf_dir, "logistic_regression")
    fitted = experiment.models[0]
    linear = fitted.pipeline.stages[-1]
    rows = fitted.pipeline.transform(experiment.train).select(
        vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("p"), "quality")
    error = F.col("p") - F.col("quality")
    n = experiment.plan.train_rows
    slopes = [
        (F.avg(error * F.col("x")[i]) + F.lit(float(w)) / n).alias(str(i))
        for i, w in enumerate(linear.coefficients)
    ]
    found = rows.agg(F.avg(error).alias("intercept"), *slopes).first()
    experiment.release()
    names = [*DOCUMENTS.feature_names, "intercept"]
    values = [found[str(i)] for i in range(len(names) - 1)] + [found["intercept"]]
    return spark.createDataFrame(
        [(name, abs(round(value, 4))) for name, value in zip(names, values, strict=True)],
        "feature string, gradient double")


GRADIENT_SQL = """
    SELECT unnest(['n_chars', 'n_words', 'n_lines', 'n_digits', 'n_stops', 'intercept']) AS feature,
           CAST(0 AS DOUBLE) AS gradient
"""


def _recounted(scored):
    """Metrics by model, counted from scores: cells by definition, area by average ranks."""
    by_score = Window.partitionBy("model").orderBy("score")
    same = Window.partitionBy("model", "score")
    ranked = scored.withColumn("position", F.rank().over(by_score) + (F.count(F.lit(1)).over(same) - 1) / 2)
    hit = (F.col("score") >= 0.5).cast("int")
    cells = ranked.groupBy("model").agg(
        F.avg((hit == F.col("quality")).cast("double")).alias("accuracy"),
        F.count_if((hit == 1) & (F.col("quality") == 1)).alias("true_positives"),
        F.count_if((hit == 1) & (F.col("quality") == 0)).alias("false_positives"),
        F.sum(F.when(F.col("quality") == 1, F.col("position"))).alias("ranks"),
        F.sum("quality").alias("positives"), F.sum(1 - F.col("quality")).alias("negatives"))
    area = (F.col("ranks") - F.col("positives") * (F.col("positives") + 1) / 2) / (
        F.col("positives") * F.col("negatives"))
    return cells.select(F.col("model").alias("of_model"), F.col("accuracy").alias("accuracy_again"),
                        F.col("true_positives").alias("tp_again"), F.col("false_positives").alias("fp_again"),
                        area.alias("area_again"), F.least("positives", "negatives").alias("fewer"))


def _evaluated(spark, sf_dir, *names):
    """Metrics beside the same counted again from the stored scores of the held-out rows."""
    experiment = _train(spark, sf_dir, *names)
    scores = None
    for model in experiment.models:
        part = model.predict_proba(experiment.test).select(
            F.lit(model.name).alias("model"), "quality", vector_to_array("probability")[1].alias("score"))
        scores = part if scores is None else scores.unionByName(part)
    again = _recounted(stored(scores, "score-table"))
    metrics = evaluate_models(experiment.models, experiment.test)
    experiment.release()
    return metrics, again


def _agrees():
    return (
        (F.abs(F.col("accuracy") - F.col("accuracy_again")) < 1e-9)
        & (F.abs(F.col("roc_auc") - F.col("area_again")) < 1e-9)
        & (F.col("true_positives") == F.col("tp_again")) & (F.col("false_positives") == F.col("fp_again")))


def evaluate_logistic_regression(spark, sf_dir):
    metrics, again = _evaluated(spark, sf_dir, "logistic_regression")
    return metrics.join(again, F.col("model") == F.col("of_model")).select(
        "model", "n_train", "n_test", "threshold", _agrees().alias("metrics_agree"))


_SIZES_SQL = f"""
    SELECT CAST(count(*) FILTER (partition = 'train') AS INTEGER) AS n_train,
           count(*) FILTER (partition = 'test') AS n_test FROM ({LABELLED_SPLIT_SQL})
"""
EVALUATE_SQL = f"""
    SELECT 'logistic_regression' AS model, n_train, n_test, CAST(0.5 AS DOUBLE) AS threshold,
           TRUE AS metrics_agree FROM ({_SIZES_SQL})
"""


def experiment_metadata(spark, sf_dir):
    """The reproducibility record: what SQL knows as it is, the rest by its form."""
    digest = fingerprint(spark, f"{sf_dir}/documents.parquet")
    experiment = _train(spark, sf_dir, "logistic_regression", digest=digest)
    record = metadata_frame(spark, experiment.models)
    experiment.release()
    fitted = F.from_json("preprocessing", "array<struct<feature:string, scale:double>>")
    return record.select(
        "model_name", "dataset_path", "row_count", "feature_names", "target", "random_state", "test_size",
        "decision_threshold", "train_size", "test_size_rows",
        F.col("dataset_sha256").rlike("^[0-9a-f]{64}$").alias("has_digest"),
        F.array_join(F.transform(fitted, lambda f: f["feature"]), ",").alias("prepared"),
        F.exists(fitted, lambda f: f["scale"].isNull() | (f["scale"] <= 0)).alias("lacks_scale"),
        F.get_json_object("model_configuration", "$.name").alias("configured"),
        F.col("created_at").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\+00:00$").alias("has_time"),
        F.col("project_version").rlike(r"^\d+\.\d+").alias("has_version"))


METADATA_SQL = f"""
    SELECT 'logistic_regression' AS model_name, 'documents' AS dataset_path,
           (SELECT count(*) FROM ({LABELLED_SQL})) AS row_count,
           '["n_chars", "n_words", "n_lines", "n_digits", "n_stops"]' AS feature_names, 'quality' AS target,
           CAST(42 AS BIGINT) AS random_state, n_test / CAST(n_train + n_test AS DOUBLE) AS test_size,
           CAST(0.5 AS DOUBLE) AS decision_threshold, CAST(n_train AS BIGINT) AS train_size,
           n_test AS test_size_rows, TRUE AS has_digest, 'n_chars,n_words,n_lines,n_digits,n_stops' AS prepared,
           FALSE AS lacks_scale, 'logistic_regression' AS configured, TRUE AS has_time, TRUE AS has_version
    FROM ({_SIZES_SQL})
"""


def baseline_comparison(spark, sf_dir):
    """All three baselines on one split, ranked as the areas counted from scores rank them.

    Each has to reach a stated area on held-out rows, give or take two standard errors, as
    small tables hold out few rows.
    """
    metrics, again = _evaluated(spark, sf_dir, *NAMES)
    listed = comparison_table(compare_models(metrics, "roc_auc")).select("rank", F.col("model").alias("listed"))
    joined = metrics.join(again, F.col("model") == F.col("of_model")).join(listed, F.col("model") == F.col("listed"))
    best_first = Window.partitionBy(F.lit(0)).orderBy(F.round("area_again", 9).desc(), "ordinal")
    # Standard error of an area, at most, when the rarer class has so few held-out rows.
    chance = F.sqrt(F.col("area_again") * (1 - F.col("area_again")) / F.col("fewer"))
    return joined.select(
        "model", "n_train", "n_test", _agrees().alias("metrics_agree"),
        (F.col("rank") == F.row_number().over(best_first)).alias("ranked"),
        (F.col("area_again") + 2 * chance >= LEAST_AREA).alias("learned"))


#: Area under the curve on held-out rows that every baseline has to reach.
LEAST_AREA = 0.7


COMPARISON_SQL = f"""
    SELECT unnest(['logistic_regression', 'random_forest', 'gradient_boosted_trees']) AS model,
           n_train, n_test, TRUE AS metrics_agree, TRUE AS ranked, TRUE AS learned FROM ({_SIZES_SQL})
"""


def saved_model(spark, sf_dir):
    """Held-out rows with whether a model that was saved and loaded scores them the same."""
    experiment = _train(spark, sf_dir, "logistic_regression")
    path = shared_folder(spark, "model")
    save_model(experiment.models[0], path)
    again = load_model(path)
    before = experiment.models[0].predict_proba(experiment.test).select(
        "doc_id", vector_to_array("probability")[1].alias("before"))
    after = again.transform(experiment.test).select(
        F.col("doc_id").alias("id"), vector_to_array("probability")[1].alias("after"))
    rows = stored(before.join(after, F.col("doc_id") == F.col("id")).select(
        "doc_id", (F.col("before") == F.col("after")).alias("same")), "reloaded")
    experiment.release()
    same_record = json.dumps(load_metadata(spark, path), sort_keys=True) == json.dumps(
        experiment.models[0].metadata, sort_keys=True)
    return rows.withColumn("same", F.col("same") & F.lit(same_record))


SAVED_SQL = f"""
    SELECT doc_id, TRUE AS same FROM ({LABELLED_SPLIT_SQL}) WHERE partition = 'test'
"""

def evaluation_parts(spark, sf_dir):
    """An evaluation written in parts and read back: what each part says, as rows."""
    experiment = _train(spark, sf_dir, "logistic_regression")
    metrics = evaluate_models(experiment.models, experiment.test)
    folder = shared_folder(spark, "evaluation")
    write_evaluation(experiment, compare_models(metrics, "roc_auc"), folder)
    experiment.release()

    def facts(part, name, value):
        return spark.read.json(f"{folder}/{part}").select(
            F.lit(part).alias("part"), name.cast("string").alias("name"), value.cast("bigint").alias("value"))

    split = spark.read.json(f"{folder}/split").unpivot(
        [], ["row_count", "train_rows", "test_rows", "seed"], "name", "value")
    parts = [
        facts("class_distribution", F.col("label"), F.col("n")),
        split.select(F.lit("split").alias("part"), "name", F.col("value").cast("bigint").alias("value")),
        facts("preparation", F.col("feature"), F.col("position")),
        facts("models", F.col("model_name"), F.col("train_size")),
        facts("comparison", F.col("model"), F.col("n_samples")),
        facts("confusion", F.col("model"), F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")),
        facts("ranking", F.concat_ws(":", "ranking_metric", F.array_join("order", ",")), F.size("unranked")),
    ]
    return reduce(DataFrame.unionByName, parts)


EVALUATION_SQL = f"""
    WITH d AS ({LABELLED_SPLIT_SQL}), n AS ({_SIZES_SQL})
    SELECT 'class_distribution' AS part, CAST(quality AS VARCHAR) AS name, count(*) AS value FROM d GROUP BY quality
    UNION ALL SELECT 'split', unnest(['row_count', 'train_rows', 'test_rows', 'seed']),
                     unnest([n_train + n_test, n_train, n_test, 42]) FROM n
    UNION ALL SELECT 'preparation', unnest(['n_chars', 'n_words', 'n_lines', 'n_digits', 'n_stops']), unnest(range(0, 5))
    UNION ALL SELECT 'models', 'logistic_regression', n_train FROM n
    UNION ALL SELECT 'comparison', 'logistic_regression', n_test FROM n
    UNION ALL SELECT 'confusion', 'logistic_regression', n_test FROM n
    UNION ALL SELECT 'ranking', 'roc_auc:logistic_regression', 0
"""


def score_stream_model(spark, sf_dir):
    """A model on a stream that is stopped half way and started again.

    Each held-out row once, whether its score is that of the batch, and whether the running
    confusion cells end at those of the batch.
    """
    experiment = _train(spark, sf_dir, "logistic_regression")
    model, held_out = experiment.models[0], experiment.test.drop("partition")
    source, sink, cells = (shared_folder(spark, n) for n in ("stream-in", "stream-out", "stream-cells"))
    batch = stored(model.predict(experiment.test).select(
        F.col("doc_id").alias("id"), vector_to_array("probability")[1].alias("expected"),
        F.col("predicted").alias("expected_class"), F.col("quality").alias("truth")), "batch-scores")
    schema = held_out.withColumn("partition", F.lit("")).schema
    table_name = f"cells_{source.rsplit('-', 1)[-1]}"
    for part in (F.col("doc_id") % 2 == 0, F.col("doc_id") % 2 == 1):
        # Files of the second part arrive while no query runs; both queries are started anew.
        held_out.where(part).withColumn("partition", F.lit("test")).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 3).parquet(source)
        scored = score_stream(model.pipeline, stream)
        write_scores(scored, sink, f"{sink}-checkpoint").awaitTermination()
        (running_confusion(scored, "quality").writeStream.outputMode("complete").foreachBatch(
            lambda rows, _: rows.write.mode("overwrite").parquet(cells))
         .option("checkpointLocation", f"{cells}-checkpoint").queryName(table_name)
         .trigger(availableNow=True).start().awaitTermination())
    experiment.release()
    totals = batch.agg(*[
        F.count_if((F.col("truth") == t) & (F.col("expected_class") == p)).alias(n)
        for n, t, p in (("tp", 1, 1), ("fp", 0, 1), ("tn", 0, 0), ("fn", 1, 0))])
    same_cells = spark.read.parquet(cells).join(totals, (F.col("true_positives") == F.col("tp")) & (
        F.col("false_positives") == F.col("fp")) & (F.col("true_negatives") == F.col("tn"))
        & (F.col("false_negatives") == F.col("fn"))).count() == 1
    found = read_scores(spark, sink).select("doc_id", vector_to_array("probability")[1].alias("score"))
    return found.join(batch, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", (F.col("score") == F.col("expected")).alias("same_score"), F.lit(same_cells).alias("same_cells"))


STREAM_MODEL_SQL = f"""
    SELECT doc_id, TRUE AS same_score, TRUE AS same_cells FROM ({LABELLED_SPLIT_SQL}) WHERE partition = 'test'
"""

QUERIES = {
    "evaluation_parts": evaluation_parts,
    "score_stream_model": score_stream_model,
    "train_logistic_regression": _held_out_scores("logistic_regression"),
    "train_random_forest": _held_out_scores("random_forest"),
    "train_gradient_boosted_trees": _held_out_scores("gradient_boosted_trees"),
    "optimum_gradient": optimum_gradient,
    "evaluate_logistic_regression": evaluate_logistic_regression,
    "experiment_metadata": experiment_metadata,
    "baseline_comparison": baseline_comparison,
    "saved_model": saved_model,
}

ORACLES = {
    "evaluation_parts": EVALUATION_SQL,
    "score_stream_model": STREAM_MODEL_SQL,
    "train_logistic_regression": HELD_OUT_SQL,
    "train_random_forest": HELD_OUT_SQL,
    "train_gradient_boosted_trees": HELD_OUT_SQL,
    "optimum_gradient": GRADIENT_SQL,
    "evaluate_logistic_regression": EVALUATE_SQL,
    "experiment_metadata": METADATA_SQL,
    "baseline_comparison": COMPARISON_SQL,
    "saved_model": SAVED_SQL,
}
