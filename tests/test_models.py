import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabproof.errors import (
    ArtifactError, EvaluationError, InvalidTableError, SplitError, UnknownModelError,
)
from tabproof.operators.compare import compare_models
from tabproof.plans import training
from tabproof.plans.models import BASELINES, ModelSpec, get_spec, model_names
from tabproof.plans.training import (
    evaluate_models, load_metadata, load_model, metadata_frame, save_model, score_models,
    train_model, train_models, write_evaluation,
)


@pytest.fixture(scope="module")
def modelling(spark, contract):
    """300 rows whose outcome leans on age and two measurements; some are not recorded."""
    rng = np.random.default_rng(77)
    rows = []
    for i in range(300):
        age, visits = int(rng.integers(20, 80)), int(rng.poisson(3))
        sugar, fat = rng.uniform(70, 190), rng.uniform(18, 45)
        values = dict(
            Pregnancies=visits, Glucose=sugar, BloodPressure=rng.uniform(50, 100),
            SkinThickness=rng.uniform(10, 50), Insulin=rng.exponential(100), BMI=fat,
            DiabetesPedigreeFunction=rng.uniform(0.1, 1.2), Age=age)
        ill = 0.03 * (sugar - 120) + 0.05 * (age - 45) + 0.04 * (fat - 30) + rng.logistic() > 0.5
        for name, share in (("Glucose", 0.1), ("SkinThickness", 0.25), ("Insulin", 0.3)):
            if rng.random() < share:
                values[name] = 0
        rows.append((i, *[float(values[n]) for n in contract.feature_names], int(ill)))
    names = contract.feature_names
    return spark.createDataFrame(
        rows, "row int, " + ", ".join(f"{c} double" for c in names) + ", Outcome bigint")


@pytest.fixture(scope="module")
def linear(modelling, contract):
    experiment = train_model(
        modelling, contract, "row", "logistic_regression", test_size=.25, source="memory", digest="d")
    yield experiment
    experiment.release()


def small(name, **changes):
    s = BASELINES[name]
    return ModelSpec(s.name, {**s.hyperparameters, **changes}, s.scaling, s.description, s.factory, 42)


def test_registry():
    assert model_names() == ("logistic_regression", "random_forest", "gradient_boosted_trees")
    spec = get_spec("random_forest", seed=7)
    assert spec.seed == 7 and spec.scaling == "none" and BASELINES["random_forest"].seed == 0
    assert spec.hyperparameters["trees"] == 200
    assert get_spec("logistic_regression").scaling == "standard"
    with pytest.raises(TypeError):
        spec.hyperparameters["trees"] = 1
    with pytest.raises(UnknownModelError, match="xgboost"):
        get_spec("xgboost")
    assert json.dumps(spec.record())


def test_probabilities_and_predictions(linear):
    model = linear.models[0]
    rows = model.predict(linear.test).select("probability", "predicted").collect()
    assert len(rows) == 75
    for row in rows:
        assert sum(row["probability"]) == pytest.approx(1)
        assert row["predicted"] == int(row["probability"][1] >= .5)


def test_metadata_is_complete_and_free_of_metrics(spark, linear):
    record = linear.models[0].metadata
    assert (record["train_size"], record["test_size_rows"], record["row_count"]) == (225, 75, 300)
    assert record["test_size"] == .25 and record["random_state"] == 42
    assert (record["dataset_path"], record["dataset_sha256"]) == ("memory", "d")
    assert record["decision_threshold"] == .5 and record["created_at"].endswith("+00:00")
    assert [r["feature"] for r in record["preprocessing"]] == record["feature_names"]
    assert not {"accuracy", "roc_auc", "f1"} & set(record)
    row = metadata_frame(spark, linear.models).first()
    assert row["train_size"] == 225 and json.loads(row["model_configuration"])["scaling"] == "standard"


def test_logistic_regression_reaches_the_penalised_optimum(linear, contract):
    """Newton iterations on the same prepared rows end at the same coefficients."""
    fitted = linear.models[0].pipeline
    prepared = linear.train
    for stage in fitted.stages[:-2]:
        prepared = stage.transform(prepared)
    rows = prepared.select(*contract.feature_names, "Outcome").collect()
    X = np.array([[*r[:-1], 1.0] for r in rows])
    y = np.array([r[-1] for r in rows], dtype=float)
    w, penalty = np.zeros(9), np.diag([1.0] * 8 + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-X @ w))
        w -= np.linalg.solve((X.T * (p * (1 - p))) @ X + penalty, X.T @ (p - y) + penalty @ w)
    model = fitted.stages[-1]
    np.testing.assert_allclose([*model.coefficients, model.intercept], w, atol=1e-4)


def test_held_out_rows_never_reach_the_fit(modelling, contract, linear):
    extreme = modelling.join(
        linear.test.select("row", F.lit(True).alias("held")), "row", "left"
    ).withColumn("BMI", F.when(F.col("held"), 900.0).otherwise(F.col("BMI"))).drop("held")
    again = train_model(extreme, contract, "row", "logistic_regression", test_size=.25)
    a, b = (e.models[0].metadata["preprocessing"] for e in (linear, again))
    again.release()
    assert a == b


def test_all_families_share_one_split_and_compare(spark, modelling, contract, tmp_path):
    specs = [
        small("logistic_regression"), small("random_forest", trees=10, max_depth=8),
        small("gradient_boosted_trees", rounds=5),
    ]
    experiment = train_models(modelling, contract, "row", names=specs, test_size=.25)
    assert [m.name for m in experiment.models] == list(model_names())
    metrics = evaluate_models(experiment.models, experiment.test)
    rows = {r["model"]: r for r in metrics.collect()}
    assert all(r["n_test"] == 75 and r["n_train"] == 225 for r in rows.values())
    assert all(.5 < r["roc_auc"] <= 1 for r in rows.values())
    assert score_models(experiment.models, experiment.test).count() == 225
    scalings = {m.name: m.metadata["preprocessing"][0]["scaling"] for m in experiment.models}
    assert scalings == {"logistic_regression": "standard", "random_forest": "none",
                        "gradient_boosted_trees": "none"}
    comparison = compare_models(metrics)
    assert sorted(r["rank"] for r in comparison.collect()) == [1, 2, 3]

    write_evaluation(experiment, comparison, str(tmp_path / "report"))
    parts = {p: [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "report" / p)).collect()]
             for p in ("class_distribution", "split", "preparation", "models", "comparison", "confusion")}
    assert parts["split"][0]["train_rows"] == 225
    assert len(parts["preparation"]) == 24 and len(parts["models"]) == 3
    assert {"model", "tn", "fp", "fn", "tp"} == set(parts["confusion"][0])
    experiment.release()


def test_fits_are_reproducible(modelling, contract):
    spec = small("random_forest", trees=5, max_depth=4)
    runs = []
    for _ in range(2):
        experiment = train_models(modelling, contract, "row", names=[spec])
        runs.append(sorted(
            (r["row"], *r["probability"])
            for r in experiment.models[0].predict_proba(experiment.test).collect()))
        experiment.release()
    assert runs[0] == runs[1]


def test_metrics_are_counted_without_the_models(linear, monkeypatch):
    """Models are shipped for scoring alone: no plan behind the scores holds one."""
    seen, count = [], training.binary_metrics
    monkeypatch.setattr(training, "binary_metrics", lambda df, *a, **k: seen.append(df) or count(df, *a, **k))
    metrics = evaluate_models(linear.models, linear.test).first()
    assert metrics["n_samples"] == linear.test.count()
    assert [df._jdf.queryExecution().optimizedPlan().toString().count("UDF") for df in seen] == [0]
    assert not any(df.storageLevel.useMemory for df in seen)


def test_thresholds_are_recorded_and_used(modelling, contract):
    experiment = train_model(modelling, contract, "row", "logistic_regression", threshold=.2)
    metrics = evaluate_models(experiment.models, experiment.test).first()
    predicted = experiment.models[0].predict(experiment.test)
    assert metrics["threshold"] == .2
    assert predicted.where("predicted = 1").count() == (
        metrics["true_positives"] + metrics["false_positives"])
    experiment.release()


def test_save_and_load(spark, linear, tmp_path):
    model, path = linear.models[0], str(tmp_path / "deep" / "model")
    save_model(model, path)
    again = load_model(path)
    assert [r["probability"] for r in again.transform(linear.test).orderBy("row").collect()] == [
        r["probability"] for r in model.predict_proba(linear.test).orderBy("row").collect()]
    assert load_metadata(spark, path) == json.loads(json.dumps(model.metadata))


def test_broken_artifacts(spark, tmp_path):
    with pytest.raises(ArtifactError):
        load_model(str(tmp_path / "absent"))
    with pytest.raises(ArtifactError):
        load_metadata(spark, str(tmp_path / "absent"))
    (tmp_path / "m" / "metadata").mkdir(parents=True)
    (tmp_path / "m" / "metadata" / "part.txt").write_text("{not json")
    with pytest.raises(ArtifactError):
        load_metadata(spark, str(tmp_path / "m"))


def test_faulty_tables_are_refused(modelling, contract):
    with pytest.raises(InvalidTableError):
        train_model(modelling.drop("BMI"), contract, "row", "logistic_regression")
    with pytest.raises(InvalidTableError):
        train_model(modelling.withColumn("Outcome", F.lit(3)), contract, "row", "logistic_regression")
    with pytest.raises(SplitError):
        lonely = F.when(F.col("row") == 0, 1).otherwise(0)
        train_model(modelling.withColumn("Outcome", lonely), contract, "row", "logistic_regression")
    with pytest.raises(UnknownModelError):
        train_model(modelling, contract, "row", "nope")
    with pytest.raises(EvaluationError):
        evaluate_models([], modelling)
