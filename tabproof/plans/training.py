"""Training baselines on one shared split, scoring them and keeping the results."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabproof import __version__
from tabproof.contract import TableContract
from tabproof.errors import ArtifactError, EvaluationError, PreparationError
from tabproof.functions.columns import json_text, quoted
from tabproof.operators.compare import comparison_json, comparison_table, confusion_table
from tabproof.operators.metrics import DECISION_THRESHOLD, binary_metrics, hard_predictions
from tabproof.operators.prepare import build_training, describe_preparation
from tabproof.operators.profile import class_distribution
from tabproof.operators.split import (
    DEFAULT_SEED, DEFAULT_TEST_SIZE, TEST, TRAIN, SplitPlan, assign_partition, plan_split,
)
from tabproof.plans.models import ModelSpec, get_spec, model_names
from tabproof.plans.quality import require_valid
from tabproof.sources.shared import stored, use_checkpoint_dir


@dataclass(frozen=True)
class TrainedModel:
    """A fitted pipeline, from raw features to probabilities, and how it came about."""

    name: str
    pipeline: PipelineModel = field(repr=False)
    spec: ModelSpec
    metadata: dict = field(repr=False)

    def predict_proba(self, df: DataFrame) -> DataFrame:
        """Add a two-entry ``probability`` vector; works on batches and streams."""
        return self.pipeline.transform(df).drop("features", "rawPrediction", "prediction")

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``predicted`` at the recorded threshold."""
        return hard_predictions(
            self.predict_proba(df), "probability", self.metadata["decision_threshold"])


@dataclass
class Experiment:
    """Models trained on the same rows. The features stay cached until ``release``."""

    models: list[TrainedModel]
    split: DataFrame = field(repr=False)
    plan: SplitPlan
    cached: DataFrame = field(repr=False)

    @property
    def train(self) -> DataFrame:
        return self.split.where(F.col("partition") == TRAIN)

    @property
    def test(self) -> DataFrame:
        return self.split.where(F.col("partition") == TEST)

    def release(self) -> None:
        self.cached.unpersist()


def _fit(train, contract, spec, plan, row_id, threshold, source, digest) -> TrainedModel:
    estimator = spec.estimator(plan.train_rows)
    estimator.setLabelCol(contract.target.name)
    kept = [*row_id, "partition"]
    pipeline = build_training(
        contract, estimator, scaling=spec.scaling, passthrough=kept).fit(train)
    fitted = describe_preparation(train.sparkSession, pipeline)
    # The names of the record's entries.
    metadata = {
        "model_name": spec.name,
        "dataset_path": source or "<in-memory DataFrame>",
        "dataset_sha256": digest,
        "row_count": plan.rows,
        "feature_names": contract.feature_names,
        "target": contract.target.name,
        "random_state": plan.seed,
        "test_size": plan.realised_test_size,
        "decision_threshold": threshold,
        "preprocessing": [row.asDict() for row in fitted.orderBy("position").collect()],
        "model_configuration": spec.record(),
        "created_at": datetime.now(timezone.utc).isoformat(timespec="seconds"),
        "project_version": __version__,
        "train_size": plan.train_rows,
        "test_size_rows": plan.test_rows,
    }
    return TrainedModel(spec.name, pipeline, spec, metadata)


def train_models(
    df: DataFrame, contract: TableContract, row_id, names=None,
    test_size: float = DEFAULT_TEST_SIZE, seed: int = DEFAULT_SEED,
    threshold: float = DECISION_THRESHOLD, source: str | None = None, digest: str = "",
) -> Experiment:
    """Check the table, split it once and fit every named baseline on the training rows.

    ``names`` are baseline names or specs of one's own.
    """
    row_id = [row_id] if isinstance(row_id, str) else list(row_id)
    chosen = names if names is not None else model_names()
    specs = [n if isinstance(n, ModelSpec) else get_spec(n, seed) for n in chosen]
    use_checkpoint_dir(df.sparkSession)
    ids = [name for name in row_id if name not in contract.required_names]
    present = [name for name in contract.required_names if name in df.columns]
    # Only what training needs is cached, once, for the check, the split and every fit.
    needed = df.select(*[quoted(c) for c in (*ids, *present)]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        require_valid(needed.drop(*ids), contract, source)
        plan = plan_split(needed, contract.target.name, row_id, test_size, seed)
        split = assign_partition(needed, plan)
        train = split.where(F.col("partition") == TRAIN)
        models = [
            _fit(train, contract, spec, plan, row_id, threshold, source, digest) for spec in specs
        ]
    except BaseException:
        needed.unpersist()
        raise
    return Experiment(models, split, plan, needed)


def train_model(df, contract, row_id, name, **options) -> Experiment:
    """One baseline; see :func:`train_models`."""
    return train_models(df, contract, row_id, names=[name], **options)


def metadata_frame(spark: SparkSession, models: list[TrainedModel]) -> DataFrame:
    """One row per model with its reproducibility record as JSON columns where nested."""
    keys = list(models[0].metadata)
    rows = [
        tuple(v if isinstance(v, (int, float, str)) else json.dumps(v) for v in m.metadata.values())
        for m in models
    ]
    kinds = {"row_count": "bigint", "random_state": "bigint", "train_size": "bigint",
             "test_size_rows": "bigint", "test_size": "double", "decision_threshold": "double"}
    return spark.createDataFrame(rows, ", ".join(f"{k} {kinds.get(k, 'string')}" for k in keys))


def score_models(models: list[TrainedModel], df: DataFrame) -> DataFrame:
    """Long table (ordinal, model, label, score): the scores of all models, stacked."""
    if not models:
        raise EvaluationError("there is no model to score")
    return reduce(DataFrame.unionByName, [
        m.predict_proba(df).select(
            F.lit(i).alias("ordinal"), F.lit(m.name).alias("model"),
            quoted(m.metadata["target"]).alias("label"), "probability",
        )
        for i, m in enumerate(models)
    ])


def evaluate_models(models: list[TrainedModel], df: DataFrame) -> DataFrame:
    """Metrics of every model on held-out rows, each at its recorded threshold.

    All models go through one plan, grouped by model. The scores are written to the shared
    folder once and read back: a cache would keep its lineage, so that every task of every
    later job unpacks all the models again, and a forest grows with its training rows. The
    result, a row per model, is small and returned materialised.
    """
    spark = df.sparkSession
    parts = []
    for threshold in sorted({m.metadata["decision_threshold"] for m in models}):
        same = [m for m in models if m.metadata["decision_threshold"] == threshold]
        order = [models.index(m) for m in same]
        scored = stored(score_models(same, df), "model-scores")
        metrics = binary_metrics(scored, "label", "probability", threshold, ["ordinal", "model"])
        ranks = F.array(*[F.lit(i) for i in order])
        metrics = metrics.withColumn("ordinal", F.element_at(ranks, F.col("ordinal") + 1))
        parts.append(spark.createDataFrame(metrics.collect(), metrics.schema))
    if not parts:
        raise EvaluationError("there is no model to evaluate")
    sizes = F.array(*[F.lit(m.metadata["train_size"]) for m in models])
    return reduce(DataFrame.unionByName, parts).withColumn(
        "n_train", F.element_at(sizes, F.col("ordinal") + 1)).withColumn("n_test", F.col("n_samples"))


def save_model(model: TrainedModel, path: str) -> None:
    """Write the pipeline, and beside it the metadata as readable JSON."""
    spark = SparkSession.active()
    try:
        model.pipeline.write().overwrite().save(f"{path}/pipeline")
        text = json.dumps(model.metadata, sort_keys=True)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{path}/metadata")
    except (PySparkException, Py4JJavaError) as error:
        raise ArtifactError(f"cannot write a model to {path}: {error}") from error


def load_model(path: str) -> PipelineModel:
    """Read a saved pipeline back."""
    try:
        return PipelineModel.load(f"{path}/pipeline")
    except Exception as error:  # readers raise Spark, JVM and JSON errors alike
        raise ArtifactError(f"no readable model at {path}: {error}") from error


def load_metadata(spark: SparkSession, path: str) -> dict:
    """Read the metadata of a saved model without loading the model."""
    try:
        lines = spark.read.text(f"{path}/metadata", wholetext=True).limit(1).collect()
        return json.loads(lines[0]["value"])
    except (PySparkException, IndexError, json.JSONDecodeError) as error:
        raise ArtifactError(f"no readable model metadata at {path}: {error}") from error


def save_preparation(model: PipelineModel, path: str) -> None:
    """Write a fitted preparation; anything unfitted is refused."""
    describe_preparation(SparkSession.active(), model)
    model.write().overwrite().save(path)


def load_preparation(path: str) -> PipelineModel:
    try:
        return PipelineModel.load(path)
    except Exception as error:  # readers raise Spark, JVM and JSON errors alike
        raise PreparationError(f"no saved preparation at {path}: {error}") from error


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write a table as JSON lines with nulls kept."""
    text = df.select(json_text(*[quoted(c) for c in df.columns]).alias("value"))
    text.write.mode(mode).text(path)


def write_preparation_json(model: PipelineModel, path: str, mode: str = "error") -> None:
    """Write what a preparation has fitted."""
    write_json(describe_preparation(SparkSession.active(), model), path, mode)


def write_evaluation(
    experiment: Experiment, comparison: DataFrame, path: str, mode: str = "error"
) -> None:
    """Write the content of an evaluation report: data, split, models and results."""
    spark, plan = comparison.sparkSession, experiment.plan
    split = spark.createDataFrame(
        [(plan.rows, plan.train_rows, plan.test_rows, plan.realised_test_size, plan.seed)],
        "row_count bigint, train_rows bigint, test_rows bigint, test_size double, seed bigint")
    preparation = reduce(DataFrame.unionByName, [
        describe_preparation(spark, m.pipeline).withColumn("model", F.lit(m.name))
        for m in experiment.models
    ])
    parts = {
        "class_distribution": class_distribution(experiment.split, plan.target),
        "split": split,
        "preparation": preparation,
        "models": metadata_frame(spark, experiment.models),
        "comparison": comparison_table(comparison),
        "confusion": confusion_table(comparison),
    }
    for name, part in parts.items():
        write_json(part, f"{path}/{name}", mode)
    comparison_json(comparison).write.mode(mode).text(f"{path}/ranking")
