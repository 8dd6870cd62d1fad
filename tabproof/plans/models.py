"""The baseline models: what each one is fitted with, stated in one place."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, fields, replace
from types import MappingProxyType
from typing import Any

from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, RandomForestClassifier,
)

from tabproof.errors import UnknownModelError


def _plain(value):
    return dict(value) if isinstance(value, Mapping) else value


@dataclass(frozen=True)
class ModelSpec:
    """A baseline with every parameter that shapes the fit.

    ``factory(parameters, train_rows, seed)`` returns the unfitted estimator.
    """

    name: str
    hyperparameters: Mapping[str, Any]
    scaling: str
    description: str
    factory: Callable = field(repr=False, compare=False)
    seed: int = 0

    def estimator(self, train_rows: int):
        return self.factory(self.hyperparameters, train_rows, self.seed)

    def record(self) -> dict:
        """Everything but the factory, as plain values for the metadata."""
        return {f.name: _plain(getattr(self, f.name)) for f in fields(self) if f.name != "factory"}


def _logistic_regression(p, train_rows, seed):
    # C weighs the summed loss against the penalty; Spark weighs the penalty against
    # the mean loss. The two optima agree at 1 / (C * rows).
    return LogisticRegression(
        regParam=1.0 / (p["C"] * train_rows), elasticNetParam=0.0, standardization=False,
        maxIter=p["max_iter"], tol=p["tol"], family="binomial")


def _random_forest(p, train_rows, seed):
    # Deep trees: remember each row's node instead of walking down from every root.
    return RandomForestClassifier(
        cacheNodeIds=True, maxMemoryInMB=1024, numTrees=p["trees"], maxDepth=p["max_depth"], featureSubsetStrategy=p["feature_subset"],
        minInstancesPerNode=p["min_leaf_rows"], seed=seed)


def _gradient_boosted_trees(p, train_rows, seed):
    return GBTClassifier(
        maxIter=p["rounds"], maxDepth=p["max_depth"], stepSize=p["learning_rate"],
        subsamplingRate=p["row_share"], featureSubsetStrategy=p["feature_subset"],
        minInstancesPerNode=p["min_leaf_rows"], seed=seed)


# The parameters of the three baselines. 30 is the greatest tree depth
# Spark allows, in place of no limit.
_SPECS = (
    ModelSpec(
        "logistic_regression", {"C": 1.0, "max_iter": 1000, "tol": 1e-8}, "standard",
        "linear baseline on standardised features", _logistic_regression),
    ModelSpec(
        "random_forest",
        {"trees": 200, "max_depth": 30, "min_leaf_rows": 1, "feature_subset": "sqrt"}, "none",
        "bagged trees on unscaled features", _random_forest),
    ModelSpec(
        "gradient_boosted_trees",
        {"rounds": 200, "max_depth": 3, "learning_rate": 0.1, "row_share": 1.0,
         "min_leaf_rows": 1, "feature_subset": "all"}, "none",
        "boosted shallow trees on unscaled features", _gradient_boosted_trees),
)
# The registry hands out specs whose parameters cannot be changed in place.
BASELINES = MappingProxyType({
    s.name: replace(s, hyperparameters=MappingProxyType(dict(s.hyperparameters))) for s in _SPECS})


def model_names() -> tuple[str, ...]:
    return tuple(BASELINES)


def get_spec(name: str, seed: int = 0) -> ModelSpec:
    """The registered spec with the given seed."""
    if name not in BASELINES:
        raise UnknownModelError(f"unknown model {name!r}; expected one of {list(BASELINES)}")
    return replace(BASELINES[name], seed=seed)
