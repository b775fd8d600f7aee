"""Classifiers by name on ``pyspark.ml``, with settings under their search names.

Boosted trees stand for both boosters. Settings without a counterpart in ``pyspark.ml`` are left
out: column sampling per level, L1 / L2 terms of boosted trees, leaf-wise growth and its leaf
count, dropout boosting, momentum and learning-rate schedules.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators.neighbors import nearest, vote
from panelspark.operators.sampling import class_counts

MAX_TREE_DEPTH = 30
HIDDEN_UNITS = 100
WEIGHT_COL = "_weight"

# classifiers whose linear score, not their probability, is what gets calibrated
SCORES_BY_MARGIN = ("LogisticRegression",)


def _depth(params: Mapping, default: int) -> int:
    value = params.get("max_depth")
    return max(1, min(MAX_TREE_DEPTH, int(value) if value is not None else default))


def _feature_subset(value) -> str:
    if value is None:
        return "all"
    if value in ("sqrt", "log2"):
        return value
    share = float(value)
    return str(min(1.0, max(share, 1e-9)))


def _weighted(params: Mapping) -> dict:
    return {"weightCol": WEIGHT_COL} if params.get("class_weight") in ("balanced", "balanced_subsample") else {}


def _gaussian_nb(params, n, d, seed):
    return NaiveBayes(modelType="gaussian")


def _decision_tree(params, n, d, seed):
    settings = {
        "impurity": params.get("criterion", "gini"),
        "maxDepth": _depth(params, MAX_TREE_DEPTH),
        "minInstancesPerNode": max(1, int(params.get("min_samples_split", 2)) // 2),
        "seed": seed,
    }
    if params.get("max_features") is None:
        return DecisionTreeClassifier(**settings)
    # a forest of one tree on all rows is a tree that looks at some features per split
    subset = _feature_subset(params["max_features"])
    return RandomForestClassifier(numTrees=1, bootstrap=False, featureSubsetStrategy=subset, **settings)


def _logistic(params, n, d, seed):
    strength = 1.0 / (float(params.get("C", 1.0)) * max(1, n))
    return LogisticRegression(regParam=strength, standardization=False, maxIter=100, **_weighted(params))


def _random_forest(params, n, d, seed):
    leaf = max(int(params.get("min_samples_leaf", 1)), int(params.get("min_samples_split", 2)) // 2)
    return RandomForestClassifier(
        impurity=params.get("criterion", "gini"), numTrees=int(params.get("n_estimators", 100)),
        maxDepth=_depth(params, MAX_TREE_DEPTH), minInstancesPerNode=max(1, leaf),
        featureSubsetStrategy=_feature_subset(params.get("max_features", "sqrt")), seed=seed, **_weighted(params),
    )


def _boosted_trees(params, n, d, seed):
    return GBTClassifier(
        maxDepth=_depth(params, 6), maxIter=int(params.get("n_estimators", 100)),
        stepSize=min(1.0, max(float(params.get("learning_rate", 0.1)), 1e-6)),
        minInfoGain=max(0.0, float(params.get("gamma", 0.0))),
        minInstancesPerNode=max(1, round(float(params.get("min_child_weight", 1)))),
        subsamplingRate=float(params.get("subsample", 1.0)),
        featureSubsetStrategy=_feature_subset(params.get("colsample_bytree")), seed=seed,
    )


def _perceptron(params, n, d, seed):
    return MultilayerPerceptronClassifier(
        layers=[d, HIDDEN_UNITS, 2], maxIter=int(params.get("max_iter", 200)), tol=float(params.get("tol", 1e-4)),
        solver="gd" if params.get("solver") == "sgd" else "l-bfgs", seed=seed,
    )


BUILDERS = {
    "GaussianNB": _gaussian_nb,
    "DecisionTreeClassifier": _decision_tree,
    "LogisticRegression": _logistic,
    "RandomForestClassifier": _random_forest,
    "XGBClassifier": _boosted_trees,
    "LGBMClassifier": _boosted_trees,
    "MLPClassifier": _perceptron,
}
MODEL_NAMES = (*BUILDERS, "KNeighborsClassifier")

_BOOSTED = ("max_depth", "n_estimators", "learning_rate", "gamma", "subsample", "colsample_bytree", "min_child_weight")
# the settings that a builder looks at
EFFECTIVE = {
    "GaussianNB": (),
    "DecisionTreeClassifier": ("criterion", "max_depth", "max_features", "min_samples_split"),
    "LogisticRegression": ("C", "class_weight"),
    "RandomForestClassifier": (
        "criterion", "class_weight", "n_estimators", "max_depth", "min_samples_split", "min_samples_leaf", "max_features"),
    "XGBClassifier": _BOOSTED,
    "LGBMClassifier": _BOOSTED,
    "MLPClassifier": ("solver", "max_iter", "tol"),
    "KNeighborsClassifier": ("n_neighbors",),
}


def without_effect(name: str, params: Mapping) -> list[str]:
    """Settings that were drawn but have no counterpart here; two trials that differ in these alone are one model."""
    return sorted(set(params) - set(EFFECTIVE.get(name, params)))


@dataclass
class FittedClassifier:
    """A trained model that adds ``p``, the probability of class 1, and ``score`` to rows."""

    name: str
    model: object

    def score(self, df: DataFrame, features_col: str = "features") -> DataFrame:
        out = self.model.transform(df)
        p = vector_to_array("probability")[1]
        margin = vector_to_array("rawPrediction")[1] if self.name in SCORES_BY_MARGIN else p
        added = {"p": p, "score": margin}
        return out.withColumns(added).drop("probability", "rawPrediction", "prediction")


@dataclass
class NeighbourVote:
    """k nearest neighbours: the training rows are the model."""

    train: DataFrame
    key: str
    label_col: str
    k: int
    name: str = "KNeighborsClassifier"

    def score(self, df: DataFrame, features_col: str = "features") -> DataFrame:
        def vectors(rows: DataFrame, *more: str) -> DataFrame:
            return rows.select(F.col(self.key), vector_to_array(features_col).alias("_vec"), *more)

        known = vectors(self.train, self.label_col)
        near = nearest(vectors(df), known, self.k, self.key, "_vec", exclude_self=False)
        share = vote(near, known, self.key, self.label_col, self.k).withColumnRenamed("query_id", "_query")
        scored = df.join(share, F.col(self.key).cast("string") == F.col("_query")).drop("_query")
        return scored.withColumn("score", F.col("p"))


def with_balanced_weights(df: DataFrame, label_col: str) -> DataFrame:
    """Weights n / (2 · rows of the class), so both classes weigh the same."""
    counts = class_counts(df, label_col)
    total = sum(counts.values())
    weight = F.lit(1.0)
    for label, n in counts.items():
        weight = F.when(F.col(label_col) == F.lit(label), F.lit(total / (len(counts) * n))).otherwise(weight)
    return df.withColumn(WEIGHT_COL, weight)


def fit_classifier(df: DataFrame, name: str, params: Mapping | None = None, label_col: str = "label",
                   features_col: str = "features", key: str = "row_key", seed: int = 42):
    """Train a classifier by name on rows with a vector column and a 0/1 label."""
    params = dict(params or {})
    if name == "KNeighborsClassifier":
        return NeighbourVote(df, key, label_col, int(params.get("n_neighbors", 5)))
    if name not in BUILDERS:
        raise ValueError(f"model must be one of {sorted(MODEL_NAMES)}, not {name!r}")
    size = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector_to_array(features_col))).alias("d")).first()
    estimator = BUILDERS[name](params, size["n"], size["d"], seed)
    estimator.setFeaturesCol(features_col).setLabelCol(label_col)
    if estimator.hasParam("weightCol") and estimator.isSet("weightCol"):
        df = with_balanced_weights(df, label_col)
    return FittedClassifier(name, estimator.fit(df))
