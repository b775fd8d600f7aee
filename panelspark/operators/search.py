"""Hyper-parameter search: a table of trials, and their evaluation by cross-validation."""

from __future__ import annotations

import datetime as dt
import math
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.config import ModelConfig, ProcessingConfig
from panelspark.functions.hashing import row_uniform
from panelspark.operators import metrics, sampling, synthetic
from panelspark.operators.classifiers import fit_classifier, without_effect
from panelspark.operators.preprocess import PanelPreprocessor
from panelspark.operators.ranking import key_text
from panelspark.operators.registry import RUNS_SCHEMA

# -- distributions ------------------------------------------------------------------------------


class Draw:
    """Random columns of a trial table. Every named draw has its own stream per trial."""

    def __init__(self, seed: int):
        self.seed = seed

    def unit(self, name: str) -> Column:
        return row_uniform(["trial"], f"{self.seed}/{name}")

    def uniform(self, name: str, low: float, high: float) -> Column:
        return F.lit(low) + self.unit(name) * F.lit(high - low)

    def integer(self, name: str, low: float, high: float) -> Column:
        """A uniform draw cut to a whole number."""
        return F.floor(self.uniform(name, low, high))

    def log_uniform(self, name: str, low: float, high: float) -> Column:
        return F.exp(self.uniform(name, math.log(low), math.log(high)))

    def stepped(self, name: str, low: float, high: float, step: float) -> Column:
        return F.round(self.uniform(name, low, high) / step) * F.lit(step)

    def rounded_log_uniform(self, name: str, low: float, high: float) -> Column:
        return F.round(self.log_uniform(name, low, high))

    def rounded_log_normal(self, name: str, mean: float, deviation: float) -> Column:
        radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - self.unit(name)))
        normal = radius * F.cos(F.lit(2.0 * math.pi) * self.unit(name + "_angle"))
        return F.round(F.exp(F.lit(mean) + F.lit(deviation) * normal))

    def choice(self, name: str, options: Sequence, weights: Sequence[float] | None = None) -> Column:
        """One of the options; an option may itself be a column."""
        weights = weights or [1.0 / len(options)] * len(options)
        u, upto, expr = self.unit(name), 0.0, None
        for option, weight in zip(options, weights):
            upto += weight
            value = option if isinstance(option, Column) else F.lit(option)
            value = value.cast("string")
            expr = F.when(u < upto, value) if expr is None else expr.when(u < upto, value)
        last = options[-1]
        return expr.otherwise((last if isinstance(last, Column) else F.lit(last)).cast("string"))


# The search space of every model and sampler.
def model_space(d: Draw) -> dict[str, dict[str, Column]]:
    def boosted(prefix: str) -> dict[str, Column]:
        return {
            "max_depth": d.integer(f"{prefix}_max_depth", 1, 11),
            "learning_rate": d.log_uniform(f"{prefix}_learning_rate", 0.0001, 0.5) - 0.0001,
            "n_estimators": d.stepped(f"{prefix}_n_estimators", 100, 2000, 200),
            "subsample": d.uniform(f"{prefix}_subsample", 0.5, 1),
            "colsample_bytree": d.uniform(f"{prefix}_colsample_bytree", 0.5, 1),
            "reg_alpha": d.log_uniform(f"{prefix}_reg_alpha", 0.0001, 1) - 0.0001,
            "reg_lambda": d.log_uniform(f"{prefix}_reg_lambda", 1, 4),
        }

    return {
        "KNeighborsClassifier": {"n_neighbors": d.integer("n_neighbors", 1, 15)},
        "GaussianNB": {},
        "DecisionTreeClassifier": {
            "criterion": d.choice("dtree_criterion", ["gini", "entropy"]),
            "max_depth": d.rounded_log_normal("dtree_max_depth", 3, 1),
            "max_features": d.choice("dtree_max_features", ["sqrt", "log2"]),
            "min_samples_split": d.choice("dtree_min_samples_split", [2, 5, 10, 50, 100, 300, 500, 1000]),
        },
        "LogisticRegression": {
            "C": d.uniform("logreg_C", 0.1, 2),
            "solver": d.choice("logreg_solver", ["liblinear", "lbfgs"]),
            "class_weight": d.choice("logreg_class_weight", ["balanced", None]),
        },
        "RandomForestClassifier": {
            "criterion": d.choice("rf_criterion", ["gini", "entropy"]),
            "class_weight": d.choice("rf_class_weight", ["balanced", "balanced_subsample", None]),
            "n_estimators": d.rounded_log_uniform("rf_n_estimators", 9.5, 1200.5),
            "max_depth": d.choice("rf_max_depth", [None, 2, 3, 4], [0.7, 0.1, 0.1, 0.1]),
            "min_samples_split": d.choice("rf_min_samples_split", [2, 3], [0.95, 0.05]),
            "min_samples_leaf": d.choice(
                "rf_min_samples_leaf", [1, d.rounded_log_uniform("rf_min_samples_leaf_gt1", 1.5, 50.5).cast("int")]),
            "max_features": d.choice(
                "rf_max_features", ["sqrt", "log2", None, d.uniform("rf_max_features_frac", 0.0, 1.0)],
                [0.2, 0.1, 0.1, 0.6]),
        },
        "XGBClassifier": boosted("xgb") | {
            "gamma": d.log_uniform("xgb_gamma", 0.0001, 5) - 0.0001,
            "min_child_weight": d.log_uniform("xgb_min_child_weight", 1, 100),
            "colsample_bylevel": d.uniform("xgb_colsample_bylevel", 0.5, 1),
        },
        "LGBMClassifier": boosted("lgbm") | {
            "num_leaves": d.integer("lgbm_num_leaves", 2, 121),
            "min_child_weight": F.floor(d.log_uniform("lgbm_min_child_weight", 1, 100)),
            "boosting_type": d.choice("lgbm_boosting_type", ["gbdt", "dart", "goss"]),
        },
        "MLPClassifier": {
            "activation": d.choice("mlp_activation", ["identity", "logistic", "tanh", "relu"], [0.2, 0.2, 0.2, 0.4]),
            "solver": d.choice("mlp_solver", ["lbfgs", "sgd", "adam"], [0.2, 0.2, 0.6]),
            "alpha": d.uniform("mlp_alpha", 1e-4, 0.01),
            "learning_rate": d.choice("mlp_learning_rate", ["constant", "invscaling", "adaptive"]),
            "power_t": d.uniform("mlp_power_t", 0.1, 0.9),
            "max_iter": d.integer("mlp_max_iter", 150, 350),
            "tol": d.uniform("mlp_tol", 1e-4, 0.01),
            "momentum": d.uniform("mlp_momentum", 0.8, 1.0),
        },
    }


# The samplers' neighbour counts.
def sampler_space(d: Draw) -> dict[str, dict[str, Column]]:
    return {
        "SMOTE": {"k_neighbors": d.stepped("smote_k_neighbors", 1, 10, 1)},
        "BorderlineSMOTE": {
            "k_neighbors": d.stepped("borderline_smote_k_neighbors", 1, 10, 1),
            "m_neighbors": d.stepped("borderline_smote_m_neighbors", 1, 10, 1),
        },
        "ADASYN": {"n_neighbors": d.stepped("adasyn_n_neighbors", 1, 10, 1)},
    }


def _params(space: dict[str, dict[str, Column]], chosen: Column) -> Column:
    """The settings of the chosen entry as a text map; a setting of None is left out."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    expr = empty
    for name, settings in space.items():
        if settings:
            pairs = [x for key, value in settings.items() for x in (F.lit(key), value.cast("string"))]
            known = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
            expr = F.when(chosen == name, known).otherwise(expr)
    return expr


def trial_table(spark: SparkSession, n: int, model: ModelConfig = ModelConfig(), seed: int | None = None) -> DataFrame:
    """(trial, classifier, params, sampler, sampler_params), one row per trial.

    The same trial number always draws the same settings, however many trials there are. Without
    resampling the last two columns are NULL.
    """
    d = Draw(model.random_state if seed is None else seed)
    space = {m: s for m, s in model_space(d).items() if m in model.models_to_try}
    samplers = {m: s for m, s in sampler_space(d).items() if m in model.samplers_to_try}
    table = spark.range(n).withColumnRenamed("id", "trial")
    table = table.withColumn("classifier", d.choice("classifiers", list(space)))
    table = table.withColumn("params", _params(space, F.col("classifier")))
    if model.use_resampling:
        table = table.withColumn("sampler", d.choice("samplers", list(samplers)))
        table = table.withColumn("sampler_params", _params(samplers, F.col("sampler")))
    else:
        table = table.withColumn("sampler", F.lit(None).cast("string"))
        table = table.withColumn("sampler_params", F.lit(None).cast("map<string,string>"))
    return table.select("trial", "classifier", "params", "sampler", "sampler_params")


def most_neighbours(trials: DataFrame) -> int:
    """The largest number of neighbours that a sampler of the trials asks for; 0 without samplers."""
    asked = trials.select(F.explode(F.map_values("sampler_params")).alias("n"))
    return int(asked.agg(F.coalesce(F.max(F.col("n").cast("double")), F.lit(0.0))).first()[0])


def parse_params(params: dict | None) -> dict:
    """Text settings as numbers where they are numbers."""
    parsed = {}
    for name, text in (params or {}).items():
        try:
            number = float(text)
            parsed[name] = int(number) if number.is_integer() else number
        except ValueError:
            parsed[name] = text
    return parsed


# -- evaluation ---------------------------------------------------------------------------------

LABEL, KEY, VECTOR, FEATURES = "label", synthetic.KEY, "_vec", "features"


@dataclass
class Fold:
    number: int
    train: DataFrame
    valid: DataFrame
    near: synthetic.Neighbourhoods | None = None


def model_rows(df: DataFrame, preprocessor, keys: Sequence[str], label_col: str) -> DataFrame:
    """(row_key, label, _vec): what samplers and classifiers work on."""
    return preprocessor.with_array(df, VECTOR).select(
        key_text(keys).alias(KEY), F.col(label_col).cast("int").alias(LABEL), VECTOR)


def with_features(df: DataFrame) -> DataFrame:
    return df.withColumn(FEATURES, array_to_vector(VECTOR))


def prepare_folds(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                  model: ModelConfig = ModelConfig(), neighbours: int = 0) -> list[Fold]:
    """Stratified folds, each with a preprocessor fitted on its own training part.

    This does not depend on a trial's settings, so it is done once and kept for all trials; so are the neighbour
    tables of the training parts, with as many ``neighbours`` as a sampler may ask for (0: none).
    """
    labelled = df.filter(F.col(model.outcome_col).isNotNull())
    folded = sampling.stratified_folds(labelled, model.outcome_col, model.key, model.n_folds, model.random_state)
    folds = []
    for i in range(model.n_folds):
        train, valid = folded.filter(F.col("fold") != i), folded.filter(F.col("fold") == i)
        fitted = PanelPreprocessor(numeric=list(numeric), categorical=list(categorical)).fit(train)
        rows = [model_rows(part, fitted, model.key, model.outcome_col).persist() for part in (train, valid)]
        near = synthetic.neighbourhoods(rows[0], LABEL, VECTOR, neighbours) if neighbours else None
        folds.append(Fold(i, *rows, near))
    return folds


def release(kept: Sequence[DataFrame]) -> None:
    for df in kept:
        df.unpersist()


def resampled(train: DataFrame, sampler: str | None, sampler_params: dict | None,
              settings: ProcessingConfig = ProcessingConfig(), seed: int = 42,
              near: synthetic.Neighbourhoods | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """Training rows after over- and then undersampling, and what was kept in memory for it.

    Without a sampler the rows are unchanged. The caller unpersists what was kept.
    """
    if sampler is None:
        return train, []
    more = synthetic.oversample(
        train, sampler, sampler_params or {}, LABEL, VECTOR, settings.over_sampling_ratio, seed, near).persist()
    return sampling.under_sample(more, LABEL, [KEY], settings.under_sampling_ratio, seed), [more]


def fit_resampled(train: DataFrame, classifier: str, params: dict, sampler: str | None, sampler_params: dict | None,
                  settings: ProcessingConfig = ProcessingConfig(), seed: int = 42,
                  near: synthetic.Neighbourhoods | None = None):
    """Resample the training rows, then train on them."""
    ready, kept = resampled(train, sampler, sampler_params, settings, seed, near)
    fitted = fit_classifier(with_features(ready), classifier, params, LABEL, FEATURES, KEY, seed)
    if classifier != "KNeighborsClassifier":  # there the rows are the model
        release(kept)
    return fitted


def evaluate_trial(folds: list[Fold], classifier: str, params: dict, sampler: str | None = None,
                   sampler_params: dict | None = None, settings: ProcessingConfig = ProcessingConfig(),
                   seed: int = 42) -> dict[str, float]:
    """The median over folds of each metric; all folds are measured in one plan."""
    parts = []
    for fold in folds:
        fitted = fit_resampled(fold.train, classifier, params, sampler, sampler_params, settings, seed, fold.near)
        scored = fitted.score(with_features(fold.valid))
        parts.append(scored.select(F.lit(fold.number).alias("fold"), LABEL, "p"))
    measured = metrics.evaluate(reduce(DataFrame.unionByName, parts), LABEL, "p", by=["fold"])
    return metrics.median_over_folds(measured).first().asDict()


def run_search(spark: SparkSession, folds: list[Fold], trials: DataFrame, experiment_id: str,
               settings: ProcessingConfig = ProcessingConfig(), model: ModelConfig = ModelConfig(),
               evaluate: Callable[..., dict] = evaluate_trial) -> DataFrame:
    """Evaluate every trial, several at a time, and return their runs with that of the search.

    A failing trial gets an infinite loss and the tag FAIL; the others go on.
    """
    parent = uuid.uuid4().hex
    started = dt.datetime.now()

    @inheritable_thread_target(spark)
    def one(trial) -> tuple:
        begun = dt.datetime.now()
        params = {"classifier": trial["classifier"], **{f"model.{k}": v for k, v in trial["params"].items()}}
        if trial["sampler"]:
            params |= {"sampler": trial["sampler"], **{f"sampler.{k}": v for k, v in trial["sampler_params"].items()}}
        tags = {"classifier_type": trial["classifier"], "use_resampling_in_train_pipeline": str(bool(trial["sampler"])),
                "random_state": str(model.random_state)}
        if ignored := without_effect(trial["classifier"], trial["params"] or {}):
            tags["settings_without_effect"] = ",".join(ignored)
        try:
            found = evaluate(folds, trial["classifier"], parse_params(trial["params"]), trial["sampler"],
                             parse_params(trial["sampler_params"]), settings, model.random_state)
            status, tags["status"] = "FINISHED", "OK"
        except Exception as error:  # noqa: BLE001 - a trial may fail in any library it calls
            found, status = {"loss": math.inf}, "FAILED"
            tags |= {"status": "FAIL", "error": str(error) or type(error).__name__}
        return (uuid.uuid4().hex, experiment_id, parent, status, begun, tags, params,
                {k: float(v) for k, v in found.items() if v is not None})

    with ThreadPool(model.parallelism) as pool:
        runs = pool.map(one, trials.collect(), chunksize=1)
    resampling = any(run[5]["use_resampling_in_train_pipeline"] == "True" for run in runs)
    tags = {"use_resampling_in_train_pipeline": str(resampling), "random_state": str(model.random_state)}
    runs.append((parent, experiment_id, None, "FINISHED", started, tags, {}, {}))
    return spark.createDataFrame(runs, RUNS_SCHEMA)
