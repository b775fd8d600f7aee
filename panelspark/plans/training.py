"""Gold panel to a registered model: search, refit, calibrate, evaluate, promote, score."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.config import ModelConfig, ProcessingConfig
from panelspark.operators import (
    calibration,
    checks,
    classifiers,
    columns,
    curves,
    explain,
    filters,
    metrics,
    registry,
    sampling,
    scoring,
    search,
    tree_shapley,
)
from panelspark.operators.preprocess import PanelPreprocessor
from panelspark.sources import tables
from panelspark.sources.layers import LayerNames

RUNS_TABLE, EVENTS_TABLE = "runs", "model_events"
LEARNING_SHARES = (0.2, 0.4, 0.6, 0.8, 1.0)


def training_rows(gold: DataFrame, model: ModelConfig = ModelConfig()) -> DataFrame:
    """The labelled rows with only the columns a model needs."""
    cols = [*model.key, *model.features, model.outcome_col, model.role_col]
    return filters.labelled(gold.select(*cols), model.outcome_col)


def feature_kinds(df: DataFrame, model: ModelConfig = ModelConfig()) -> tuple[list[str], list[str]]:
    return columns.split_by_kind(df.select(*model.features))


def tune(spark: SparkSession, gold: DataFrame, experiment_id: str, settings: ProcessingConfig = ProcessingConfig(),
         model: ModelConfig = ModelConfig()) -> DataFrame:
    """Runs of a whole search on the train role."""
    rows = training_rows(gold, model)
    numeric, categorical = feature_kinds(rows, model)
    trials = search.trial_table(spark, model.n_iter, model)
    folds = search.prepare_folds(
        filters.role(rows, "train", model.role_col), numeric, categorical, model, search.most_neighbours(trials))
    try:
        return search.run_search(spark, folds, trials, experiment_id, settings, model)
    finally:
        search.release([part for fold in folds for part in (fold.train, fold.valid)])


def choose_run(runs: DataFrame, experiment_id: str, model: ModelConfig = ModelConfig()):
    """The run row to refit: best of the latest search, or best of all."""
    own = runs.filter(F.col("experiment_id") == experiment_id)
    choose = registry.best_of_latest_parent if model.select_from_latest_runs else registry.best_overall
    best = choose(own, model.use_resampling).first()
    if best is None:
        raise RuntimeError(f"no finished run in experiment '{experiment_id}'")
    return registry.get_run(own, best["run_id"]).first()


def settings_of(run) -> tuple[str, dict, str | None, dict]:
    """(classifier, settings, sampler, settings) as a run recorded them."""
    params = run["params"]

    def group(prefix: str) -> dict:
        return search.parse_params({k[len(prefix):]: v for k, v in params.items() if k.startswith(prefix)})

    return params["classifier"], group("model."), params.get("sampler"), group("sampler.")


@dataclass
class Trained:
    model: scoring.PropensityModel
    test_scores: DataFrame
    resampled: DataFrame
    recorded: dict
    kept: list[DataFrame]

    def release(self) -> None:
        """Give the memory back once the scores and training rows are no longer needed."""
        search.release(self.kept)


def train(gold: DataFrame, classifier: str, params: dict, sampler: str | None, sampler_params: dict,
          settings: ProcessingConfig = ProcessingConfig(), model: ModelConfig = ModelConfig()) -> Trained:
    """Refit on all train rows, calibrate on half of the test rows, score the other half.

    Calibration sees the rows as they are: preprocessing stays as fitted and nothing is resampled.
    """
    rows = training_rows(gold, model)
    numeric, categorical = feature_kinds(rows, model)
    train_rows = filters.role(rows, "train", model.role_col)
    test_rows = filters.role(rows, "test", model.role_col)
    fitted = PanelPreprocessor(numeric=numeric, categorical=categorical).fit(train_rows)
    matrix = search.model_rows(train_rows, fitted, model.key, model.outcome_col).persist()
    ready, kept = search.resampled(matrix, sampler, sampler_params, settings, model.random_state)
    trained = classifiers.fit_classifier(
        search.with_features(ready), classifier, params, search.LABEL, search.FEATURES, search.KEY, model.random_state)
    signature = checks.schema_signature(rows, list(model.features))
    calibrator = None
    if model.perform_calibration:
        parts = sampling.stratified_split(test_rows, model.outcome_col, model.key, model.calibration_size, model.random_state)
        held_out = search.model_rows(parts.filter("part = 'calibration'"), fitted, model.key, model.outcome_col)
        scored = trained.score(search.with_features(held_out))
        calibrator = calibration.fit_calibrator(scored, "score", search.LABEL, model.calibration_method)
        test_rows = parts.filter("part = 'test'").drop("part")
    unit = scoring.PropensityModel(fitted, trained, calibrator, signature, tuple(model.key))
    test_scores = unit.score(test_rows, "p").select(*model.key, F.col(model.outcome_col).alias("label"), "p")
    recorded = record_balance(matrix, ready, test_scores, model)
    return Trained(unit, test_scores, ready, recorded, [matrix, *kept])


def record_balance(before: DataFrame, after: DataFrame, test_scores: DataFrame, model: ModelConfig) -> dict:
    """Sizes and class shares before and after resampling, as recorded with a run."""
    old, new = (sampling.class_counts(df, search.LABEL) for df in (before, after))
    n_old, n_new = sum(old.values()), sum(new.values())
    test = sampling.class_counts(test_scores, "label")
    return {
        "number_of_samples_X_train": n_old,
        "number_of_samples_X_train_processed": n_new,
        "sample_difference_in_X_train_processed": n_new - n_old,
        "resampled_negative_class_proportion": new.get(0, 0) / n_new,
        "resampled_positive_class_proportion": new.get(1, 0) / n_new,
        "train_outcome_prevalence": old.get(1, 0) / n_old,
        "test_outcome_prevalence": test.get(1, 0) / max(1, sum(test.values())),
        "number_of_features": len(model.features),
    }


NOT_EXPLAINED = ("KNeighborsClassifier", "MLPClassifier")
EXPLAINED_BY_LEAVES = ("DecisionTreeClassifier", "RandomForestClassifier", "XGBClassifier", "LGBMClassifier")


def curve_tables(scores: DataFrame) -> dict[str, DataFrame]:
    """The tables behind the plots of a test evaluation."""
    hard = curves.with_hard_label(scores, "p")
    return {
        "precision_recall": curves.precision_recall_points(scores, "label", "p"),
        "roc": curves.roc_points(scores, "label", "p"),
        "confusion": curves.confusion_matrix(hard, "label", "prediction"),
        "calibration": curves.calibration_points(scores, "label", "p"),
    }


def learning_curve(gold: DataFrame, classifier: str, params: dict, sampler: str | None = None,
                   sampler_params: dict | None = None, shares: Sequence[float] = LEARNING_SHARES,
                   settings: ProcessingConfig = ProcessingConfig(), model: ModelConfig = ModelConfig()) -> DataFrame:
    """(share, fold, part, n, roc_auc) of models trained on growing samples of each fold."""
    rows = filters.role(training_rows(gold, model), "train", model.role_col)
    numeric, categorical = feature_kinds(rows, model)
    folded = sampling.stratified_folds(rows, model.outcome_col, model.key, model.n_folds, model.random_state)
    found = None
    for i in range(model.n_folds):
        valid = folded.filter(F.col("fold") == i)
        sampled = sampling.nested_samples(
            folded.filter(F.col("fold") != i), model.outcome_col, model.key, shares, model.random_state)
        for share in shares:
            part = sampled.filter(F.col("first_share") <= share)
            fitted = PanelPreprocessor(numeric=numeric, categorical=categorical).fit(part)
            matrix = search.model_rows(part, fitted, model.key, model.outcome_col)
            trained = search.fit_resampled(matrix, classifier, params, sampler, sampler_params, settings,
                                           model.random_state)
            held_out = search.model_rows(valid, fitted, model.key, model.outcome_col)
            for name, data in (("train", matrix), ("valid", held_out)):
                scored = trained.score(search.with_features(data)).select(
                    F.lit(float(share)).alias("share"), F.lit(i).alias("fold"), F.lit(name).alias("part"), search.LABEL, "p")
                found = scored if found is None else found.unionByName(scored)
    measured = metrics.evaluate(found, search.LABEL, "p", by=["share", "fold", "part"])
    return measured.select("share", "fold", "part", "n", "roc_auc")


def attributions(trained: Trained, rows: DataFrame, n_permutations: int = 8, seed: int = 42) -> DataFrame:
    """(row_key, feature, value) of processed rows; none for neighbours and perceptrons.

    Exact in the margin for a logistic model and boosted trees and in the probability for a tree or forest, sampled in
    the probability for the others.
    """
    name, unit = trained.model.classifier.name, trained.model
    if name in NOT_EXPLAINED:
        raise ValueError(f"no attributions for {name}")
    names = unit.preprocessor.feature_names
    named = F.array(*map(F.lit, names))[F.col("j")].alias("feature")
    if name in EXPLAINED_BY_LEAVES:
        leaves = tree_shapley.model_leaves(rows.sparkSession, unit.classifier.model)
        values = tree_shapley.tree_shapley(rows.select(search.KEY, search.VECTOR), search.VECTOR, leaves)
        return values.select(search.KEY, F.posexplode("shap").alias("j", "value")).select(search.KEY, named, "value")
    wide = rows.select(search.KEY, *[F.col(search.VECTOR)[i].alias(f"f{i}") for i in range(len(names))])
    plain = [f"f{i}" for i in range(len(names))]
    means = explain.feature_means(wide, plain)
    labels = F.create_map(*[F.lit(x) for pair in zip(plain, names) for x in pair])
    if name == "LogisticRegression":
        weights = dict(zip(plain, map(float, unit.classifier.model.coefficients)))
        values = explain.linear_shapley(wide, weights, means).select(search.KEY, F.posexplode("shap").alias("j", "value"))
        return values.select(search.KEY, named, "value")

    def score(df: DataFrame) -> DataFrame:
        return unit.classifier.score(search.with_features(df.withColumn(search.VECTOR, F.array(*plain))))

    found = explain.sampled_shapley(wide, [search.KEY], plain, score, means, n_permutations, seed)
    return found.withColumn("feature", labels[F.col("feature")])


# -- with tables --------------------------------------------------------------------------------


def _metadata(spark: SparkSession, names: LayerNames, table: str, schema) -> DataFrame:
    full = f"{names.schema('ml_assets')}.{table}"
    return spark.table(full) if spark.catalog.tableExists(full) else spark.createDataFrame([], schema)


def read_runs(spark: SparkSession, names: LayerNames) -> DataFrame:
    return _metadata(spark, names, RUNS_TABLE, registry.RUNS_SCHEMA)


def read_events(spark: SparkSession, names: LayerNames) -> DataFrame:
    return _metadata(spark, names, EVENTS_TABLE, registry.MODEL_EVENTS_SCHEMA)


def _append_events(spark: SparkSession, names: LayerNames, events: DataFrame) -> None:
    rows = spark.createDataFrame(events.collect(), registry.MODEL_EVENTS_SCHEMA)  # a handful of versions
    tables.append_table(rows, names.schema("ml_assets"), EVENTS_TABLE)


def model_path(names: LayerNames, run_id: str, root: str) -> str:
    return f"{root.rstrip('/')}/{names.registered_model}/{run_id}"


def run_tuning(spark: SparkSession, names: LayerNames, settings: ProcessingConfig = ProcessingConfig(),
               model: ModelConfig = ModelConfig()) -> None:
    gold = tables.read_table(spark, names.schema("gold"), names.gold_table())
    runs = tune(spark, gold, f"cv_{names.model}", settings, model)
    tables.append_table(runs, names.schema("ml_assets"), RUNS_TABLE)


def evaluation_tables(trained: Trained, gold: DataFrame, chosen: tuple, settings: ProcessingConfig,
                      model: ModelConfig) -> dict[str, DataFrame]:
    """Everything that is looked at after training, as tables: curves, attributions, learning curve."""
    found = curve_tables(trained.test_scores)
    if model.shap_values and trained.model.classifier.name not in NOT_EXPLAINED:
        values = attributions(trained, trained.resampled, seed=model.random_state)
        found["shapley"] = explain.summarise(values, search.KEY, model.shap_threshold)
    if model.learning_curves:
        found["learning"] = learning_curve(gold, *chosen, settings=settings, model=model)
    return found


def run_training(spark: SparkSession, names: LayerNames, model_root: str,
                 settings: ProcessingConfig = ProcessingConfig(), model: ModelConfig = ModelConfig()) -> str:
    """Refit the chosen run, save the model, record its metrics and curves, register it as challenger.

    Curves go to tables ``curve_<kind>`` with the run's id.
    """
    gold = tables.read_table(spark, names.schema("gold"), names.gold_table())
    chosen = settings_of(choose_run(read_runs(spark, names), f"cv_{names.model}", model))
    started, run_id = dt.datetime.now(), uuid.uuid4().hex
    trained = train(gold, *chosen, settings, model)
    trained.model.save(spark, model_path(names, run_id, model_root))
    found = metrics.recorded_metrics(trained.test_scores, "label", "p").first().asDict()
    tags = {"outcome_variable": model.outcome_col, "model_type": trained.model.classifier.name,
            "performed_calibration": str(model.perform_calibration),
            "use_resampling_in_train_pipeline": str(model.use_resampling), "deployment_target": names.env}
    params = {k: str(v) for k, v in trained.recorded.items()} | {"selected_features": ",".join(model.features)}
    values = {k: float(v) for k, v in found.items() if v is not None}
    run = spark.createDataFrame(
        [(run_id, f"train_{names.model}", None, "FINISHED", started, tags, params, values)], registry.RUNS_SCHEMA)
    tables.append_table(run, names.schema("ml_assets"), RUNS_TABLE)
    for kind, df in evaluation_tables(trained, gold, chosen, settings, model).items():
        tables.append_table(df.withColumn("run_id", F.lit(run_id)), names.schema("ml_assets"), f"curve_{kind}")
    _append_events(spark, names, registry.registration(read_events(spark, names), names.registered_model, run_id))
    trained.release()
    return run_id


def run_validation(spark: SparkSession, names: LayerNames, run_mode: str = "dry_run",
                   model: ModelConfig = ModelConfig()) -> bool:
    """Compare the newest challenger with the champion and promote it where it earned that."""
    if run_mode not in registry.RUN_MODES:
        raise ValueError(f"run_mode must be one of {registry.RUN_MODES}, not {run_mode!r}")
    if run_mode == "disabled":
        return False
    events = registry.get_registered_model(read_events(spark, names), names.registered_model)
    runs = read_runs(spark, names)
    challenger = registry.get_version(events, names.registered_model, "None")
    champions = registry.versions_by_stage_and_alias(events, "Staging", "Champion")
    of_challenger = registry.comparison_metrics(registry.get_run(runs, challenger["run_id"]))
    of_champion = registry.comparison_metrics(runs.join(champions.select("run_id"), "run_id", "left_semi"))
    compared = registry.compare_metrics(of_challenger, of_champion)
    decision = registry.promotion_decision(compared, run_mode, model.min_test_roc_auc, model.min_test_auprc_lift).first()
    if decision["promote"]:
        move = events.filter(F.col("version") == challenger["version"]).select("name", "version").distinct()
        _append_events(spark, names, registry.transition(events, move, "Staging"))
    return decision["promote"]


def run_scoring(spark: SparkSession, names: LayerNames, model_root: str, model: ModelConfig = ModelConfig(),
                fmt: str = "parquet") -> str:
    """Score the serving panel with the champion and write the inference table."""
    champion = registry.get_version(read_events(spark, names), names.registered_model, "Staging", "Champion")
    unit = scoring.PropensityModel.load(spark, model_path(names, champion["run_id"], model_root))
    serving = tables.read_table(spark, names.schema("gold"), names.gold_table(serving=True))
    predicted = unit.score(serving).select(*model.key, *model.features, scoring.PREDICTED)
    tables.overwrite_table(predicted, names.schema("ml_assets"), names.inference_table, names.path("ml_assets"), fmt)
    return f"{names.schema('ml_assets')}.{names.inference_table}"
