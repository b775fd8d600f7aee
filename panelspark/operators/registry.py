"""Runs, experiments and model versions as tables, and the queries that choose among them.

runs          run_id, experiment_id, parent_run_id, status, start_time, tags, params, metrics
experiments   experiment_id, name, last_update_time
model_events  name, version, seq, stage, alias, run_id — append-only; the last event is the state

Every choice is an aggregate with a partial step before its shuffle, so an experiment that holds
most of the runs is no slower than the others.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("experiment_id", T.StringType()),
    T.StructField("parent_run_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
])

MODEL_EVENTS_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("seq", T.LongType()),
    T.StructField("stage", T.StringType()),
    T.StructField("alias", T.StringType()),
    T.StructField("run_id", T.StringType()),
])

STAGES = ("None", "Staging", "Production")
ALIASES = ("Challenger", "Champion")
RUN_MODES = ("disabled", "dry_run", "enabled")

SELECTION_METRIC = "median_cv_log_loss"

# Metrics a challenger is compared on, and whether larger is better.
COMPARISON_METRICS = {"test_log_loss": False, "test_roc_auc": True, "test_auprc_lift": True}


# -- choosing a run -----------------------------------------------------------------------------


def _finished(resampling: bool | None) -> Column:
    done = F.col("status") == "FINISHED"
    if resampling is None:
        return done
    return done & (F.col("tags")["use_resampling_in_train_pipeline"] == str(resampling))


def _best(runs: DataFrame, by: list[str], metric: str) -> DataFrame:
    """The run with the smallest metric per group; equal metrics go to the smaller id."""
    value = F.col("metrics")[metric]
    best = F.min(F.struct(value.alias("value"), F.col("run_id"))).alias("best")
    found = runs.filter(value.isNotNull()).groupBy(*by).agg(best)
    return found.select(*by, F.col("best.run_id").alias("run_id"), F.col("best.value").alias(metric))


def best_of_latest_parent(runs: DataFrame, resampling: bool | None = None,
                          metric: str = SELECTION_METRIC) -> DataFrame:
    """Per experiment: the best finished child of the parent that was started last.

    The parent is the one of the run started last; a run without parent is its own.
    """
    parent = F.coalesce("parent_run_id", "run_id")
    latest = (
        runs.filter(_finished(resampling))
        .groupBy("experiment_id")
        .agg(F.max_by(parent, F.struct("start_time", "run_id")).alias("parent_run_id"))
    )
    children = runs.filter(_finished(None) & (F.col("tags")["status"] == "OK") & F.col("parent_run_id").isNotNull())
    per_parent = _best(children, ["experiment_id", "parent_run_id"], metric)
    return per_parent.join(latest, ["experiment_id", "parent_run_id"])


def best_overall(runs: DataFrame, resampling: bool | None = None, metric: str = SELECTION_METRIC) -> DataFrame:
    """Per experiment: the best finished run with status tag OK."""
    return _best(runs.filter(_finished(resampling) & (F.col("tags")["status"] == "OK")), ["experiment_id"], metric)


def latest_experiment(experiments: DataFrame) -> DataFrame:
    """Per name: the experiment updated last."""
    last = F.max(F.struct("last_update_time", "experiment_id")).alias("last")
    return experiments.groupBy("name").agg(last).select(
        "name", F.col("last.experiment_id").alias("experiment_id"), F.col("last.last_update_time").alias("last_update_time")
    )


def get_run(runs: DataFrame, run_id: str) -> DataFrame:
    found = runs.filter(F.col("run_id") == run_id)
    if found.isEmpty():
        raise RuntimeError(f"no run with id '{run_id}'")
    return found


# -- comparing ----------------------------------------------------------------------------------


def comparison_metrics(runs: DataFrame, larger_is_better: Mapping[str, bool] = COMPARISON_METRICS,
                       id_col: str = "run_id") -> DataFrame:
    """(id, metric_name, value) with every value turned so that larger is better."""
    turned = F.array(*[
        F.struct(
            F.lit(name).alias("metric_name"),
            (F.col("metrics")[name] if larger else -F.col("metrics")[name]).alias("value"),
        )
        for name, larger in larger_is_better.items()
    ])
    return runs.select(id_col, F.inline(turned))


def compare_metrics(challenger: DataFrame, champion: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by…, metric_name, challenger, champion, better); better means strictly larger.

    Without a champion the last two columns are NULL.
    """
    on = [*(by or []), "metric_name"]
    left = challenger.select(*on, F.col("value").alias("challenger"))
    right = champion.select(*on, F.col("value").alias("champion"))
    joined = left.join(right, on, "left")
    return joined.withColumn("better", F.col("challenger") > F.col("champion"))


def promotion_decision(compared: DataFrame, run_mode: str = "dry_run", min_roc_auc: float = 0.7,
                       min_auprc_lift: float = 2.0, by: list[str] | None = None) -> DataFrame:
    """(by…, has_champion, promote), one row per group.

    Against a champion every metric has to be better. The first champion needs either threshold.
    A dry run promotes in any case; ``disabled`` never does.
    """
    if run_mode not in RUN_MODES:
        raise ValueError(f"run_mode must be one of {RUN_MODES}, not {run_mode!r}")

    def value(name: str) -> Column:
        return F.max(F.when(F.col("metric_name") == name, F.col("challenger")))

    grouped = compared.groupBy(*(by or [])).agg(
        F.coalesce(F.bool_or(F.col("champion").isNotNull()), F.lit(False)).alias("has_champion"),
        F.bool_and(F.coalesce("better", F.lit(False))).alias("_all_better"),
        ((value("test_roc_auc") >= min_roc_auc) | (value("test_auprc_lift") >= min_auprc_lift)).alias("_good_enough"),
    )
    earned = F.when(F.col("has_champion"), F.col("_all_better")).otherwise(F.coalesce("_good_enough", F.lit(False)))
    promote = {"disabled": F.lit(False), "dry_run": F.lit(True), "enabled": earned}[run_mode]
    return grouped.select(*(by or []), "has_champion", promote.alias("promote"))


# -- model versions -----------------------------------------------------------------------------


def model_versions(events: DataFrame) -> DataFrame:
    """The present state of every version: its last event."""
    last = F.max_by(F.struct("stage", "alias", "run_id"), "seq").alias("state")
    return events.groupBy("name", "version").agg(last, F.max("seq").alias("seq")).select(
        "name", "version", "seq", "state.*"
    )


def latest_versions(events: DataFrame) -> DataFrame:
    """Per model and stage: the highest version that stands in it."""
    newest = F.max_by(F.struct("version", "alias", "run_id"), "version").alias("newest")
    return model_versions(events).groupBy("name", "stage").agg(newest).select("name", "stage", "newest.*")


def versions_by_stage_and_alias(events: DataFrame, stage: str = "None", alias: str | None = None) -> DataFrame:
    """The newest version of a stage, per model, where it carries the alias."""
    if stage not in STAGES:
        raise ValueError(f"{stage!r} is no stage that can be asked for; known are {', '.join(STAGES)}")
    if alias and alias not in ALIASES:
        raise ValueError(f"{alias!r} is no alias; known are {', '.join(ALIASES)}")
    found = latest_versions(events).filter(F.col("stage") == stage)
    return found.filter(F.col("alias") == alias) if alias else found


def get_registered_model(events: DataFrame, name: str) -> DataFrame:
    found = events.filter(F.col("name") == name)
    if found.isEmpty():
        raise RuntimeError(f"nothing is registered under {name!r}")
    return found


def get_version(events: DataFrame, name: str, stage: str = "None", alias: str | None = None):
    """The one version row; an error where there is none."""
    row = versions_by_stage_and_alias(events.filter(F.col("name") == name), stage, alias).first()
    if row is None:
        raise ValueError(f"{name!r} has no version with stage {stage!r} and alias {alias!r}")
    return row


def versions_by_alias(events: DataFrame, alias: str) -> DataFrame:
    """Per model the newest version that carries the alias now, in whatever stage. No row where none does."""
    if alias not in ALIASES:
        raise ValueError(f"{alias!r} is no alias; known are {', '.join(ALIASES)}")
    newest = F.max_by(F.struct("version", "stage", "run_id"), "version").alias("newest")
    return model_versions(events).filter(F.col("alias") == alias).groupBy("name").agg(newest).select("name", "newest.*")


def move_alias(events: DataFrame, moves: DataFrame, alias: str) -> DataFrame:
    """Events that give the alias to one version per model, ``moves`` being (name, version): versions that carry it
    lose it, and stages stay."""
    if alias not in ALIASES:
        raise ValueError(f"{alias!r} is no alias; known are {', '.join(ALIASES)}")
    now = model_versions(events).join(moves.select("name", F.col("version").alias("_to")), "name")
    last = Window.partitionBy("name")
    now = now.withColumn("_last", F.max("seq").over(last))
    chosen = F.col("version") == F.col("_to")
    changed = now.filter((chosen & ~F.col("alias").eqNullSafe(F.lit(alias))) | (~chosen & (F.col("alias") == alias)))
    order = F.row_number().over(Window.partitionBy("name").orderBy("version"))
    return changed.select(
        "name", "version", (F.col("_last") + order).cast("long").alias("seq"), "stage",
        F.when(chosen, F.lit(alias)).alias("alias"), "run_id")


def registrations(events: DataFrame, new: DataFrame) -> DataFrame:
    """Events that register the next version of each model of ``new`` (name, run_id) as challenger."""
    known = events.groupBy("name").agg(F.max("version").alias("_version"), F.max("seq").alias("_seq"))
    found = new.select("name", "run_id").join(known, "name", "left")
    return found.select(
        "name", (F.coalesce("_version", F.lit(0)) + 1).cast("int").alias("version"),
        (F.coalesce("_seq", F.lit(0)) + 1).cast("long").alias("seq"), F.lit("None").alias("stage"),
        F.lit("Challenger").alias("alias"), "run_id",
    )


def registration(events: DataFrame, name: str, run_id: str) -> DataFrame:
    """The event that registers the next version of a model as challenger."""
    new = events.sparkSession.range(1).select(F.lit(name).alias("name"), F.lit(run_id).alias("run_id"))
    return registrations(events.filter(F.col("name") == name), new)


def transition(events: DataFrame, moves: DataFrame, stage: str = "Staging") -> DataFrame:
    """Events that move one version per model to ``stage`` as champion: ``moves`` is (name, version).

    Versions that stood in the stage are archived, and a champion among them loses its alias.
    """
    if stage not in (*STAGES, "Archived"):
        raise ValueError(f"unknown stage {stage!r}")
    asked = moves.select("name", F.col("version").alias("_to"))
    state = model_versions(events).join(asked, "name")
    next_seq = state.groupBy("name").agg(F.max("seq").alias("_last"))
    is_mover = F.col("version") == F.col("_to")
    changed = state.filter(is_mover | (F.col("stage") == stage)).join(next_seq, "name")
    former = F.when(F.col("alias") == "Champion", F.lit(None)).otherwise(F.col("alias"))
    return changed.select(
        "name", "version", (F.col("_last") + 1).alias("seq"),
        F.when(is_mover, F.lit(stage)).otherwise(F.lit("Archived")).alias("stage"),
        F.when(is_mover, F.lit("Champion")).otherwise(former).alias("alias"),
        "run_id",
    )
