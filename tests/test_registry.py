import datetime as dt

import pytest

from panelspark.operators import registry


def run(run_id, parent=None, loss=None, minute=0, status="FINISHED", tag="OK", resampling="True", exp="e", **metrics):
    tags = {"status": tag, "use_resampling_in_train_pipeline": resampling}
    values = ({"median_cv_log_loss": loss} if loss is not None else {}) | metrics
    return (run_id, exp, parent, status, dt.datetime(2024, 1, 1, 0, minute), tags, {}, values)


def runs(spark, *rows):
    return spark.createDataFrame(list(rows), registry.RUNS_SCHEMA)


def test_best_of_latest_parent(spark):
    df = runs(
        spark, run("p1", minute=1), run("a", "p1", 0.1, 2), run("p2", minute=5), run("b", "p2", 0.5, 6), run("c", "p2", 0.3, 7),
        run("d", "p2", 0.2, 8, status="FAILED"), run("f", "p2", 0.1, 8, tag="FAIL"), run("g", "p3", 0.0, 9, resampling="False"),
    )
    assert registry.best_of_latest_parent(df, True).first()["run_id"] == "c"
    assert registry.best_of_latest_parent(df, False).first()["run_id"] == "g"
    assert registry.best_overall(df, True).first()["run_id"] == "a"


def test_latest_run_may_be_the_parent_itself(spark):
    df = runs(spark, run("a", "p", 0.3, 1), run("p", minute=9))
    assert registry.best_of_latest_parent(df).first()["run_id"] == "a"


def test_get_run(spark):
    df = runs(spark, run("a"))
    assert registry.get_run(df, "a").first()["experiment_id"] == "e"
    with pytest.raises(RuntimeError):
        registry.get_run(df, "zzz")


def decide(spark, challenger, champion, mode="enabled"):
    names = ("test_log_loss", "test_roc_auc", "test_auprc_lift")
    new = registry.comparison_metrics(runs(spark, run("n", **dict(zip(names, challenger)))))
    old = registry.comparison_metrics(runs(spark, *([run("o", **dict(zip(names, champion)))] if champion else [])))
    return tuple(registry.promotion_decision(registry.compare_metrics(new, old), mode).first())


@pytest.mark.parametrize("challenger, champion, mode, wanted", [
    ((0.1, 0.9, 3.0), (0.2, 0.8, 2.0), "enabled", (True, True)),
    ((0.3, 0.9, 3.0), (0.2, 0.8, 2.0), "enabled", (True, False)),
    ((0.2, 0.9, 3.0), (0.2, 0.8, 2.0), "enabled", (True, False)),
    ((0.3, 0.1, 0.0), (0.2, 0.8, 2.0), "dry_run", (True, True)),
    ((0.1, 0.9, 3.0), (0.2, 0.8, 2.0), "disabled", (True, False)),
    ((0.1, 0.7, 0.0), None, "enabled", (False, True)),
    ((0.1, 0.5, 2.0), None, "enabled", (False, True)),
    ((0.1, 0.69, 1.9), None, "enabled", (False, False)),
    ((0.1, 0.5, 0.0), None, "dry_run", (False, True)),
])
def test_promotion(spark, challenger, champion, mode, wanted):
    assert decide(spark, challenger, champion, mode) == wanted


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        decide(spark, (1.0, 1.0, 1.0), None, "maybe")


def test_version_life(spark):
    events = spark.createDataFrame([], registry.MODEL_EVENTS_SCHEMA)

    def add(new):
        nonlocal events
        events = spark.createDataFrame(events.collect() + new.collect(), registry.MODEL_EVENTS_SCHEMA)

    with pytest.raises(RuntimeError):
        registry.get_registered_model(events, "m")
    add(registry.registration(events, "m", "r1"))
    assert registry.get_version(events, "m")["version"] == 1
    with pytest.raises(ValueError, match="has no version with stage 'Staging' and alias 'Champion'"):
        registry.get_version(events, "m", "Staging", "Champion")
    add(registry.transition(events, events.select("name", "version").distinct()))
    assert registry.get_version(events, "m", "Staging", "Champion")["run_id"] == "r1"
    add(registry.registration(events, "m", "r2"))
    assert registry.get_version(events, "m", "None", "Challenger")["version"] == 2
    add(registry.transition(events, spark.createDataFrame([("m", 2)], "name string, version int")))
    state = {r["version"]: (r["stage"], r["alias"]) for r in registry.model_versions(events).collect()}
    assert state == {1: ("Archived", None), 2: ("Staging", "Champion")}


def test_version_arguments(spark):
    events = spark.createDataFrame([], registry.MODEL_EVENTS_SCHEMA)
    with pytest.raises(ValueError, match="stage"):
        registry.versions_by_stage_and_alias(events, "Live")
    with pytest.raises(ValueError, match="alias"):
        registry.versions_by_stage_and_alias(events, "Staging", "Best")


def test_only_the_newest_version_of_a_stage_counts(spark):
    rows = [("m", 1, 1, "Staging", "Champion", "r1"), ("m", 2, 2, "Staging", None, "r2")]
    events = spark.createDataFrame(rows, registry.MODEL_EVENTS_SCHEMA)
    with pytest.raises(ValueError):
        registry.get_version(events, "m", "Staging", "Champion")


def test_latest_experiment(spark):
    rows = [("1", "x", dt.datetime(2024, 1, 1)), ("2", "x", dt.datetime(2024, 2, 1)), ("3", "y", dt.datetime(2023, 1, 1))]
    df = spark.createDataFrame(rows, "experiment_id string, name string, last_update_time timestamp")
    assert {r["name"]: r["experiment_id"] for r in registry.latest_experiment(df).collect()} == {"x": "2", "y": "3"}
