"""The three entry points from raw tables to scores, on tables written for the purpose."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from panelspark.config import SELECTED_FEATURES, ModelConfig, ProcessingConfig, gold_contract
from panelspark.operators import checks, metrics, registry, scoring
from panelspark.operators.waves import WaveCalendar
from panelspark.plans import feature_build, standins, training
from panelspark.sources import layers, tables

MODEL = ModelConfig(models_to_try=("GaussianNB", "LogisticRegression"), n_iter=2, parallelism=2, use_resampling=False,
                    learning_curves=False)


@pytest.fixture(scope="module")
def names(spark, tmp_path_factory):
    found = layers.LayerNames("test", root=str(tmp_path_factory.mktemp("lake")))
    assert layers.create_databases(spark, found) == [found.schema(x) for x in layers.LAYERS]
    return found


@pytest.fixture(scope="module")
def bronze(spark, names):
    raw, sf = feature_build.RawTables(), "/root/testdata/sf0.01"
    for table, build in ((raw.members, standins.members), (raw.attributes, standins.attributes), (raw.labels, standins.labels)):
        df = build(spark, sf)
        if table == raw.members:
            df = df.withColumnsRenamed({"totprem": "TOTPREM", "custage": "CustAge"})
        tables.overwrite_table(df, names.schema("bronze"), table, names.path("bronze"))
    return names


@pytest.fixture(scope="module")
def gold(spark, bronze):
    full = feature_build.run_feature_build(spark, bronze, standins.training_calendar(), model=MODEL)
    return spark.table(full)


def test_names():
    found = layers.LayerNames("dev", model="m", project="p", root="/lake/")
    assert found.schema("gold") == "p_gold_dev" and found.path("gold") == "/lake/p_gold_dev"
    assert found.silver_table("members", serving=True) == "members_m_serving"
    assert found.gold_table() == "m" and found.gold_table(serving=True) == "m_serving"
    assert found.inference_table == "inference_m" and found.registered_model == "dev_m"
    assert len(found.as_dict()) == 17 and layers.LayerNames("dev").path("gold") is None
    for bad in (lambda: layers.LayerNames("live"), lambda: found.schema("tin")):
        with pytest.raises(ValueError):
            bad()


def test_overwrite_may_change_the_schema(spark, names):
    schema = names.schema("bronze")
    tables.overwrite_table(spark.range(3), schema, "t", names.path("bronze"))
    tables.overwrite_table(spark.range(2).selectExpr("id", "'x' as c"), schema, "t", names.path("bronze"), partition_by=["c"])
    assert sorted(map(tuple, tables.read_table(spark, schema, "t").select("id", "c").collect())) == [(0, "x"), (1, "x")]


def test_register_raw(spark, names, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([("1", "a"), ("2", "b")], "n string, c string").write.csv(path, header=True)
    df = tables.register_raw(spark, path, names.schema("bronze"), "raw_csv", "csv", "n int, c string", header=True)
    assert df.schema["n"].dataType.simpleString() == "int" and df.count() == 2
    with pytest.raises(ValueError, match="schema"):
        tables.read_files(spark, path, "csv")


def test_gold(spark, gold):
    assert len(gold.columns) == 30 and gold.count() > 400
    assert all(checks.validate(gold, gold_contract()))
    assert {r[0] for r in gold.select("set_type").distinct().collect()} == {"train", "test"}
    assert tuple(checks.duplicate_keys(gold, tuple(MODEL.key)).first())[1] == 0


def test_failed_contract_is_an_error(spark, gold):
    with pytest.raises(AssertionError, match="numerical_ranges"):
        feature_build.assert_valid(gold.withColumn("hh_aua", F.lit(7.0)))


def test_downsampled_labels(spark, sf):
    settings = ProcessingConfig(perform_initial_downsampling=True, non_response_ratio=1)
    raw, calendar = standins.labels(spark, sf), standins.training_calendar()
    less = feature_build.build_silver_labels(raw, calendar, settings)
    all_rows = feature_build.build_silver_labels(raw, calendar)
    responders = F.count_if(F.col(MODEL.outcome_col) == 1)
    assert less.agg(responders).first() == all_rows.agg(responders).first()
    assert less.count() < all_rows.filter(f"{MODEL.outcome_col} is not null").count()


def test_serving_mode(spark, bronze):
    full = feature_build.run_feature_build(spark, bronze, standins.serving_calendar(), model=MODEL)
    serving = spark.table(full)
    assert len(serving.columns) == 28 and serving.count() > 0
    assert {r[0] for r in serving.select(MODEL.wave_col).distinct().collect()} == {"1998-07-10"}


def test_reprocessed_labels_have_their_own_table(spark, bronze, gold):
    before = spark.table(f"{bronze.schema('silver')}.{bronze.silver_table('labels')}").count()
    full = feature_build.reprocess_labels(spark, bronze, standins.serving_calendar(), model=MODEL)
    assert spark.table(full).count() > 0
    assert spark.table(f"{bronze.schema('silver')}.{bronze.silver_table('labels')}").count() == before


def test_hot_keys_do_not_change_the_panel(spark, sf):
    calendar = standins.training_calendar()
    parts = [feature_build.build_silver(standins.members(spark, sf), calendar),
             feature_build.build_silver(standins.attributes(spark, sf), calendar),
             feature_build.build_silver_labels(standins.labels(spark, sf), calendar)]
    plain = feature_build.build_gold(*parts)
    some = [tuple(r) for r in plain.select(*MODEL.key).limit(2).collect()]
    salted = feature_build.build_gold(*parts, hot_keys=some)
    assert plain.exceptAll(salted).isEmpty() and salted.exceptAll(plain).isEmpty()


def test_life_of_a_model(spark, bronze, gold, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("models"))
    if not spark.catalog.tableExists(f"{bronze.schema('gold')}.{bronze.gold_table(serving=True)}"):
        feature_build.run_feature_build(spark, bronze, standins.serving_calendar(), model=MODEL)
    with pytest.raises(RuntimeError, match="no finished run"):
        training.run_training(spark, bronze, root, model=MODEL)
    training.run_tuning(spark, bronze, model=MODEL)
    first = training.run_training(spark, bronze, root, model=MODEL)
    run = registry.get_run(training.read_runs(spark, bronze), first).first()
    assert set(run.metrics) <= set(metrics.TEST_METRICS) and run.params["number_of_features"] == "26"
    for kind in ("precision_recall", "roc", "confusion", "calibration", "shapley"):
        curve = spark.table(f"{bronze.schema('ml_assets')}.curve_{kind}")
        assert not curve.isEmpty() and {r[0] for r in curve.select("run_id").distinct().collect()} == {first}
    assert training.run_validation(spark, bronze, "disabled") is False
    with pytest.raises(ValueError, match="Champion"):
        training.run_scoring(spark, bronze, root, MODEL)
    assert training.run_validation(spark, bronze, "dry_run") is True
    champion = registry.get_version(training.read_events(spark, bronze), bronze.registered_model, "Staging", "Champion")
    assert (champion["version"], champion["run_id"]) == (1, first)
    training.run_training(spark, bronze, root, model=replace(MODEL, shap_values=False))
    assert training.run_validation(spark, bronze, "enabled") is False  # equal is not better
    scored = spark.table(training.run_scoring(spark, bronze, root, MODEL))
    assert scored.columns == [*MODEL.key, *SELECTED_FEATURES, scoring.PREDICTED]
    assert scored.count() == spark.table(f"{bronze.schema('gold')}.{bronze.gold_table(serving=True)}").count()
    assert scored.filter(f"{scoring.PREDICTED} is null or not {scoring.PREDICTED} between 0 and 1").isEmpty()


@pytest.mark.parametrize("classifier, params, method", [
    ("LogisticRegression", {"C": 1.0}, "isotonic"),
    ("RandomForestClassifier", {"n_estimators": 5, "max_depth": 3}, "sigmoid"),
    ("KNeighborsClassifier", {"n_neighbors": 5}, "sigmoid"),
])
def test_saved_model_scores_alike(spark, gold, tmp_path, classifier, params, method):
    model = ModelConfig(calibration_method=method)
    trained = training.train(gold, classifier, params, None, {}, model=model)
    path = str(tmp_path / "model")
    trained.model.save(spark, path)
    rows = gold.drop(MODEL.outcome_col, MODEL.role_col)
    found, again = (
        {tuple(r)[:2]: r[2] for r in unit.score(rows).select(*MODEL.key, F.round(scoring.PREDICTED, 9)).collect()}
        for unit in (trained.model, scoring.PropensityModel.load(spark, path))
    )
    assert found == again and len(found) == gold.count()
    assert set(training.curve_tables(trained.test_scores)) == {"precision_recall", "roc", "confusion", "calibration"}
    trained.release()


def test_training_with_resampling_and_attributions(spark, gold):
    settings = ProcessingConfig(over_sampling_ratio=0.8, under_sampling_ratio=0.9)
    trained = training.train(gold, "LogisticRegression", {}, "SMOTE", {"k_neighbors": 3}, settings)
    recorded = trained.recorded
    assert recorded["resampled_positive_class_proportion"] == pytest.approx(0.9 / 1.9, abs=0.01)
    assert recorded["number_of_samples_X_train_processed"] == trained.resampled.count()
    values = training.attributions(trained, trained.resampled)
    assert values.count() == trained.resampled.count() * len(trained.model.preprocessor.feature_names)
    trained.release()


def test_learning_curve(spark, gold):
    found = training.learning_curve(gold, "GaussianNB", {}, shares=(0.5, 1.0)).collect()
    assert len(found) == 8
    sizes = {(r.fold, r.share): r.n for r in found if r.part == "train"}
    assert all(sizes[f, 0.5] == pytest.approx(sizes[f, 1.0] / 2, abs=1) for f in (0, 1))


def test_calendar_needs_both_roles():
    with pytest.raises(ValueError):
        WaveCalendar.from_args(train=["2023-01-01"])
