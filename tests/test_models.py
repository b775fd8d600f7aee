import math
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from panelspark.config import ModelConfig, ProcessingConfig
from panelspark.operators import calibration, classifiers, explain, metrics, preprocess, scoring, search
from panelspark.operators.preprocess import PanelPreprocessor, PanelPreprocessorModel, column_modes

MODEL = ModelConfig(features=("x1", "x2", "kind"), n_iter=4, parallelism=2)


def panel(spark, n=600, share=0.3, seed=0, role="train"):
    """Rows whose outcome follows x1, x2 and kind; some values missing."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(rng.random() < share)
        x1 = rng.gauss(2.0 * y, 1.0)
        x2 = rng.gauss(-1.5 * y, 1.0)
        kind = rng.choice(["A a", "B-b", "C"] if not y else ["A a", "A a", "D"])
        rows.append((str(i), "2024-01-01", None if i % 11 == 0 else x1, x2, None if i % 13 == 0 else kind, y, role))
    schema = f"{MODEL.id_col} string, {MODEL.wave_col} string, x1 double, x2 double, kind string, {MODEL.outcome_col} int, {MODEL.role_col} string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def gold(spark):
    return panel(spark).unionByName(panel(spark, 400, seed=1, role="test")).persist()


@pytest.fixture(scope="module")
def matrices(spark, gold):
    train, test = (gold.filter(f"set_type = '{r}'") for r in ("train", "test"))
    fitted = PanelPreprocessor(numeric=["x1", "x2"], categorical=["kind"]).fit(train)
    return [search.with_features(search.model_rows(df, fitted, MODEL.key, MODEL.outcome_col)).persist() for df in (train, test)]


def test_preprocessor(spark, tmp_path):
    rows = [(1.0, "b"), (2.0, "B "), (None, "a!"), (4.0, "a?"), (100.0, None)]
    df = spark.createDataFrame(rows, "x double, c string").withColumn("flat", F.lit(7))
    fitted = PanelPreprocessor(numeric=["x", "flat"], categorical=["c"]).fit(df)
    assert fitted.feature_names == ["x", "flat", "c_a_", "c_b"]
    filled = np.array([1.0, 2.0, 3.0, 4.0, 100.0])
    found = np.array([r.v for r in df.select(fitted.as_array().alias("v")).collect()])
    assert found[:, 0] == pytest.approx((filled - filled.mean()) / filled.std())
    assert (found[:, 1] == 0).all()
    assert found[:, 2:].tolist() == [[0, 1], [0, 1], [1, 0], [1, 0], [1, 0]]
    unseen = spark.createDataFrame([(None, "zzz", 7)], "x double, c string, flat int")
    assert unseen.select(fitted.as_array().alias("v")).first().v[2:] == [0.0, 0.0]
    path = str(tmp_path / "p")
    PipelineModel(stages=[fitted]).write().overwrite().save(path)
    again = PipelineModel.load(path).transform(df).select(vector_to_array("features").alias("v"))
    assert np.array([r.v for r in again.collect()]) == pytest.approx(found)
    assert isinstance(PipelineModel.load(path).stages[0], PanelPreprocessorModel)
    with pytest.raises(ValueError, match="no values"):
        PanelPreprocessor(numeric=["e"]).fit(df.withColumn("e", F.lit(None).cast("double")))


def test_levels_as_a_table_give_the_same_features(spark, tmp_path, monkeypatch):
    rows = [(float(i % 7), f"k{i % 23:02}" if i % 5 else None, "hot" if i % 3 else f"c{i % 11}") for i in range(400)]
    df = spark.createDataFrame(rows, "x double, a string, b string").withColumn("none", F.lit(None).cast("string"))
    settings = {"numeric": ["x"], "categorical": ["a", "none", "b"]}
    plain = PanelPreprocessor(**settings).fit(df)
    monkeypatch.setattr(preprocess, "LITERAL_LEVELS", 5)
    wide = PanelPreprocessor(**settings).fit(df)
    assert wide.has_table and not plain.has_table
    names = {r.position: r.feature for r in wide.feature_table(spark).collect()}
    assert [names[i] for i in range(len(names))] == plain.feature_names
    assert [tuple(r) for r in plain.feature_table(spark).orderBy("position").collect()] == list(zip(plain.feature_names, range(len(names))))
    path = str(tmp_path / "wide")
    PipelineModel(stages=[wide]).write().save(path)
    seen = df.unionByName(spark.createDataFrame([(1.0, "never", "seen", None)], df.schema))
    as_rows = vector_to_array("features").alias("v")
    want = np.array(sorted(tuple(r.v) for r in plain.transform(seen).select(as_rows).collect()))
    for model in (wide, PipelineModel.load(path)):
        found = model.transform(seen)
        assert found.columns == [*df.columns, "features"]
        assert np.array(sorted(tuple(r.v) for r in found.select(as_rows).collect())) == pytest.approx(want)
    with pytest.raises(ValueError):
        wide.as_array()
    rows = search.model_rows(df.withColumns({"id": F.monotonically_increasing_id(), "y": F.lit(1)}), wide, ["id"], "y")
    assert rows.count() == 400 and len(rows.first()[search.VECTOR]) == len(names)


def test_vectors_of_very_many_levels_carry_no_attributes(spark, monkeypatch):
    df = spark.range(60).select((F.col("id") % 3).alias("x"), F.concat(F.lit("k"), "id").alias("a"), F.lit("same").alias("b"))
    monkeypatch.setattr(preprocess, "LITERAL_LEVELS", 5)
    fitted = PanelPreprocessor(numeric=["x"], categorical=["a", "b"]).fit(df)
    found = fitted.transform(df.unionByName(spark.createDataFrame([(1, "never", None)], "x long, a string, b string")))
    assert found.schema["features"].metadata == {}  # one attribute per level would grow on the driver
    of = {r.a: r.features for r in found.collect()}
    levels = sorted(a for a in of if a != "never")
    assert {v.size for v in of.values()} == {62}
    assert [of[a].indices.tolist() for a in levels] == [[*([] if int(a[1:]) % 3 == 1 else [0]), 1 + i, 61] for i, a in enumerate(levels)]
    assert of["k0"].values.tolist() == pytest.approx([-math.sqrt(1.5), 1.0, 1.0])
    assert of["never"].indices.tolist() == [61] and of["never"].values.tolist() == [1.0]


def test_vectors_are_stored_the_shorter_way(spark):
    schema = "x double, p long, q long"
    df = spark.createDataFrame([(0.5, 1, 4), (0.0, None, 3), (float("nan"), 2, None)], schema)
    found = df.select(preprocess._sparse_vectors([F.col("x")], [F.col("p"), F.col("q")], 5).cast("string").alias("v")).collect()
    assert [r.v for r in found] == ["[0.5,1.0,0.0,0.0,1.0]", "(5,[3],[1.0])", "(5,[0,2],[NaN,1.0])"]


def test_mode_tie_goes_to_the_smaller(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "c string")
    assert [tuple(r) for r in column_modes(df, ["c"]).collect()] == [("c", "a", 2)]


def test_row_wise_stage(spark):
    df = spark.createDataFrame([("A b",)], "c string")
    fitted = Pipeline(stages=[scoring.CleanLevels(inputCols=["c"])]).fit(df)
    assert fitted.transform(df).first().c == "a_b"


@pytest.mark.parametrize("name, params", [
    ("GaussianNB", {}),
    ("DecisionTreeClassifier", {"max_depth": 4, "min_samples_split": 20, "criterion": "entropy"}),
    ("DecisionTreeClassifier", {"max_depth": 6, "max_features": "sqrt", "min_samples_split": 10}),
    ("LogisticRegression", {"C": 1.0, "class_weight": "balanced"}),
    ("RandomForestClassifier", {"n_estimators": 15, "max_depth": 4, "class_weight": "balanced_subsample", "max_features": 0.5}),
    ("XGBClassifier", {"n_estimators": 10, "max_depth": 3, "learning_rate": 0.2, "gamma": 0.0, "subsample": 0.8}),
    ("LGBMClassifier", {"n_estimators": 10, "max_depth": 3}),
    ("MLPClassifier", {"max_iter": 50, "tol": 1e-3}),
    ("KNeighborsClassifier", {"n_neighbors": 9}),
])
def test_classifiers_reach_the_floor(matrices, name, params):
    train, test = matrices
    scored = classifiers.fit_classifier(train, name, params).score(test)
    assert scored.count() == test.count()
    found = metrics.evaluate(scored, "label", "p").first()
    assert found["roc_auc"] > 0.85
    # naive Bayes is sure of itself where a class never shows a level
    assert found["brier"] < (0.3 if name == "GaussianNB" else 0.2)
    assert scored.filter("p < 0 or p > 1 or p is null").isEmpty()


def test_unknown_classifier(matrices):
    with pytest.raises(ValueError, match="model"):
        classifiers.fit_classifier(matrices[0], "Other")


def platt(scores, labels):
    """Newton steps on smoothed targets."""
    n_pos, n_neg = sum(labels), len(labels) - sum(labels)
    t = np.where(np.array(labels) == 1, (n_pos + 1) / (n_pos + 2), 1 / (n_neg + 2))
    x, w = np.column_stack([scores, np.ones(len(scores))]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x, x.T @ (t - p))
    return w


def isotonic(scores, labels):
    """Pool adjacent violators."""
    blocks = []
    for s in sorted(set(scores)):
        ys = [y for x, y in zip(scores, labels) if x == s]
        blocks.append([sum(ys), len(ys), [s]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2] + last[2]]
    return {s: total / n for total, n, members in blocks for s in members}


def scored_rows(n=400, seed=2):
    rng = random.Random(seed)
    labels = [int(rng.random() < 0.3) for _ in range(n)]
    return [round(rng.gauss(1.5 * y, 1.0), 1) for y in labels], labels


def test_sigmoid_calibration(spark):
    s, y = scored_rows()
    df = spark.createDataFrame(list(zip(s, y)), "score double, y int")
    fitted = calibration.fit_calibrator(df, "score", "y", "sigmoid")
    slope, intercept = platt(s, y)
    assert (fitted.slope, fitted.intercept) == pytest.approx((slope, intercept), rel=1e-4)
    p = {r.score: r.p for r in fitted.apply(df, "score").collect()}
    assert p[s[0]] == pytest.approx(1 / (1 + math.exp(-(slope * s[0] + intercept))), rel=1e-4)


def test_isotonic_calibration(spark):
    s, y = scored_rows()
    df = spark.createDataFrame(list(zip(s, y)), "score double, y int")
    found = {r.score: r.p for r in calibration.fit_calibrator(df, "score", "y", "isotonic").apply(df, "score").collect()}
    assert found == pytest.approx(isotonic(s, y))
    with pytest.raises(ValueError):
        calibration.fit_calibrator(df, "score", "y", "other")


def test_trial_table(spark):
    everything = ModelConfig(models_to_try=classifiers.MODEL_NAMES)
    table = search.trial_table(spark, 400, everything).collect()
    again = search.trial_table(spark.newSession(), 50, everything).repartition(3).orderBy("trial").collect()
    assert again == table[:50]
    seen = {}
    for row in table:
        seen.setdefault(row.classifier, []).append(search.parse_params(row.params))
        assert set(search.parse_params(row.sampler_params).values()) <= set(range(1, 11))
        assert row.sampler in ("SMOTE", "BorderlineSMOTE", "ADASYN")
    assert set(seen) == set(classifiers.MODEL_NAMES)
    assert all(p == {} for p in seen["GaussianNB"])
    assert {p["n_neighbors"] for p in seen["KNeighborsClassifier"]} <= set(range(1, 15))
    assert all(0.1 <= p["C"] <= 2 and p["solver"] in ("liblinear", "lbfgs") for p in seen["LogisticRegression"])
    assert {p.get("class_weight") for p in seen["LogisticRegression"]} == {None, "balanced"}
    for p in seen["RandomForestClassifier"]:
        assert 10 <= p["n_estimators"] <= 1200 and p.get("max_depth") in (None, 2, 3, 4) and 1 <= p["min_samples_leaf"] <= 50
    for p in seen["XGBClassifier"]:
        assert 1 <= p["max_depth"] <= 10 and 0 <= p["learning_rate"] < 0.5 and p["n_estimators"] % 200 == 0
        assert 0 <= p["gamma"] < 5 and 1 <= p["min_child_weight"] <= 100 and 0.5 <= p["subsample"] <= 1
    for p in seen["LGBMClassifier"]:
        assert 2 <= p["num_leaves"] <= 120 and p["boosting_type"] in ("gbdt", "dart", "goss")
    assert all(p["max_depth"] >= 0 for p in seen["DecisionTreeClassifier"])
    assert all(150 <= p["max_iter"] < 350 for p in seen["MLPClassifier"])
    plain = search.trial_table(spark, 5, ModelConfig(use_resampling=False)).collect()
    assert all(r.sampler is None for r in plain)


def test_trial_draws_follow_their_distribution(spark):
    d = search.Draw(1)
    df = spark.range(4000).withColumnRenamed("id", "trial")
    row = df.agg(
        F.avg(d.uniform("a", 2, 4)).alias("u"), F.avg(F.log(d.log_uniform("b", 1, 100))).alias("lu"),
        F.avg(F.log(d.rounded_log_normal("c", 6, 1))).alias("ln"), F.stddev(F.log(d.rounded_log_normal("c", 6, 1))).alias("sd"),
        F.avg((d.choice("e", ["x", "y"], [0.2, 0.8]) == "x").cast("int")).alias("x"),
    ).first()
    assert row.asDict() == pytest.approx({"u": 3.0, "lu": math.log(10), "ln": 6.0, "sd": 1.0, "x": 0.2}, rel=0.05)


def test_search(spark, gold):
    small = panel(spark, 600, share=0.08, seed=4)
    folds = search.prepare_folds(small, ["x1", "x2"], ["kind"], MODEL)
    plain = ModelConfig(features=MODEL.features, n_iter=2, parallelism=2, models_to_try=("GaussianNB", "LogisticRegression"))
    trials = search.trial_table(spark, 2, plain)
    settings = ProcessingConfig(over_sampling_ratio=0.3)
    runs = search.run_search(spark, folds, trials, "exp", settings, plain)
    rows = runs.collect()
    assert len(rows) == 3 and sum(r.parent_run_id is None for r in rows) == 1
    for r in rows:
        if r.parent_run_id:
            assert r.status == "FINISHED" and r.tags["status"] == "OK", r.tags
            assert set(r.metrics) == set(metrics.CV_METRICS) and r.metrics["median_cv_roc_auc"] > 0.8
    search.release([df for f in folds for df in (f.train, f.valid)])


def test_failing_trial_does_not_stop_the_search(spark):
    def evaluate(folds, classifier, params, *rest):
        if classifier == "GaussianNB":
            raise ValueError("no luck")
        return {"median_cv_log_loss": 1.0}

    model = ModelConfig(models_to_try=("GaussianNB", "LogisticRegression"), parallelism=3)
    runs = search.run_search(spark, [], search.trial_table(spark, 20, model), "exp", model=model, evaluate=evaluate)
    states = {(r.tags["classifier_type"], r.status, r.tags["status"], r.metrics.get("loss")) for r in runs.collect() if r.parent_run_id}
    assert states == {("GaussianNB", "FAILED", "FAIL", math.inf), ("LogisticRegression", "FINISHED", "OK", None)}


def test_shapley_adds_up(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(30, 3))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, a double, b double, c double")
    means = explain.feature_means(df, ["a", "b", "c"])

    def score(rows):
        return rows.withColumn("p", F.col("a") * F.col("b") + F.col("c"))

    found = {}
    for r in explain.sampled_shapley(df, ["id"], ["a", "b", "c"], score, means, n_permutations=200).collect():
        found.setdefault(r.id, {})[r.feature] = r.value
    m = x.mean(0)
    for i, row in enumerate(x):
        values = found[i]
        assert sum(values.values()) == pytest.approx(row[0] * row[1] + row[2] - m[0] * m[1] - m[2])
        assert values["c"] == pytest.approx(row[2] - m[2])
        assert values["a"] == pytest.approx((row[0] - m[0]) * (row[1] + m[1]) / 2, abs=0.35 * (1 + abs((row[0] - m[0]) * (row[1] - m[1]))))


def test_mean_abs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "a double, b double")
    shap = explain.linear_shapley(df, {"a": 2.0, "b": -1.0}, explain.feature_means(df, ["a", "b"]))
    assert {r.feature: r.mean_abs for r in explain.mean_abs_attribution(shap, ["a", "b"]).collect()} == {"a": 2.0, "b": 1.0}


def test_summary_leaves_extreme_rows_out(spark):
    rows = [("a", "x", 1.0), ("a", "y", -2.0), ("b", "x", 5.0), ("b", "y", 0.0), ("c", "x", -3.0), ("c", "y", 4.9)]
    values = spark.createDataFrame(rows, "k string, feature string, value double")
    found = {r.feature: r.mean_abs for r in explain.summarise(values, "k", 5.0).collect()}
    assert found == pytest.approx({"x": 2.0, "y": 3.45})


def test_settings_without_effect_are_named(spark):
    assert set(classifiers.EFFECTIVE) == set(classifiers.MODEL_NAMES)
    drawn = search.model_space(search.Draw(1))
    assert {m: classifiers.without_effect(m, drawn[m]) for m in ("GaussianNB", "KNeighborsClassifier", "RandomForestClassifier")} == {
        "GaussianNB": [], "KNeighborsClassifier": [], "RandomForestClassifier": []}
    assert classifiers.without_effect("MLPClassifier", drawn["MLPClassifier"]) == ["activation", "alpha", "learning_rate", "momentum", "power_t"]
    assert "min_child_weight" not in classifiers.without_effect("XGBClassifier", drawn["XGBClassifier"])
    assert classifiers._boosted_trees({"min_child_weight": "7.6"}, 10, 2, 1).getMinInstancesPerNode() == 8


def test_most_neighbours_asked_for(spark):
    trials = search.trial_table(spark, 40, ModelConfig())
    asked = [int(float(v)) for r in trials.collect() for v in (r["sampler_params"] or {}).values()]
    assert search.most_neighbours(trials) == max(asked)
    assert search.most_neighbours(search.trial_table(spark, 5, ModelConfig(use_resampling=False))) == 0
