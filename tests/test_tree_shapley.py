import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from panelspark.operators import tree_shapley
from panelspark.plans import training
from panelspark.session import shared_folder

FEATURES = 4


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 6, size=(300, FEATURES)).astype(float)
    y = ((x[:, 0] > 2) ^ (x[:, 1] > 3) | (x[:, 2] == 5)).astype(float)
    data = [(i, [float(v) for v in row], float(t)) for i, (row, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "id int, x array<double>, label double")
    return df.withColumn("features", array_to_vector("x")).persist()


def trees_of(spark, model):
    """{tree: {id: node}} of a saved model."""
    path = f"{shared_folder(spark)}/test_trees/{id(model)}"
    model.write().overwrite().save(path)
    found = {}
    for r in spark.read.parquet(f"{path}/data").collect():
        tree, node = (r["treeID"], r["nodeData"]) if "treeID" in r else (0, r)
        found.setdefault(tree, {})[node["id"]] = node
    return found


def expected(nodes, x, known, value, k=0):
    """What a tree expects of a row of which some features are known."""
    node = nodes[k]
    if node["leftChild"] < 0:
        return value(node)
    f, cut = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"][0]
    left, right = node["leftChild"], node["rightChild"]
    if f in known:
        return expected(nodes, x, known, value, left if x[f] <= cut else right)
    return sum(nodes[c]["rawCount"] / node["rawCount"] * expected(nodes, x, known, value, c) for c in (left, right))


def by_subsets(trees, x, value):
    """Attributions by all subsets of the features, for (nodes, weight) trees."""
    out = []
    for f in range(FEATURES):
        others, total = [g for g in range(FEATURES) if g != f], 0.0
        for n in range(FEATURES):
            weight = math.factorial(n) * math.factorial(FEATURES - n - 1) / math.factorial(FEATURES)
            for known in map(set, combinations(others, n)):
                total += weight * sum(w * (expected(t, x, known | {f}, value) - expected(t, x, known, value)) for t, w in trees)
        out.append(total)
    return out


def share(node):
    return node["impurityStats"][1] / sum(node["impurityStats"])


@pytest.mark.parametrize("kind,settings", [
    (DecisionTreeClassifier, {"maxDepth": 5}), (RandomForestClassifier, {"numTrees": 4, "maxDepth": 4}), (GBTClassifier, {"maxIter": 4, "maxDepth": 3})])
def test_equals_all_subsets_and_adds_up(spark, rows, kind, settings):
    model = kind(seed=1, **settings).fit(rows)
    nodes = trees_of(spark, model)
    boosted = kind is GBTClassifier
    weights = list(model.treeWeights) if boosted else [1 / len(nodes)] * len(nodes)
    value = (lambda n: n["prediction"]) if boosted else share
    leaves = tree_shapley.model_leaves(spark, model)
    base = tree_shapley.expected_value(leaves)
    trees = [(nodes[i], w) for i, w in enumerate(weights)]
    scored = model.transform(tree_shapley.tree_shapley(rows, "x", leaves))
    score = vector_to_array("rawPrediction" if boosted else "probability")[1].alias("score")
    for k, r in enumerate(scored.select("x", "shap", score).collect()):
        assert base + sum(r.shap) == pytest.approx(r.score)
        if k < 25:
            assert r.shap == pytest.approx(by_subsets(trees, r.x, value), abs=1e-12)


def test_one_leaf_and_null_vectors(spark):
    (leaf,) = tree_shapley.leaves_of([{"id": 0, "leftChild": -1}], lambda n: 0.25)
    assert leaf.features == () and tree_shapley.expected_value([leaf]) == 0.25
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "id int, x array<double>")
    found = {r.id: r.shap for r in tree_shapley.tree_shapley(df, "x", [leaf]).collect()}
    assert found == {1: [0.0, 0.0], 2: None}
    split = {"featureIndex": 0, "leftCategoriesOrThreshold": [1.0], "numCategories": 3}
    with pytest.raises(ValueError):
        tree_shapley.leaves_of([{"id": 0, "leftChild": 1, "rightChild": 2, "rawCount": 4, "split": split}], None)


def test_no_row_is_copied_or_shuffled(spark, rows):
    leaves = tree_shapley.model_leaves(spark, DecisionTreeClassifier(maxDepth=2).fit(rows))
    found = tree_shapley.tree_shapley(rows.select("id", "x"), "x", leaves)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Repartition" not in plan and "Aggregate" not in plan
    assert found.select(F.size("shap")).distinct().collect()[0][0] == FEATURES
    assert set(training.EXPLAINED_BY_LEAVES).isdisjoint(training.NOT_EXPLAINED)
