"""Model matrix, neighbours, oversampling, classifiers, calibration and scoring."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from panelspark.config import ModelConfig
from panelspark.operators import calibration, classifiers, explain, filters, neighbors, sampling, scoring, search, synthetic, tree_shapley
from panelspark.operators.preprocess import PanelPreprocessor
from panelspark.plans import training
from panelspark.plans.queries import panel
from panelspark.plans.queries.book import ctes, query, rounded
from panelspark.plans.queries.evaluation import SCORES, scores
from panelspark.plans.standins import load
from panelspark.session import checkpointed

MODEL = ModelConfig()

# -- model matrix -------------------------------------------------------------------------------

PARTS = """SELECT p_partkey, CASE WHEN p_size % 7 <> 0 THEN CAST(p_size AS DOUBLE) END AS size, p_retailprice AS price,
  CASE WHEN p_size % 5 <> 0 THEN p_type END AS kind FROM part"""


@query("model_matrix", ctes(
    p=PARTS,
    f="""SELECT p_partkey, coalesce(size, (SELECT median(size) FROM p)) AS size, coalesce(price, (SELECT median(price) FROM p)) AS price,
         lower(regexp_replace(trim(coalesce(kind, (SELECT kind FROM p WHERE kind IS NOT NULL GROUP BY kind ORDER BY count(*) DESC, kind LIMIT 1))),
               '[^A-Za-z0-9_]+', '_', 'g')) AS kind FROM p""",
) + """
SELECT p_partkey, 'size' AS feature, round((size - avg(size) OVER ()) / stddev_pop(size) OVER (), 6) AS value FROM f
UNION ALL SELECT p_partkey, 'price', round((price - avg(price) OVER ()) / stddev_pop(price) OVER (), 6) FROM f
UNION ALL SELECT p_partkey, concat('kind_', l.kind), CAST(f.kind = l.kind AS INT)::DOUBLE FROM f, (SELECT DISTINCT kind FROM f) l
""")
def model_matrix(spark, sf):
    parts = load(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_size") % 7 != 0, F.col("p_size").cast("double")).alias("size"),
        F.col("p_retailprice").alias("price"), F.when(F.col("p_size") % 5 != 0, F.col("p_type")).alias("kind"))
    fitted = PanelPreprocessor(numeric=["size", "price"], categorical=["kind"]).fit(parts)
    named = F.arrays_zip(F.array(*map(F.lit, fitted.feature_names)).alias("feature"), fitted.as_array().alias("value"))
    return rounded(parts.select("p_partkey", F.inline(named)), "value")


# an order's key as a category: as many levels as orders; every seventh line has none and takes the most frequent
@query("one_hot_many_levels", """
WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity::DOUBLE AS quantity,
  CASE WHEN l_linenumber <> 7 THEN lower(concat('Order ', l_orderkey)) END AS level FROM lineitem),
c AS (SELECT regexp_replace(level, '[^A-Za-z0-9_]+', '_', 'g') AS level, count(*) AS n FROM l WHERE level IS NOT NULL GROUP BY 1),
p AS (SELECT level, row_number() OVER (ORDER BY level) AS position FROM c)
SELECT l_orderkey, l_linenumber, p.position, (SELECT count(*) + 1 FROM c)::BIGINT AS width,
  round((quantity - avg(quantity) OVER ()) / stddev_pop(quantity) OVER (), 6) AS quantity
FROM l JOIN p ON p.level = coalesce(regexp_replace(l.level, '[^A-Za-z0-9_]+', '_', 'g'), (SELECT level FROM c ORDER BY n DESC, level LIMIT 1))
""")
def one_hot_many_levels(spark, sf):
    """Where each line's order is in the sparse vector, beside the scaled quantity."""
    lines = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("quantity"),
        F.when(F.col("l_linenumber") != 7, F.concat(F.lit("Order "), "l_orderkey")).alias("order"))
    fitted = PanelPreprocessor(numeric=["quantity"], categorical=["order"]).fit(lines)
    shown = F.col("features").cast("string")  # (width,[places],[values])
    value = F.regexp_extract(shown, r"\[0,.*\],\[([^,\]]*)", 1)
    rows = fitted.transform(lines).select(
        "l_orderkey", "l_linenumber", F.regexp_extract(shown, r"([0-9]+)\],", 1).cast("long").alias("position"),
        F.regexp_extract(shown, r"^\(([0-9]+)", 1).cast("long").alias("width"),
        F.coalesce(F.when(value != "", value.cast("double")), F.lit(0.0)).alias("quantity"))
    return rounded(rows, "quantity")


# -- neighbours and oversampling ----------------------------------------------------------------

NEAR = {
    "d": """SELECT a.vec_id::VARCHAR AS q, b.vec_id::VARCHAR AS n, a.label AS ql, b.label AS nl,
            list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS dist
            FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id""",
    "r": "SELECT *, row_number() OVER (PARTITION BY q ORDER BY dist, n) AS rank FROM d",
}


@query("nearest_neighbors", ctes(**NEAR) + """
SELECT q AS query_id, n AS neighbor_id, round(dist, 6) AS distance, rank::INT AS rank FROM r WHERE rank <= 5
""")
def nearest_neighbors(spark, sf):
    vectors = load(spark, sf, "embeddings")
    return rounded(neighbors.nearest(vectors, vectors, 5, "vec_id", "embedding"), "distance")


@query("neighbor_vote", ctes(**NEAR) + """
SELECT q AS query_id, round(avg((nl = 3)::INT), 6) AS p FROM r WHERE rank <= 7 GROUP BY q
""")
def neighbor_vote(spark, sf):
    vectors = load(spark, sf, "embeddings").withColumn("y", (F.col("label") == 3).cast("int"))
    near = neighbors.nearest(vectors, vectors, 7, "vec_id", "embedding")
    return rounded(neighbors.vote(near, vectors, "vec_id", "y", 7), "p")


def _one_against_rest(spark, sf):
    """Vectors of one label as a minority of about a tenth."""
    return load(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("row_key"), (F.col("label") == 3).cast("int").alias("label"),
        F.col("embedding").cast("array<double>").alias("vec"))


COUNTS = "SELECT count_if(label = 3) AS pos, count_if(label <> 3) AS neg FROM embeddings"
CLASSES = """SELECT 0 AS label, false AS synthetic, neg AS n FROM c UNION ALL SELECT 1, false, pos FROM c
UNION ALL SELECT 1, true, {added}"""


@query("smote_class_counts", ctes(c=COUNTS) + CLASSES.format(added="floor(neg * 0.5 - pos)::BIGINT FROM c"))
def smote_class_counts(spark, sf):
    made = synthetic.smote(_one_against_rest(spark, sf), "label", "vec", ratio=0.5, k=5)
    return made.groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("n"))


# the same draws as the sampler: seeds in hash order, neighbour and position from hashes
SMOTE_ROWS = ctes(
    c=COUNTS,
    m="SELECT vec_id::VARCHAR AS k, embedding::DOUBLE[] AS v FROM embeddings WHERE label = 3",
    near="""SELECT a.k, b.v AS nv, row_number() OVER (PARTITION BY a.k ORDER BY list_distance(a.v, b.v), b.k) - 1 AS j
            FROM m a JOIN m b ON a.k <> b.k""",
    seeds="""SELECT k, v, row_number() OVER (ORDER BY ('0x' || substr(md5('42|' || k), 1, 15))::BIGINT, k) AS pos FROM m""",
    copies="""SELECT k, v, i AS copy FROM seeds, c, generate_series(1, 20) t(i)
              WHERE i <= floor(neg * 0.5 - pos_n) // pos_n + (seeds.pos <= floor(neg * 0.5 - pos_n) % pos_n)::INT""".replace("pos_n", "c.pos"),
    drawn="""SELECT k, v, copy, ('0x' || substr(md5('42|' || k || '|' || copy), 1, 15))::BIGINT % 5 AS j,
             ('0x' || substr(md5('43|' || k || '|' || copy), 1, 15))::BIGINT / 1152921504606846976::DOUBLE AS u FROM copies""",
) + """
SELECT k || '#' || copy AS row_key, round(list_sum(list_transform(v, lambda x, i: x + u * (nv[i] - x))), 5) AS total,
       round(list_extract(v, 1) + u * (nv[1] - v[1]), 6) AS first
FROM drawn JOIN near USING (k, j)
"""


@query("smote_rows", SMOTE_ROWS)
def smote_rows(spark, sf):
    made = synthetic.smote(_one_against_rest(spark, sf), "label", "vec", ratio=0.5, k=5).filter("synthetic")
    total = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x)
    return made.select("row_key", F.round(total, 5).alias("total"), F.round(F.col("vec")[0], 6).alias("first"))


@query("rows_in_danger", ctes(**NEAR, g="SELECT q, count_if(nl <> 3) AS n_majority FROM r WHERE ql = 3 AND rank <= 10 GROUP BY q") + """
SELECT q AS row_key, n_majority FROM g WHERE n_majority >= 5 AND n_majority < 10
""")
def rows_in_danger(spark, sf):
    return synthetic.in_danger(_one_against_rest(spark, sf), "label", "vec", m=10)


@query("borderline_class_counts", ctes(c=COUNTS, **NEAR, g="SELECT q, count_if(nl <> 3) AS n_majority FROM r WHERE ql = 3 AND rank <= 10 GROUP BY q") +
       "SELECT * FROM (" + CLASSES.format(added="""(CASE WHEN (SELECT count_if(n_majority >= 5 AND n_majority < 10) FROM g) > 0
         THEN floor(neg * 0.5 - pos) ELSE 0 END)::BIGINT FROM c""") + ") WHERE n > 0")
def borderline_class_counts(spark, sf):
    made = synthetic.borderline_smote(_one_against_rest(spark, sf), "label", "vec", ratio=0.5, k=5, m=10)
    return made.groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("n"))


# as the rows of SMOTE, from other seeds: those in danger, or as many copies as the neighbourhood asks for
SEED_PARTS = {
    "m": "SELECT vec_id::VARCHAR AS k, embedding::DOUBLE[] AS v FROM embeddings WHERE label = 3",
    "near": """SELECT a.k, b.v AS nv, row_number() OVER (PARTITION BY a.k ORDER BY list_distance(a.v, b.v), b.k) - 1 AS j
            FROM m a JOIN m b ON a.k <> b.k""",
}
DRAWN_PARTS = {
    "copied": "SELECT k, v, unnest(generate_series(1, n_copies)) AS copy FROM seeds",
    "drawn": """SELECT k, v, copy, ('0x' || substr(md5('42|' || k || '|' || copy), 1, 15))::BIGINT % 5 AS j,
             ('0x' || substr(md5('43|' || k || '|' || copy), 1, 15))::BIGINT / 1152921504606846976::DOUBLE AS u FROM copied""",
}
SYNTHETIC = """
SELECT k || '#' || copy AS row_key, round(list_sum(list_transform(v, lambda x, i: x + u * (nv[i] - x))), 5) AS total,
       round(list_extract(v, 1) + u * (nv[1] - v[1]), 6) AS first
FROM drawn JOIN near USING (k, j)
"""


def _synthetic_rows(made):
    total = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x)
    return made.filter("synthetic").select("row_key", F.round(total, 5).alias("total"), F.round(F.col("vec")[0], 6).alias("first"))


@query("borderline_rows", ctes(
    c=COUNTS, **NEAR, g="SELECT q, count_if(nl <> 3) AS n_majority FROM r WHERE ql = 3 AND rank <= 10 GROUP BY q", **SEED_PARTS,
    danger="""SELECT m.*, row_number() OVER (ORDER BY ('0x' || substr(md5('42|' || k), 1, 15))::BIGINT, k) AS pos, count(*) OVER () AS n
              FROM m WHERE k IN (SELECT q::VARCHAR FROM g WHERE n_majority >= 5 AND n_majority < 10)""",
    wanted="SELECT floor(c.neg * 0.5 - c.pos)::BIGINT AS wanted_rows FROM c",
    seeds="SELECT k, v, (wanted_rows // n + (pos <= wanted_rows % n)::INT)::BIGINT AS n_copies FROM danger, wanted",
    **DRAWN_PARTS) + SYNTHETIC)
def borderline_rows(spark, sf):
    return _synthetic_rows(synthetic.borderline_smote(_one_against_rest(spark, sf), "label", "vec", ratio=0.5, k=5, m=10))


ADASYN = ctes(c=COUNTS, **NEAR, g="SELECT q, count_if(nl <> 3) AS n_majority FROM r WHERE ql = 3 AND rank <= 5 GROUP BY q",
              a="""SELECT q, round_even(n_majority / (SELECT sum(n_majority) FROM g)::DOUBLE * floor(neg * 0.5 - pos), 0)::INT AS copies
                   FROM g, c""")


@query("adasyn_copies", ADASYN + "SELECT q AS row_key, copies FROM a")
def adasyn_copies(spark, sf):
    df = _one_against_rest(spark, sf)
    total = synthetic.rows_to_add(sampling.class_counts(df, "label"), 0.5)
    return synthetic.adasyn_copies(df, "label", "vec", total, k=5)


@query("adasyn_rows", ADASYN + ", " + ctes(
    **SEED_PARTS, seeds="SELECT k, v, copies::BIGINT AS n_copies FROM m JOIN a ON a.q::VARCHAR = k WHERE copies > 0", **DRAWN_PARTS,
).removeprefix("WITH ") + SYNTHETIC)
def adasyn_rows(spark, sf):
    return _synthetic_rows(synthetic.adasyn(_one_against_rest(spark, sf), "label", "vec", ratio=0.5, k=5))


@query("adasyn_class_counts", ADASYN + CLASSES.format(added="(SELECT sum(copies)::BIGINT FROM a)"))
def adasyn_class_counts(spark, sf):
    made = synthetic.adasyn(_one_against_rest(spark, sf), "label", "vec", ratio=0.5, k=5)
    return made.groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("n"))


@query("resampled_balance", ctes(c=COUNTS) + """
SELECT 1 AS label, floor(neg * 0.4)::BIGINT AS n, round(floor(neg * 0.4) / (floor(neg * 0.4) + floor(floor(neg * 0.4) / 0.5)), 6) AS share FROM c
UNION ALL SELECT 0, floor(floor(neg * 0.4) / 0.5)::BIGINT,
  round(floor(floor(neg * 0.4) / 0.5) / (floor(neg * 0.4) + floor(floor(neg * 0.4) / 0.5)), 6) FROM c
""")
def resampled_balance(spark, sf):
    made = synthetic.smote(_one_against_rest(spark, sf), "label", "vec", ratio=0.4, k=5)
    return rounded(sampling.class_balance(sampling.under_sample(made, "label", ["row_key"], 0.5), "label"), "share")


# -- classifiers --------------------------------------------------------------------------------

NB_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _log_density(c: str, y: int) -> str:
    deviation = f"({c} - s{y}.{c}_m)"
    return f"-0.5 * (ln(2 * pi() * s{y}.{c}_v) + {deviation} * {deviation} / s{y}.{c}_v)"


def _log_joint(y: int) -> str:
    return f"s{y}.prior + " + " + ".join(_log_density(c, y) for c in NB_FEATURES)


NB_STATS = "SELECT ln(count(*) / (SELECT count(*) FROM i)) AS prior, " + ", ".join(
    f"avg({c}) AS {c}_m, var_pop({c}) + (SELECT eps FROM e) AS {c}_v" for c in NB_FEATURES) + " FROM i WHERE y = "
# a billionth of the largest variance is added to all of them
NB_FLOOR = "SELECT 1e-9 * greatest(" + ", ".join(f"var_pop({c})" for c in NB_FEATURES) + ") AS eps FROM lineitem"


@query("naive_bayes_scores", ctes(
    i="SELECT *, (l_returnflag = 'R')::INT AS y FROM lineitem", e=NB_FLOOR, s0=NB_STATS + "0", s1=NB_STATS + "1",
) + f"""
SELECT l_orderkey, l_linenumber, l_partkey, round(1 / (1 + exp(({_log_joint(0)}) - ({_log_joint(1)}))), 4) AS p FROM i, s0, s1
""")
def naive_bayes_scores(spark, sf):
    items = load(spark, sf, "lineitem").withColumn("label", (F.col("l_returnflag") == "R").cast("int"))
    rows = items.withColumn("features", array_to_vector(F.array(*NB_FEATURES)))
    fitted = classifiers.fit_classifier(rows, "GaussianNB")
    return fitted.score(rows).select("l_orderkey", "l_linenumber", "l_partkey", F.round("p", 4).alias("p"))


def _panel_scores(spark, sf, classifier: str, params: dict):
    """Fit on the train role of the gold panel and score its test role."""
    rows = checkpointed(training.training_rows(panel.gold(spark, sf)))
    numeric, categorical = training.feature_kinds(rows)
    fitted = PanelPreprocessor(numeric=numeric, categorical=categorical).fit(filters.role(rows, "train"))

    def matrix(part: str) -> DataFrame:
        return search.with_features(search.model_rows(filters.role(rows, part), fitted, MODEL.key, MODEL.outcome_col))

    trained = classifiers.fit_classifier(matrix("train"), classifier, params)
    return trained.score(matrix("test")).select("row_key", "label", F.round("p", 6).alias("p"))


PANEL_MODELS = {
    "logistic_scores": ("LogisticRegression", {"C": 0.5, "class_weight": "balanced"}),
    "decision_tree_scores": ("DecisionTreeClassifier", {"max_depth": 5, "min_samples_split": 10, "max_features": "sqrt"}),
    "random_forest_scores": ("RandomForestClassifier", {"n_estimators": 20, "max_depth": 4}),
    "boosted_tree_scores": ("XGBClassifier", {"n_estimators": 10, "max_depth": 3, "learning_rate": 0.1}),
    "perceptron_scores": ("MLPClassifier", {"max_iter": 20}),
    "neighbor_scores": ("KNeighborsClassifier", {"n_neighbors": 7}),
}
for _name, (_classifier, _params) in PANEL_MODELS.items():
    query(_name)(lambda spark, sf, c=_classifier, p=_params: _panel_scores(spark, sf, c, p))


# -- calibration, search, scoring, attributions --------------------------------------------------


def _calibrated(spark, sf, method: str):
    rows = scores(spark, sf)
    fitted = calibration.fit_calibrator(rows, "p", "y", method)
    return fitted.apply(rows.select("o_orderkey", F.col("p").alias("score")), "score").select(
        "o_orderkey", "score", F.round("p", 4).alias("p"))


@query("sigmoid_calibrated")
def sigmoid_calibrated(spark, sf):
    return _calibrated(spark, sf, "sigmoid")


# the isotonic fit in closed form: the largest, over starts at or before a point, of the smallest mean from there to
# an end at or behind it
@query("isotonic_calibrated", ctes(
    s=SCORES,
    n="""SELECT p AS score, sum(y) AS pos, count(*) AS w, row_number() OVER (ORDER BY p) AS i,
         sum(sum(y)) OVER (ORDER BY p) AS cum_pos, sum(count(*)) OVER (ORDER BY p) AS cum_w FROM s GROUP BY p""",
    g="""SELECT j.i AS j, k.i AS i, (k.cum_pos - j.cum_pos + j.pos) / (k.cum_w - j.cum_w + j.w)::DOUBLE AS mean
         FROM n j JOIN n k ON k.i >= j.i""",
    low="SELECT i, min(mean) OVER (PARTITION BY j ORDER BY i DESC) AS low FROM g",
    f="SELECT i, max(low) AS fitted FROM low GROUP BY i") + """
SELECT o_orderkey, score, round(fitted, 4) AS p FROM s JOIN n ON s.p = n.score JOIN f USING (i)
""")
def isotonic_calibrated(spark, sf):
    return _calibrated(spark, sf, "isotonic")


@query("search_trials")
def search_trials(spark, sf):
    """Two models by two folds on the train role; the same trials each time."""
    model = ModelConfig(models_to_try=("GaussianNB", "LogisticRegression"), use_resampling=False, n_iter=3, parallelism=3)
    runs = training.tune(spark, checkpointed(panel.gold(spark, sf)), "cv", model=model).filter("parent_run_id IS NOT NULL")
    found = [F.round(F.col("metrics")[m], 6).alias(m) for m in ("median_cv_log_loss", "median_cv_roc_auc")]
    return runs.select(F.col("tags")["classifier_type"].alias("classifier"), "status", *found)


@query("learning_curve")
def learning_curve(spark, sf):
    df = training.learning_curve(checkpointed(panel.gold(spark, sf)), "GaussianNB", {}, shares=(0.5, 1.0))
    return rounded(df, "roc_auc")


@query("score_serving_panel")
def score_serving_panel(spark, sf):
    """Train, calibrate on half of the test rows, and score the serving panel."""
    trained = training.train(checkpointed(panel.gold(spark, sf)), "LogisticRegression", {"C": 1.0}, None, {})
    predicted = trained.model.score(panel.gold(spark, sf, serving=True))
    return rounded(predicted.select(*MODEL.key, scoring.PREDICTED), scoring.PREDICTED, digits=4)


@query("user_model_scores", """
SELECT p_partkey, round(1 / (1 + exp(-(0.1 * p_size - p_retailprice / 1000))), 6) AS p FROM part
""")
def user_model_scores(spark, sf):
    import numpy as np

    score = scoring.user_model_udf(lambda x: 1 / (1 + np.exp(-(0.1 * x["p_size"] - x["p_retailprice"] / 1000))))
    return load(spark, sf, "part").select("p_partkey", F.round(score("p_size", "p_retailprice"), 6).alias("p"))


@query("sampled_shapley", """
SELECT s_suppkey, feature, round(value, 5) AS value FROM (
  SELECT s_suppkey, 'nation' AS feature, 0.5 * (s_nationkey - avg(s_nationkey) OVER ()) AS value FROM supplier
  UNION ALL SELECT s_suppkey, 'balance', -0.001 * (s_acctbal - avg(s_acctbal) OVER ()) FROM supplier
  UNION ALL SELECT s_suppkey, 'parity', 2.0 * (s_suppkey % 2 - avg(s_suppkey % 2) OVER ()) FROM supplier)
""")
def sampled_shapley(spark, sf):
    """Over any feature orders a linear score gives its exact attributions."""
    rows = load(spark, sf, "supplier").select(
        "s_suppkey", F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"),
        (F.col("s_suppkey") % 2).alias("parity"))
    weights = {"nation": 0.5, "balance": -0.001, "parity": 2.0}

    def score(df: DataFrame) -> DataFrame:
        return df.withColumn("p", reduce(lambda a, b: a + b, [F.lit(w) * F.col(c) for c, w in weights.items()]))

    means = explain.feature_means(rows, list(weights))
    return rounded(explain.sampled_shapley(rows, ["s_suppkey"], list(weights), score, means, 4), "value", digits=5)


# a tree of five leaves over two features; what it expects of a feature alone follows the shares of rows below each split
@query("tree_shapley", """
WITH r AS (SELECT p_partkey, p_size::DOUBLE AS size, p_retailprice AS price, (p_partkey % 10)::DOUBLE AS y FROM part),
l AS (SELECT *, CASE WHEN size <= 25 AND price <= 912 THEN 'a' WHEN size <= 25 THEN 'b' WHEN size <= 40 THEN 'c'
  WHEN price <= 915 THEN 'd' ELSE 'e' END AS leaf FROM r),
n AS (SELECT count(*)::DOUBLE AS n, count_if(leaf = 'a') AS na, count_if(leaf = 'b') AS nb, count_if(leaf = 'c') AS nc,
  count_if(leaf = 'd') AS nd, count_if(leaf = 'e') AS ne, avg(y) FILTER (leaf = 'a') AS a, avg(y) FILTER (leaf = 'b') AS b,
  avg(y) FILTER (leaf = 'c') AS c, avg(y) FILTER (leaf = 'd') AS d, avg(y) FILTER (leaf = 'e') AS e FROM l),
v AS (SELECT p_partkey, (na * a + nb * b + nc * c + nd * d + ne * e) / n AS none,
  CASE leaf WHEN 'a' THEN a WHEN 'b' THEN b WHEN 'c' THEN c WHEN 'd' THEN d ELSE e END AS both_known,
  CASE WHEN size <= 25 THEN (na * a + nb * b) / (na + nb) WHEN size <= 40 THEN c ELSE (nd * d + ne * e) / (nd + ne) END AS by_size,
  ((na + nb) * (CASE WHEN price <= 912 THEN a ELSE b END) + nc * c + (nd + ne) * (CASE WHEN price <= 915 THEN d ELSE e END)) / n
    AS by_price FROM l, n)
SELECT p_partkey, round(((by_size - none) + (both_known - by_price)) / 2, 6) AS size,
  round(((by_price - none) + (both_known - by_size)) / 2, 6) AS price, round(both_known, 6) AS score FROM v
""")
def tree_attributions(spark, sf):
    """Attributions by the leaves of a tree whose shares and values are those of the table's own rows."""
    rows = load(spark, sf, "part").select(
        "p_partkey", F.array(F.col("p_size").cast("double"), F.col("p_retailprice").cast("double")).alias("x"),
        (F.col("p_partkey") % 10).cast("double").alias("y"))
    # (place, left child, right child, feature, cut); places without a split are leaves
    splits = {0: (1, 2, 0, 25.0), 1: (3, 4, 1, 912.0), 2: (5, 6, 0, 40.0), 6: (7, 8, 1, 915.0)}
    within = {0: F.lit(True)}
    for node, (left, right, f, cut) in splits.items():
        low = F.col("x")[f] <= cut
        within |= {left: within[node] & low, right: within[node] & ~low}
    totals = [e for k, here in within.items() for e in (F.count_if(here).alias(f"n{k}"), F.avg(F.when(here, F.col("y"))).alias(f"v{k}"))]
    found = rows.agg(*totals).first()
    nodes = []
    for k in within:
        left, right, f, cut = splits.get(k, (-1, -1, -1, None))
        split = Row(featureIndex=f, leftCategoriesOrThreshold=[cut], numCategories=-1)
        nodes.append(Row(id=k, rawCount=found[f"n{k}"], prediction=found[f"v{k}"], leftChild=left, rightChild=right, split=split))
    leaves = tree_shapley.leaves_of(nodes, lambda n: n["prediction"])
    shown = tree_shapley.tree_shapley(rows, "x", leaves)
    score = F.col("shap")[0] + F.col("shap")[1] + F.lit(tree_shapley.expected_value(leaves))
    return rounded(shown.select("p_partkey", F.col("shap")[0].alias("size"), F.col("shap")[1].alias("price"), score.alias("score")),
                   "size", "price", "score")
