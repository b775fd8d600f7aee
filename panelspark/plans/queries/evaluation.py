"""Metrics, curves and attributions over scored rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import curves, explain, filters, metrics
from panelspark.plans import standins
from panelspark.plans.queries.book import ctes, query, rounded
from panelspark.plans.standins import load

# scores with many ties; the outcome is an urgent order
SCORES_SQL = """
SELECT o_orderkey, o_orderstatus AS grp, CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS INT) AS y,
       CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS p
FROM {orders}
"""
SCORES = SCORES_SQL.format(orders="orders")


def scores(spark, sf):
    return standins.derive(spark, sf, SCORES_SQL)


# every distinct score of a group with the class totals at or above it
CURVE = {
    "s": SCORES,
    "h": "SELECT {by}, p, sum(y) AS pos, count(*) - sum(y) AS neg FROM s GROUP BY {by}, p",
    "k": """SELECT *, sum(pos) OVER up AS tp, sum(neg) OVER up AS fp, sum(pos) OVER a AS n_pos, sum(neg) OVER a AS n_neg
            FROM h WINDOW a AS (PARTITION BY {by}), up AS (PARTITION BY {by} ORDER BY p DESC)""",
    "rank": """SELECT {by}, round(sum(pos * (n_neg - fp + neg / 2)) / (max(n_pos) * max(n_neg)), 6) AS roc_auc,
            round(sum(pos * tp / (tp + fp)) / max(n_pos), 6) AS auprc FROM k GROUP BY {by}""",
}


def _curve_ctes(by: str, source: str | None = None) -> str:
    parts = {name: body.format(by=by) for name, body in CURVE.items()}
    if source:
        parts["s"] = source
    return ctes(**parts)


POINTS = """SELECT {by}, count(*) AS n, 0 AS n_left_out,
  avg(CASE WHEN y = (p > 0.5)::INT THEN -ln(1 - 2.220446049250313e-16::DOUBLE) ELSE -ln(2.220446049250313e-16::DOUBLE) END) AS log_loss_hard,
  avg(-CASE WHEN y = 1 THEN ln(greatest(p, 2.220446049250313e-16::DOUBLE)) ELSE ln(1 - least(p, 1 - 2.220446049250313e-16::DOUBLE)) END) AS log_loss,
  avg((y = (p > 0.5)::INT)::INT) AS accuracy,
  count_if(y = 1 AND p > 0.5) AS tp, count_if(y = 0 AND p > 0.5) AS fp, count_if(y = 1 AND p <= 0.5) AS fn,
  avg(y) AS prevalence, avg((p - y) * (p - y)) AS brier FROM s GROUP BY {by}"""
METRICS = """n, n_left_out, round(log_loss_hard, 6) AS log_loss_hard, round(log_loss, 6) AS log_loss, round(accuracy, 6) AS accuracy,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, round(prevalence, 6) AS prevalence,
  round(brier, 6) AS brier"""
METRIC_COLS = ["log_loss_hard", "log_loss", "accuracy", "precision", "recall", "f1", "prevalence", "brier"]


@query("pointwise_metrics", ctes(s=f"SELECT *, 1 AS one FROM ({SCORES})", m=POINTS.format(by="one")) + f"SELECT {METRICS} FROM m")
def pointwise_metrics(spark, sf):
    return rounded(metrics.pointwise_metrics(scores(spark, sf), "y", "p"), *METRIC_COLS)


@query("ranking_metrics", _curve_ctes("one", f"SELECT *, 1 AS one FROM ({SCORES})") + "SELECT roc_auc, auprc FROM rank")
def ranking_metrics(spark, sf):
    return rounded(metrics.ranking_metrics(scores(spark, sf), "y", "p"), "roc_auc", "auprc")


@query("evaluate_by_group", _curve_ctes("grp") + ", m AS (" + POINTS.format(by="grp") + f""")
SELECT grp, {METRICS}, roc_auc, auprc, round(auprc / prevalence, 4) AS auprc_lift FROM m JOIN rank USING (grp)
""")
def evaluate_by_group(spark, sf):
    df = metrics.evaluate(scores(spark, sf), "y", "p", by=["grp"])
    return rounded(rounded(df, *METRIC_COLS, "roc_auc", "auprc"), "auprc_lift", digits=4)


# the same scores with every seventh label and every eleventh score missing
HOLES = f"SELECT o_orderkey, grp, nullif(y, CASE WHEN o_orderkey % 7 = 0 THEN y END) AS y, nullif(p, CASE WHEN o_orderkey % 11 = 0 THEN p END) AS p FROM ({SCORES})"


@query("metrics_with_missing_values", _curve_ctes("grp", f"SELECT * FROM ({HOLES}) WHERE y IS NOT NULL AND p IS NOT NULL") + f"""
, m AS ({POINTS.format(by="grp")}), o AS (SELECT grp, count(*) - count(y + p) AS n_out FROM ({HOLES}) GROUP BY grp)
SELECT grp, {METRICS.replace("n_left_out", "n_out AS n_left_out")}, roc_auc, auprc FROM m JOIN rank USING (grp) JOIN o USING (grp)
""")
def metrics_with_missing_values(spark, sf):
    df = scores(spark, sf)
    missing = {"y": F.col("o_orderkey") % 7 == 0, "p": F.col("o_orderkey") % 11 == 0}
    df = df.withColumns({c: F.when(~gone, F.col(c)) for c, gone in missing.items()})
    found = metrics.evaluate(df, "y", "p", by=["grp"]).drop("auprc_lift")
    return rounded(found, *METRIC_COLS, "roc_auc", "auprc")


RECORDED = {
    "test_log_loss": "log_loss_hard", "test_precision": "precision", "test_recall": "recall", "test_f1": "f1",
    "test_roc_auc": "roc_auc", "test_auprc": "auprc", "test_auprc_baseline": "prevalence", "test_brier": "brier",
    "test_auprc_lift": "auprc_lift",
}


@query("recorded_metrics", _curve_ctes("grp") + ", m AS (" + POINTS.format(by="grp") + f"""),
e AS (SELECT grp, {METRICS}, roc_auc, auprc, round(auprc / prevalence, 4) AS auprc_lift FROM m JOIN rank USING (grp))
SELECT grp, {", ".join(f"{v} AS {k}" for k, v in RECORDED.items())} FROM e
""")
def recorded_metrics(spark, sf):
    df = metrics.recorded_metrics(scores(spark, sf), "y", "p", by=["grp"])
    return rounded(rounded(df, *RECORDED), "test_auprc_lift", digits=4)


MEDIANS = {
    "median_cv_log_loss": "log_loss_hard", "median_cv_accuracy": "accuracy", "median_cv_precision": "precision",
    "median_cv_recall": "recall", "median_cv_f1": "f1", "median_cv_roc_auc": "roc_auc", "median_cv_avg_precision": "auprc",
    "median_cv_response_rate": "prevalence", "median_cv_avg_precision_lift": "auprc_lift",
}
BY_FOLD = f"SELECT o_orderkey % 5 AS fold, grp, y, p FROM ({SCORES})"


@query("median_over_folds", _curve_ctes("grp, fold", BY_FOLD) + f""", m AS ({POINTS.format(by="grp, fold")}),
e AS (SELECT grp, fold, {METRICS}, roc_auc, auprc, auprc / prevalence AS auprc_lift FROM m JOIN rank USING (grp, fold))
SELECT grp, {", ".join(f"round(median({v}), 4) AS {k}" for k, v in MEDIANS.items())} FROM e GROUP BY grp
""")
def median_over_folds(spark, sf):
    df = scores(spark, sf).withColumn("fold", F.col("o_orderkey") % 5)
    folds = metrics.evaluate(df, "y", "p", by=["grp", "fold"])
    return rounded(metrics.median_over_folds(folds, ["grp"]), *MEDIANS, digits=4)


BOTH_CLASSES = f"""SELECT 'positive' AS class, y, p FROM ({SCORES})
UNION ALL SELECT 'negative', 1 - y, 1.0::DOUBLE - p FROM ({SCORES})"""


@query("precision_recall_points", _curve_ctes("class", BOTH_CLASSES) + """
SELECT class, round(p, 6) AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / n_pos, 6) AS recall FROM k
UNION ALL SELECT DISTINCT class, NULL, 1.0, 0.0 FROM k
""")
def precision_recall_points(spark, sf):
    df = curves.precision_recall_points(scores(spark, sf), "y", "p")
    return rounded(df, "threshold", "precision", "recall")


@query("roc_points", _curve_ctes("class", BOTH_CLASSES) + """
SELECT class, round(p, 6) AS threshold, round(fp / n_neg, 6) AS fpr, round(tp / n_pos, 6) AS tpr FROM k
UNION ALL SELECT DISTINCT class, NULL, 0.0, 0.0 FROM k
""")
def roc_points(spark, sf):
    return rounded(curves.roc_points(scores(spark, sf), "y", "p"), "threshold", "fpr", "tpr")


@query("curve_summary", _curve_ctes("class", BOTH_CLASSES) + """
SELECT class, roc_auc, auprc, round(baseline, 6) AS baseline
FROM rank JOIN (SELECT class, avg(y) AS baseline FROM s GROUP BY class) USING (class)
""")
def curve_summary(spark, sf):
    return rounded(curves.curve_summary(scores(spark, sf), "y", "p"), "roc_auc", "auprc", "baseline")


CELLS = ctes(s=SCORES, c="SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(label, predicted)")


@query("confusion_matrix", CELLS + """
SELECT label, predicted, (SELECT count(*) FROM s WHERE y = label AND (p > 0.5)::INT = predicted) AS value FROM c
""")
def confusion_matrix(spark, sf):
    return curves.confusion_matrix(curves.with_hard_label(scores(spark, sf), "p"), "y", "prediction")


@query("confusion_matrix_normalised", CELLS + """
SELECT label, predicted, round((SELECT count(*) FROM s WHERE y = label AND (p > 0.5)::INT = predicted)
                               / (SELECT count(*) FROM s WHERE y = label), 6) AS value FROM c
""")
def confusion_matrix_normalised(spark, sf):
    df = curves.with_hard_label(scores(spark, sf), "p")
    return rounded(curves.confusion_matrix(df, "y", "prediction", normalise=True), "value")


@query("calibration_points", ctes(s=SCORES) + """
SELECT grp, bin, count(*) AS n, round(avg(p), 6) AS mean_predicted, round(avg(y), 6) AS observed_rate
FROM (SELECT *, (SELECT count(*) FROM range(1, 10) t(i) WHERE p > i * 0.1::DOUBLE) AS bin FROM s) GROUP BY grp, bin
""")
def calibration_points(spark, sf):
    df = curves.calibration_points(scores(spark, sf), "y", "p", by=["grp"])
    return rounded(df, "mean_predicted", "observed_rate")


COEFFICIENTS = {"l_quantity": 0.25, "l_discount": -8.0, "l_tax": 12.5}
SHAP_SQL = """SELECT *, 0.25 * (l_quantity - avg(l_quantity) OVER ()) AS a, -8.0 * (l_discount - avg(l_discount) OVER ()) AS b,
  12.5 * (l_tax - avg(l_tax) OVER ()) AS c FROM lineitem"""


@query("linear_shapley", ctes(x=SHAP_SQL) + """
SELECT l_orderkey, l_linenumber, l_partkey, round(a, 5) AS s_quantity, round(b, 5) AS s_discount, round(c, 5) AS s_tax
FROM x WHERE greatest(abs(a), abs(b), abs(c)) < 5
""")
def linear_shapley(spark, sf):
    df = load(spark, sf, "lineitem")
    means = explain.feature_means(df, list(COEFFICIENTS))
    found = filters.without_extreme_rows(explain.linear_shapley(df, COEFFICIENTS, means), "shap", 5.0)
    names = ["s_quantity", "s_discount", "s_tax"]
    picked = [F.round(F.col("shap")[i], 5).alias(n) for i, n in enumerate(names)]
    return found.select("l_orderkey", "l_linenumber", "l_partkey", *picked)


@query("mean_abs_attribution", ctes(x=SHAP_SQL) + """
SELECT feature, round(avg(v), 6) AS mean_abs FROM (
  SELECT 'l_quantity' AS feature, abs(a) AS v FROM x UNION ALL SELECT 'l_discount', abs(b) FROM x
  UNION ALL SELECT 'l_tax', abs(c) FROM x) GROUP BY feature
""")
def mean_abs_attribution(spark, sf):
    df = load(spark, sf, "lineitem")
    features = list(COEFFICIENTS)
    shap = explain.linear_shapley(df, COEFFICIENTS, explain.feature_means(df, features))
    return rounded(explain.mean_abs_attribution(shap, features), "mean_abs")
