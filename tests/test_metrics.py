import math
import random

import pytest
from pyspark.sql import functions as F

from panelspark.operators import curves, metrics

ROWS = [(0, 0.1), (0, 0.4), (1, 0.4), (1, 0.8), (0, 0.8), (1, 0.9), (0, 0.2), (1, 0.3), (0, 0.5)]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "y int, p double")


def auc(rows):
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def average_precision(rows):
    total, n_pos, last = 0.0, sum(y for y, _ in rows), 0.0
    for t in sorted({p for _, p in rows}, reverse=True):
        above = [y for y, p in rows if p >= t]
        total += (sum(above) / n_pos - last) * sum(above) / len(above)
        last = sum(above) / n_pos
    return total


def noisy(n=500, seed=3):
    rng = random.Random(seed)
    return [(y, round(min(1.0, max(0.0, rng.gauss(0.4 + 0.2 * y, 0.2))), 2)) for y in (rng.randrange(2) for _ in range(n))]


@pytest.mark.parametrize("rows", [ROWS, noisy()])
def test_all_metrics(spark, rows):
    found = metrics.evaluate(frame(spark, rows), "y", "p").first().asDict()
    hard = [(y, int(p > 0.5)) for y, p in rows]
    tp, fp, fn = (sum(h == pair for h in hard) for pair in ((1, 1), (0, 1), (1, 0)))
    eps = metrics.EPS
    clip = [(y, min(max(p, eps), 1 - eps)) for y, p in rows]
    n = len(rows)
    prevalence = sum(y for y, _ in rows) / n
    assert found == pytest.approx({
        "n": n, "n_left_out": 0,
        "log_loss_hard": sum(-math.log(eps if y != h else 1 - eps) for y, h in hard) / n,
        "log_loss": sum(-math.log(p if y else 1 - p) for y, p in clip) / n,
        "accuracy": sum(y == h for y, h in hard) / n,
        "precision": tp / (tp + fp), "recall": tp / (tp + fn), "f1": 2 * tp / (2 * tp + fp + fn),
        "prevalence": prevalence, "brier": sum((p - y) ** 2 for y, p in rows) / n,
        "roc_auc": auc(rows), "auprc": average_precision(rows), "auprc_lift": average_precision(rows) / prevalence,
    })


def test_rows_without_label_or_score_are_left_out(spark):
    rows = noisy(60)
    whole = metrics.evaluate(frame(spark, rows), "y", "p").first().asDict()
    holes = [(None, 0.9), (0, None), (1, None), (None, None)]
    found = metrics.evaluate(frame(spark, rows + holes), "y", "p").first().asDict()
    assert found == pytest.approx(whole | {"n_left_out": len(holes)})
    none = metrics.evaluate(frame(spark, holes), "y", "p").first()
    assert (none["n"], none["n_left_out"], none["log_loss"], none["roc_auc"]) == (0, 4, None, None)


def test_auc_equals_the_library_one(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = frame(spark, noisy())
    library = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="y", numBins=0).evaluate(df)
    assert metrics.ranking_metrics(df, "y", "p").first()["roc_auc"] == pytest.approx(library)


def test_auc_depends_on_order_only(spark):
    df = frame(spark, noisy())
    bent = df.withColumn("p", F.pow("p", 3) / 7)
    assert metrics.ranking_metrics(df, "y", "p").first() == metrics.ranking_metrics(bent, "y", "p").first()


def test_edge_cases(spark):
    only_negatives = metrics.evaluate(frame(spark, [(0, 0.2), (0, 0.3)]), "y", "p").first()
    assert only_negatives["roc_auc"] is None
    assert (only_negatives["precision"], only_negatives["recall"], only_negatives["f1"]) == (0.0, 0.0, 0.0)
    assert only_negatives["auprc_lift"] == 0.0
    certain = metrics.evaluate(frame(spark, [(0, 0.0), (1, 1.0)]), "y", "p").first()
    assert certain["log_loss"] == pytest.approx(0.0, abs=1e-12) and certain["roc_auc"] == 1.0


def test_groups_and_folds(spark):
    rows = [(f, y, p) for f in (0, 1, 2) for y, p in noisy(60, f)]
    df = spark.createDataFrame(rows, "fold int, y int, p double")
    found = {r["fold"]: r["roc_auc"] for r in metrics.evaluate(df, "y", "p", by=["fold"]).collect()}
    assert found == pytest.approx({f: auc(noisy(60, f)) for f in (0, 1, 2)})
    folds = metrics.evaluate(df, "y", "p", by=["fold"])
    assert metrics.median_over_folds(folds).first()["median_cv_roc_auc"] == pytest.approx(sorted(found.values())[1])


def test_recorded_names(spark):
    assert metrics.recorded_metrics(frame(spark), "y", "p").columns == list(metrics.TEST_METRICS)


def test_precision_recall_points(spark):
    found = curves.precision_recall_points(frame(spark), "y", "p").collect()
    mine = {(r["threshold"]): (r["precision"], r["recall"]) for r in found if r["class"] == "positive"}
    for t in {p for _, p in ROWS}:
        above = [y for y, p in ROWS if p >= t]
        assert mine[t] == pytest.approx((sum(above) / len(above), sum(above) / 4))
    assert mine[None] == (1.0, 0.0) and len(found) == 2 * (len({p for _, p in ROWS}) + 1)


def test_roc_points(spark):
    found = curves.roc_points(frame(spark), "y", "p").filter("class = 'positive'").collect()
    points = sorted((r["fpr"], r["tpr"]) for r in found)
    assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0)
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    assert area == pytest.approx(auc(ROWS))


def test_curve_summary(spark):
    found = {r["class"]: r for r in curves.curve_summary(frame(spark), "y", "p").collect()}
    assert found["positive"]["auprc"] == pytest.approx(average_precision(ROWS))
    flipped = [(1 - y, 1 - p) for y, p in ROWS]
    assert found["negative"]["auprc"] == pytest.approx(average_precision(flipped))
    assert found["negative"]["baseline"] == pytest.approx(5 / 9)


def test_confusion(spark):
    df = curves.with_hard_label(frame(spark), "p")
    found = {(r["label"], r["predicted"]): r["value"] for r in curves.confusion_matrix(df, "y", "prediction").collect()}
    assert found == {(0, 0): 4, (0, 1): 1, (1, 0): 2, (1, 1): 2}
    shares = {(r["label"], r["predicted"]): r["value"] for r in curves.confusion_matrix(df, "y", "prediction", True).collect()}
    assert shares == pytest.approx({(0, 0): 0.8, (0, 1): 0.2, (1, 0): 0.5, (1, 1): 0.5})


def test_calibration_bins_are_right_closed(spark):
    rows = [(0, 0.0), (1, 0.1), (0, 0.10001), (1, 0.2), (1, 1.0), (0, 0.95)]
    found = {r["bin"]: (r["n"], r["observed_rate"]) for r in curves.calibration_points(frame(spark, rows), "y", "p").collect()}
    assert found == {0: (2, 0.5), 1: (2, 0.5), 9: (2, 0.5)}
