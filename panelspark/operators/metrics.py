"""Evaluation metrics of scored rows (label 0/1, probability, predicted label), per group or overall."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.operators.ranking import running_totals

# Fixed value: probabilities are clipped to [eps, 1 - eps] before a logarithm, eps of a double.
EPS = 2.220446049250313e-16


def hard_label(prob_col: str) -> Column:
    """The more likely class: 1 above one half."""
    return (F.col(prob_col) > 0.5).cast("int")


def _log_loss(y: Column, p: Column) -> Column:
    clipped = F.greatest(F.lit(EPS), F.least(F.lit(1 - EPS), p.cast("double")))
    cost = F.when(y == 1, F.log(clipped)).otherwise(F.log(F.lit(1.0) - clipped))
    return F.avg(F.when(y.isNotNull() & p.isNotNull(), -cost))


def _ratio(num: Column, den: Column) -> Column:
    """num / den, 0 where den is 0."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num / F.nullif(den, F.lit(0)))


def _pointwise(y: Column, p: Column, pred: Column) -> dict[str, Column]:
    """Metrics that need no order of the scores: one aggregate.

    A row counts if it has label, score and predicted label; the others are left out and counted.
    """
    whole = y.isNotNull() & p.isNotNull() & pred.isNotNull()
    y, p, pred = (F.when(whole, x) for x in (y, p, pred))
    tp, fp, fn = (
        F.count_if((y == 1) & (pred == 1)),
        F.count_if((y == 0) & (pred == 1)),
        F.count_if((y == 1) & (pred == 0)),
    )
    return {
        "n": F.count(y),
        "n_left_out": F.count(F.lit(1)) - F.count(y),
        "log_loss_hard": _log_loss(y, pred),
        "log_loss": _log_loss(y, p),
        "accuracy": F.avg((y == pred).cast("double")),
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        "prevalence": F.avg(y.cast("double")),
        "brier": F.avg(F.pow(p - y, F.lit(2.0))),
    }


def pointwise_metrics(df: DataFrame, label: str, prob: str, pred: str | None = None,
                      by: Sequence[str] = ()) -> DataFrame:
    predicted = F.col(pred) if pred else hard_label(prob)
    parts = _pointwise(F.col(label), F.col(prob), predicted)
    return df.groupBy(*by).agg(*[expr.alias(name) for name, expr in parts.items()])


def score_curve(df: DataFrame, label: str, prob: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score, best first: tp and fp at that threshold, and class totals.

    Rows without label or score are left out.
    """
    whole = df.where(F.col(label).isNotNull() & F.col(prob).isNotNull())
    flagged = whole.select(
        *by, F.col(prob).alias("score"),
        F.col(label).cast("long").alias("pos"), (1 - F.col(label)).cast("long").alias("neg"),
    )
    totals = running_totals(flagged, "score", ["pos", "neg"], by, descending=True)
    return totals.select(
        *by, "score", "pos", "neg",
        F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
        F.col("total_pos").alias("n_pos"), F.col("total_neg").alias("n_neg"),
    )


def ranking_metrics(df: DataFrame, label: str, prob: str, by: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC with ties at half, and average precision as the step sum.

    Both are plain sums over the score curve. AUC is NULL where a class is missing.
    """
    curve = score_curve(df, label, prob, by)
    pairs_won = F.col("pos") * (F.col("n_neg") - F.col("fp") + F.col("neg") / 2.0)
    step = F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))
    summed = curve.groupBy(*by).agg(
        F.sum(pairs_won).alias("won"), F.sum(step).alias("steps"),
        F.max("n_pos").alias("n_pos"), F.max("n_neg").alias("n_neg"),
    )
    both = F.nullif(F.col("n_pos") * F.col("n_neg"), F.lit(0))
    return summed.select(
        *by, (F.col("won") / both).alias("roc_auc"), _ratio(F.col("steps"), F.col("n_pos")).alias("auprc")
    )


def evaluate(df: DataFrame, label: str, prob: str, pred: str | None = None,
             by: Sequence[str] = ()) -> DataFrame:
    """All metrics, one row per group."""
    points = pointwise_metrics(df, label, prob, pred, by)
    ranks = ranking_metrics(df, label, prob, by)
    if not by:  # one row each
        points, ranks = points.withColumn("_row", F.lit(1)), ranks.withColumn("_row", F.lit(1))
    on = reduce(and_, [F.col(f"p.{c}").eqNullSafe(F.col(f"r.{c}")) for c in by or ["_row"]])
    names = [c for c in points.columns if c not in ("_row", *by)]
    return points.alias("p").join(ranks.alias("r"), on, "left").select(
        *[F.col(f"p.{c}").alias(c) for c in [*by, *names]],
        "roc_auc",
        "auprc",
        _ratio(F.col("auprc"), F.col("prevalence")).alias("auprc_lift"),
    )


# Names under which a test evaluation is recorded, and the metric each one takes.
TEST_METRICS = {
    "test_log_loss": "log_loss_hard",
    "test_precision": "precision",
    "test_recall": "recall",
    "test_f1": "f1",
    "test_roc_auc": "roc_auc",
    "test_auprc": "auprc",
    "test_auprc_baseline": "prevalence",
    "test_auprc_lift": "auprc_lift",
    "test_brier": "brier",
}

# The same for a cross-validation trial.
CV_METRICS = {
    "median_cv_log_loss": "log_loss_hard",
    "median_cv_accuracy": "accuracy",
    "median_cv_precision": "precision",
    "median_cv_recall": "recall",
    "median_cv_f1": "f1",
    "median_cv_roc_auc": "roc_auc",
    "median_cv_avg_precision": "auprc",
    "median_cv_response_rate": "prevalence",
    "median_cv_avg_precision_lift": "auprc_lift",
}


def recorded_metrics(df: DataFrame, label: str, prob: str, pred: str | None = None,
                 by: Sequence[str] = ()) -> DataFrame:
    """The nine test metrics under their recorded names."""
    found = evaluate(df, label, prob, pred, by)
    return found.select(*by, *[F.col(source).alias(name) for name, source in TEST_METRICS.items()])


def median_over_folds(fold_metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Median of each metric over the few folds of a trial."""
    return fold_metrics.groupBy(*by).agg(
        *[F.median(source).alias(name) for name, source in CV_METRICS.items()]
    )
