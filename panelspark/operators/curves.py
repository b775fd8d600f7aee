"""The tables behind the evaluation plots. Curves hold every distinct score as a point."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators.metrics import evaluate, hard_label, score_curve

# Class names in plots.
CLASS_NAMES = {0: "negative", 1: "positive"}

N_CALIBRATION_BINS = 10


def per_class(df: DataFrame, label: str, prob: str, by: Sequence[str] = ()) -> DataFrame:
    """Each row once per class, with that class as the positive one: (by…, class, y, p)."""
    y, p = F.col(label), F.col(prob).cast("double")
    views = F.array(
        F.struct(F.lit(CLASS_NAMES[0]).alias("class"), (1 - y).cast("int").alias("y"), (F.lit(1.0) - p).alias("p")),
        F.struct(F.lit(CLASS_NAMES[1]).alias("class"), y.cast("int").alias("y"), p.alias("p")),
    )
    return df.select(*by, F.inline(views))


def precision_recall_points(df: DataFrame, label: str, prob: str, by: Sequence[str] = ()) -> DataFrame:
    """(by…, class, threshold, precision, recall), with the closing point (1, 0) per class.

    Recall is 1 throughout for a class without rows of its own.
    """
    keys = [*by, "class"]
    curve = score_curve(per_class(df, label, prob, by), "y", "p", keys)
    point = F.struct(
        F.col("score").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.when(F.col("n_pos") == 0, F.lit(1.0)).otherwise(F.col("tp") / F.nullif(F.col("n_pos"), F.lit(0))).alias("recall"),
    )
    closing = F.struct(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    # the best score of a class is the one whose counts start from nothing
    is_first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    return curve.select(*keys, F.inline(F.when(is_first, F.array(point, closing)).otherwise(F.array(point))))


def roc_points(df: DataFrame, label: str, prob: str, by: Sequence[str] = ()) -> DataFrame:
    """(by…, class, threshold, fpr, tpr), with the opening point (0, 0) per class."""
    keys = [*by, "class"]
    curve = score_curve(per_class(df, label, prob, by), "y", "p", keys)
    point = F.struct(
        F.col("score").alias("threshold"),
        (F.col("fp") / F.nullif(F.col("n_neg"), F.lit(0))).alias("fpr"),
        (F.col("tp") / F.nullif(F.col("n_pos"), F.lit(0))).alias("tpr"),
    )
    opening = F.struct(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    is_first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    return curve.select(*keys, F.inline(F.when(is_first, F.array(opening, point)).otherwise(F.array(point))))


def curve_summary(df: DataFrame, label: str, prob: str, by: Sequence[str] = ()) -> DataFrame:
    """Per class: area under both curves, and the prevalence a random score would reach."""
    found = evaluate(per_class(df, label, prob, by), "y", "p", by=[*by, "class"])
    return found.select(*by, "class", "roc_auc", "auprc", F.col("prevalence").alias("baseline"))


def confusion_matrix(df: DataFrame, label: str, pred: str, normalise: bool = False) -> DataFrame:
    """(label, predicted, value): all four cells; ``normalise`` divides by the true class's rows."""
    cells = [(y, p) for y in (0, 1) for p in (0, 1)]
    counted = df.agg(*[
        F.count_if((F.col(label) == y) & (F.col(pred) == p)).alias(f"_{y}{p}") for y, p in cells
    ])

    def value(y: int, p: int):
        if not normalise:
            return F.col(f"_{y}{p}")
        return F.col(f"_{y}{p}") / F.nullif(F.col(f"_{y}0") + F.col(f"_{y}1"), F.lit(0))

    rows = F.array(*[
        F.struct(F.lit(y).alias("label"), F.lit(p).alias("predicted"), value(y, p).alias("value"))
        for y, p in cells
    ])
    return counted.select(F.inline(rows))


def calibration_points(df: DataFrame, label: str, prob: str, n_bins: int = N_CALIBRATION_BINS,
                       by: Sequence[str] = ()) -> DataFrame:
    """(by…, bin, n, mean_predicted, observed_rate) over equal-width, right-closed bins.

    Bins without rows are left out. The first bin also holds a probability of 0.
    """
    step = 1.0 / n_bins
    p = F.col(prob)
    bin_no = sum([F.when(p > F.lit(i * step), 1).otherwise(0) for i in range(1, n_bins)], F.lit(0))
    return df.groupBy(*by, bin_no.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(p).alias("mean_predicted"),
        F.avg(F.col(label).cast("double")).alias("observed_rate"),
    )


def with_hard_label(df: DataFrame, prob: str, pred: str = "prediction") -> DataFrame:
    return df.withColumn(pred, hard_label(prob))
