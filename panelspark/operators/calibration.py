"""Calibration of scores on held-out rows: sigmoid (two numbers) or isotonic (a step table)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators import isotonic

METHODS = ("sigmoid", "isotonic")


@dataclass(frozen=True)
class SigmoidCalibrator:
    """p = 1 / (1 + exp(-(slope · score + intercept)))."""

    slope: float
    intercept: float

    def apply(self, df: DataFrame, score_col: str, out_col: str = "p") -> DataFrame:
        logit = F.lit(self.slope) * F.col(score_col) + F.lit(self.intercept)
        return df.withColumn(out_col, F.lit(1.0) / (F.lit(1.0) + F.exp(-logit)))


@dataclass(frozen=True)
class IsotonicCalibrator:
    """Rising steps as a stored table, the cut values of its ranges, and the number of steps."""

    steps: DataFrame
    edges: list[float]
    n_steps: int

    def apply(self, df: DataFrame, score_col: str, out_col: str = "p") -> DataFrame:
        if self.n_steps <= isotonic.STEPS_SHIPPED:
            return isotonic.read_by_shipping(df, self.steps, score_col, out_col)
        return isotonic.read_by_ranges(df, self.steps, self.edges, score_col, out_col)


def smoothed_targets(n_positive: int, n_negative: int) -> tuple[float, float]:
    """Target of a positive and of a negative row, drawn in a little from 1 and 0."""
    return (n_positive + 1.0) / (n_positive + 2.0), 1.0 / (n_negative + 2.0)


def fit_sigmoid(df: DataFrame, score_col: str, label_col: str) -> SigmoidCalibrator:
    """Logistic fit to smoothed targets: every row counts for both classes with its share.

    Rows with equal score and label are summed first; the fit sees their weight.
    """
    counts = df.agg(F.count_if(F.col(label_col) == 1).alias("pos"), F.count_if(F.col(label_col) == 0).alias("neg")).first()
    high, low = smoothed_targets(counts["pos"], counts["neg"])
    target = F.when(F.col(label_col) == 1, F.lit(high)).otherwise(F.lit(low))
    both = F.array(
        F.struct(F.lit(1.0).alias("label"), target.alias("share")),
        F.struct(F.lit(0.0).alias("label"), (F.lit(1.0) - target).alias("share")),
    )
    weighted = (
        df.filter(F.col(label_col).isNotNull())
        .select(F.col(score_col).cast("double").alias("score"), F.inline(both))
        .groupBy("score", "label")
        .agg(F.sum("share").alias("weight"))
        .withColumn("features", array_to_vector(F.array("score")))
    )
    fitted = LogisticRegression(weightCol="weight", regParam=0.0, maxIter=200, tol=1e-10).fit(weighted)
    return SigmoidCalibrator(float(fitted.coefficients[0]), float(fitted.intercept))


def fit_isotonic(df: DataFrame, score_col: str, label_col: str) -> IsotonicCalibrator:
    """Non-decreasing fit over the distinct scores, each with its outcomes and weight. Rows without label or score are
    left out."""
    points = (
        df.filter(F.col(label_col).isNotNull() & F.col(score_col).isNotNull())
        .groupBy(F.col(score_col).cast("double").alias("score"))
        .agg(F.count(F.lit(1)).cast("double").alias("weight"), F.sum(F.col(label_col).cast("double")).alias("total"))
    )
    steps, edges = isotonic.fit_steps(points)
    return IsotonicCalibrator(steps, edges, steps.count())


def fit_calibrator(df: DataFrame, score_col: str, label_col: str, method: str = "sigmoid"):
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, not {method!r}")
    fit = fit_sigmoid if method == "sigmoid" else fit_isotonic
    return fit(df, score_col, label_col)
