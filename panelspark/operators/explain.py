"""Shapley attributions: exact for linear models, sampled for any other."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.hashing import row_hash


def feature_means(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in features]).first()
    return {c: row[c] for c in features}


def linear_shapley(df: DataFrame, coefficients: Mapping[str, float], means: Mapping[str, float],
                   out_col: str = "shap") -> DataFrame:
    """Exact attributions of a linear model as an array, in the order of the coefficients."""
    parts = [F.lit(float(w)) * (F.col(c) - F.lit(float(means[c]))) for c, w in coefficients.items()]
    return df.withColumn(out_col, F.array(*parts))


def mean_abs_attribution(df: DataFrame, features: Sequence[str], shap_col: str = "shap") -> DataFrame:
    """(feature, mean_abs): the height of the bars in a summary plot."""
    row = df.agg(*[F.avg(F.abs(F.col(shap_col)[i])).alias(f"_{i}") for i in range(len(features))])
    listed = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"_{i}").alias("mean_abs")) for i, c in enumerate(features)
    ])
    return row.select(F.inline(listed))


def summarise(values: DataFrame, key: str, threshold: float) -> DataFrame:
    """(feature, mean_abs) of long attributions, without rows that reach ``threshold`` anywhere."""
    largest = values.groupBy(key).agg(F.max(F.abs("value")).alias("largest"))
    kept = largest.filter(F.col("largest") < threshold).select(key)
    return values.join(kept, key, "left_semi").groupBy("feature").agg(F.avg(F.abs("value")).alias("mean_abs"))


def sampled_shapley(df: DataFrame, key: Sequence[str], features: Sequence[str],
                    score: Callable[[DataFrame], DataFrame], means: Mapping[str, float],
                    n_permutations: int = 8, seed: int = 42, score_col: str = "p") -> DataFrame:
    """(key…, feature, value): mean change of the score over random feature orders.

    For every row and permutation the features are switched from their mean to the row's value
    one after another. The step that switches feature f, less the step before it, is its share.
    Rows are spread by key and permutation, so the work of one row is not tied to one task, and
    ``score`` sees plain feature columns.
    """
    d = len(features)
    order = F.array_sort(F.array(*[
        F.struct(row_hash([*key, "_perm"], seed * 1000 + j).alias("h"), F.lit(j).alias("j")) for j in range(d)
    ]))
    walks = (
        df.select(*key, *features)
        .withColumn("_perm", F.explode(F.sequence(F.lit(0), F.lit(n_permutations - 1))))
        .withColumn("_order", F.transform(order, lambda s: s["j"]))
        .withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(d))))
    )
    position = {c: F.array_position("_order", F.lit(j)) for j, c in enumerate(features)}
    switched = walks.select(
        *key, "_perm", "_step", "_order",
        *[
            F.when(position[c] <= F.col("_step"), F.col(c).cast("double")).otherwise(F.lit(float(means[c]))).alias(c)
            for c in features
        ],
    )
    scored = score(switched).select(*key, "_perm", "_step", "_order", F.col(score_col).alias("_p"))
    # each score is the end of one feature's step and the start of the next one's
    ends = F.struct(F.col("_order")[F.greatest(F.col("_step") - 1, F.lit(0))].alias("j"), F.col("_p").alias("part"))
    starts = F.struct(F.col("_order")[F.least(F.col("_step"), F.lit(d - 1))].alias("j"), (-F.col("_p")).alias("part"))
    both = (
        F.when(F.col("_step") == 0, F.array(starts))
        .when(F.col("_step") == d, F.array(ends))
        .otherwise(F.array(ends, starts))
    )
    names = F.array(*map(F.lit, features))
    return (
        scored.select(*key, F.inline(both))
        .groupBy(*key, "j")
        .agg((F.sum("part") / n_permutations).alias("value"))
        .select(*key, names[F.col("j")].alias("feature"), "value")
    )
