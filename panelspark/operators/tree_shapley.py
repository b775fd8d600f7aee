"""Exact Shapley attributions of decision trees and their ensembles.

What a tree expects when only some features of a row are known follows its branches by the row where the feature is
known, and by the shares of training rows where it is not. A leaf's part of that depends on the features of its path
alone: each lets a row through or not, and has the product of its shares. Averaged over all orders of the features, the
part of feature f is

    value * (passes_f - share_f) * integral over t in [0, 1] of the product over the path's other features of
    (share * (1 - t) + passes * t)

and the integrand is a polynomial in t, so a few Gauss-Legendre points give it exactly. Rows stay whole: a batch of
vectors goes through all leaves in numpy, and no row is copied or shuffled. The values of a row and the expected value
add up to its score.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from panelspark.session import shared_folder

ROWS_AT_ONCE = 4096


@dataclass(frozen=True)
class Leaf:
    """A path: its features, the open lower and closed upper bound of each, the product of its shares, and the value."""

    features: tuple[int, ...]
    low: tuple[float, ...]
    high: tuple[float, ...]
    shares: tuple[float, ...]
    value: float


def leaves_of(nodes: Sequence[Row], value) -> list[Leaf]:
    """Leaves of one tree, given its nodes (``id, rawCount, leftChild, rightChild, split``)."""
    by_id = {n["id"]: n for n in nodes}
    found, waiting = [], [(by_id[0], {})]
    while waiting:
        node, path = waiting.pop()
        if node["leftChild"] < 0:
            names = sorted(path)
            found.append(Leaf(tuple(names), *(tuple(path[f][k] for f in names) for k in range(3)), float(value(node))))
            continue
        split = node["split"]
        if split["numCategories"] >= 0:
            raise ValueError("splits by sets of categories are not explained; use one-hot columns")
        f, cut = split["featureIndex"], split["leftCategoriesOrThreshold"][0]
        low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
        for child, bounds in ((node["leftChild"], (low, min(high, cut))), (node["rightChild"], (max(low, cut), high))):
            below = by_id[child]
            waiting.append((below, path | {f: (*bounds, share * below["rawCount"] / node["rawCount"])}))
    return found


def _share_of_one(node: Row) -> float:
    stats = node["impurityStats"]
    return stats[1] / sum(stats)


def model_leaves(spark: SparkSession, model) -> list[Leaf]:
    """Leaves of a fitted tree, forest (in the probability of class 1) or boosted trees (in the margin), read from the
    node table that the model is saved as. They are as many as those of the model, which the driver holds as well."""
    path = f"{shared_folder(spark)}/models/{uuid.uuid4().hex}"
    model.write().save(path)
    table = spark.read.parquet(f"{path}/data")
    if "treeID" not in table.columns:
        return leaves_of(table.collect(), _share_of_one)
    trees: dict[int, list[Row]] = {}
    for row in table.collect():
        trees.setdefault(row["treeID"], []).append(row["nodeData"])
    weights = list(model.treeWeights)
    if type(model).__name__.startswith("GBT"):
        return [leaf for i, nodes in trees.items() for leaf in leaves_of(nodes, lambda n, w=weights[i]: w * n["prediction"])]
    return [leaf for nodes in trees.values() for leaf in leaves_of(nodes, lambda n: _share_of_one(n) / len(trees))]


def expected_value(leaves: Sequence[Leaf]) -> float:
    """The score when no feature is known."""
    return float(sum(leaf.value * np.prod(leaf.shares) for leaf in leaves))


def attributed(x: np.ndarray, leaves: Sequence[Leaf]) -> np.ndarray:
    """Attributions of each row of ``x``, one column per feature."""
    out = np.zeros(x.shape)
    points: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for leaf in leaves:
        d = len(leaf.features)
        if not d:
            continue
        if d not in points:
            at, weight = np.polynomial.legendre.leggauss((d + 1) // 2)  # exact up to degree d
            points[d] = (at + 1) / 2, weight / 2
        at, weight = points[d]
        shares = np.array(leaf.shares)
        own = x[:, leaf.features]
        passes = ((own > np.array(leaf.low)) & (own <= np.array(leaf.high))).astype(float)
        factors = shares * (1 - at)[:, None, None] + passes * at[:, None, None]  # points, rows, features
        others = np.einsum("q,qr,qrf->rf", weight, factors.prod(2), 1.0 / factors)
        out[:, leaf.features] += leaf.value * (passes - shares) * others
    return out


def tree_shapley(df: DataFrame, vec_col: str, leaves: Sequence[Leaf], out_col: str = "shap") -> DataFrame:
    """``df`` with the attributions of the features in the array ``vec_col`` as an array. Null vectors get null."""
    shipped = df.sparkSession.sparkContext.broadcast(tuple(leaves))

    @F.pandas_udf("array<double>")
    def values(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            known = vectors[vectors.notna()]
            found = pd.Series([None] * len(vectors), index=vectors.index, dtype=object)
            for begin in range(0, len(known), ROWS_AT_ONCE):
                part = known.iloc[begin:begin + ROWS_AT_ONCE]
                for i, row in zip(part.index, attributed(np.stack(part.to_numpy()).astype(float), shipped.value)):
                    found[i] = row
            yield found

    return df.withColumn(out_col, values(vec_col))
