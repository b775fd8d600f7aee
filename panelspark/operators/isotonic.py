"""Isotonic fits of any number of points, without gathering them.

Distinct scores are cut into ranges of bounded size, and neighbours that fall are pooled within each range. What is left
of a range is a rising stack of blocks. Two neighbouring stacks merge where they meet: the end of the one and the start
of the other are pooled into one block at most, and all other blocks stay where they are. A level of merges joins
pairs of ranges, the next level pairs of these, and so on; a merge looks at ``BLOCKS_AT_ONCE`` blocks on either side
and goes on while all of one side were pooled. No task and no driver holds more, however the blocks fall.

The fit is a table of steps. It is read as by interpolation: constant over a step, straight between two, and constant
beyond the first and the last.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.session import checkpointed

POINTS_PER_RANGE = 100_000
BLOCKS_AT_ONCE = 10_000
STEPS_SHIPPED = 200_000
BLOCK = "range long, low double, high double, weight double, total double"
NAMES = ["range", "low", "high", "weight", "total"]


def pooled(low: np.ndarray, high: np.ndarray, weight: np.ndarray, total: np.ndarray) -> pd.DataFrame:
    """Blocks in order, with neighbours whose means fall pooled until all rise."""
    stack: list[list[float]] = []
    for block in zip(low.tolist(), high.tolist(), weight.tolist(), total.tolist()):
        lo, hi, w, t = block
        while stack and stack[-1][3] * w >= t * stack[-1][2]:
            lo, _, w2, t2 = stack.pop()
            w, t = w + w2, t + t2
        stack.append([lo, hi, w, t])
    return pd.DataFrame(stack, columns=NAMES[1:], dtype=float)


def range_edges(points: DataFrame, per_range: int) -> list[float]:
    """Cut values between ranges of about ``per_range`` points; few where points are few."""
    n = points.count()
    parts = math.ceil(n / per_range)
    if parts <= 1:
        return []
    shares = [i / parts for i in range(1, parts)]
    return sorted(set(points.agg(F.percentile_approx("score", shares, 20 * parts)).first()[0]))


def in_ranges(df: DataFrame, score: str, edges: list[float], out: str = "range") -> DataFrame:
    """``df`` with the number of each score's range, found by binary search."""
    if not edges:
        return df.withColumn(out, F.lit(0).cast("long"))
    cut = Bucketizer(splits=[-math.inf, *edges, math.inf], inputCol=score, outputCol="_range", handleInvalid="keep")
    return cut.transform(df).withColumn(out, F.col("_range").cast("long")).drop("_range")


def _pool_ranges(points: DataFrame) -> DataFrame:
    def pool(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("score")
        out = pooled(rows["score"].to_numpy(), rows["score"].to_numpy(), rows["weight"].to_numpy(), rows["total"].to_numpy())
        out.insert(0, "range", rows["range"].iloc[0])
        return out

    return points.groupBy("range").applyInPandas(pool, BLOCK)


def _merges(blocks: DataFrame, level: int, at_once: int) -> DataFrame:
    """(pair, low, high, weight, total, go_on): the block in which two stacks meet, for pairs that pool any."""
    half, pair = F.shiftright("range", level) % 2, F.shiftright("range", level + 1)
    sides = blocks.withColumns({"pair": pair, "right": half == 1})
    order = F.when(F.col("right"), F.col("low")).otherwise(-F.col("low"))
    near = sides.withColumn("_near", F.row_number().over(Window.partitionBy("pair", "right").orderBy(order)))
    near = near.filter(F.col("_near") <= at_once).select("pair", "right", *NAMES[1:])

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("low")
        right = rows["right"].to_numpy()
        found = pooled(*(rows[c].to_numpy() for c in NAMES[1:]))
        held = np.diff(np.append(np.searchsorted(rows["low"], found["low"]), len(rows)))
        out = found[held > 1].assign(pair=rows["pair"].iloc[0], go_on=False)
        if len(out):  # a side of which all that was seen was pooled may have more
            low, high = out["low"].iloc[0], out["high"].iloc[0]
            out["go_on"] = bool(((~right).sum() == at_once and low == rows["low"].min()) or (right.sum() == at_once and high == rows["high"].max()))
        return out[["pair", *NAMES[1:], "go_on"]]

    return near.groupBy("pair").applyInPandas(meet, "pair long, low double, high double, weight double, total double, go_on boolean")


def fit_steps(points: DataFrame, per_range: int = POINTS_PER_RANGE, at_once: int = BLOCKS_AT_ONCE) -> tuple[DataFrame, list[float]]:
    """(range, low, high, weight, total) of the rising steps over points (score, weight, total), one per score, as a stored
    table, and the values at which ranges are cut."""
    points = checkpointed(points)
    edges = range_edges(points, per_range)
    blocks = checkpointed(_pool_ranges(in_ranges(points, "score", edges)))
    for level in range(math.ceil(math.log2(len(edges) + 1)) if edges else 0):
        while True:
            met = checkpointed(_merges(blocks, level, at_once))
            found = met.agg(F.count(F.lit(1)).alias("n"), F.count_if("go_on").alias("more")).first()
            if not found["n"]:
                break
            # one row a pair of ranges at most
            merged = met.select("pair", F.col("low").alias("_low"), F.col("high").alias("_high"))
            beside = blocks.withColumn("pair", F.shiftright("range", level + 1)).join(merged, "pair", "left")
            apart = F.col("_low").isNull() | (F.col("high") < F.col("_low")) | (F.col("low") > F.col("_high"))
            blocks = checkpointed(beside.filter(apart).select(*NAMES).unionByName(in_ranges(met, "low", edges).select(*NAMES)))
            if not found["more"]:
                break
    return blocks, edges


def interpolated(score: Column, before: Column, after: Column) -> Column:
    """The value at a score between the last step that begins at or before it and the first step after."""
    width = after["low"] - before["high"]
    between = before["mean"] + (after["mean"] - before["mean"]) * (score - before["high"]) / width
    return (
        F.when(score.isNull(), F.lit(None).cast("double"))
        .when(before.isNull(), after["mean"])
        .when(after.isNull() | (score <= before["high"]), before["mean"])
        .otherwise(between)
    )


def read_by_shipping(df: DataFrame, steps: DataFrame, score: str, out: str) -> DataFrame:
    """The fit at each score; the steps, at most ``STEPS_SHIPPED``, go to every task."""
    table = steps.select("low", "high", (F.col("total") / F.col("weight")).alias("mean")).toPandas().sort_values("low")
    if table.empty:
        return df.withColumn(out, F.lit(None).cast("double"))
    xs = np.stack([table["low"], table["high"]], 1).ravel()
    ys = np.repeat(table["mean"].to_numpy(), 2)
    shipped = df.sparkSession.sparkContext.broadcast((xs, ys))

    @F.pandas_udf("double")
    def fitted(scores: pd.Series) -> pd.Series:
        return pd.Series(np.interp(scores, *shipped.value))

    value = fitted(F.col(score).cast("double"))
    return df.withColumn(out, F.when(F.col(score).isNotNull(), value))


def read_by_ranges(df: DataFrame, steps: DataFrame, edges: list[float], score: str, out: str) -> DataFrame:
    """The same for any number of steps: scores and steps meet in their ranges, in order. Equal scores are looked up once."""
    step = F.struct("low", "high", (F.col("total") / F.col("weight")).alias("mean"))
    listed = steps.select("range", F.col("low").alias("x"), step.alias("step"))
    ends = listed.groupBy("range").agg(F.min("step").alias("first"), F.max("step").alias("last"))
    every = steps.sparkSession.range(len(edges) + 1).select(F.col("id").alias("range")).join(ends, "range", "left")
    order = Window.orderBy("range")  # one row a range
    around = every.select(
        "range", F.last("last", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.first("first", ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("_after"))
    asked = df.select(F.col(score).cast("double").alias("x")).filter("x IS NOT NULL").distinct()
    rows = in_ranges(asked, "x", edges).withColumn("step", F.lit(None).cast(listed.schema["step"].dataType))
    rows = rows.select("range", "x", "step", F.lit(True).alias("asked")).unionByName(listed.withColumn("asked", F.lit(False)))
    place = Window.partitionBy("range").orderBy("x", "asked")
    rows = rows.withColumns({
        "before": F.last("step", ignorenulls=True).over(place.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "after": F.first("step", ignorenulls=True).over(place.rowsBetween(1, Window.unboundedFollowing)),
    }).filter("asked").join(around, "range")
    value = interpolated(F.col("x"), F.coalesce("before", "_before"), F.coalesce("after", "_after"))
    fitted = rows.select(F.col("x").alias("_x"), value.alias("_value"))
    found = df.join(fitted, F.col(score).cast("double") == F.col("_x"), "left")
    return found.select(*[F.col(c) for c in df.columns if c != out], F.col("_value").alias(out))
