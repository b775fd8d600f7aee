"""Category levels: shares, and lumping of the rare ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators.joins import find_hot, keyed_join

OTHERS = "Others"
MAX_LITERAL_LEVELS = 1000
HOT_ROWS = 100_000


def level_shares(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, level, n, pct) for several columns in one pass.

    Rows are counted per level before the shuffle, so a level that holds most rows costs no
    more than a rare one. Rows without a level count in the total.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("level")) for c in cols
    ])
    counts = (
        df.select(F.inline(pairs)).groupBy("column_name", "level").agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counts.groupBy("column_name").agg(F.sum("n").alias("total"))
    # one row per listed column
    return counts.join(F.broadcast(totals), "column_name").select(
        "column_name", "level", "n", (F.lit(100.0) * F.col("n") / F.col("total")).alias("pct")
    )


def frequent_levels(df: DataFrame, cols: Sequence[str], min_pct: float) -> DataFrame:
    """The levels that are kept: (column_name, level). At most 100 / min_pct per column."""
    kept = level_shares(df, cols).filter((F.col("pct") >= min_pct) & F.col("level").isNotNull())
    return kept.select("column_name", "level")


def fit_levels(df: DataFrame, cols: Sequence[str], min_pct: float) -> dict[str, list] | DataFrame:
    """The kept levels as literals, or as a table where ``min_pct`` allows too many of them."""
    kept = frequent_levels(df, cols, min_pct)
    if min_pct <= 0 or 100.0 / min_pct > MAX_LITERAL_LEVELS:
        return kept
    levels = {c: [] for c in cols}
    for row in kept.collect():
        levels[row["column_name"]].append(row["level"])
    return {c: sorted(values) for c, values in levels.items()}


def lump_levels(df: DataFrame, levels: dict[str, list] | DataFrame, cols: Sequence[str],
                other: str = OTHERS) -> DataFrame:
    """Replace every level that is not kept by ``other``. NULL stays NULL."""
    if isinstance(levels, dict):
        def lumped(c: str):
            value = F.col(c)
            rare = ~value.isin(*levels[c]) if levels[c] else value.isNotNull()
            return F.when(rare, F.lit(other)).otherwise(value)
        return df.withColumns({c: lumped(c) for c in cols})
    order = df.columns
    for c in cols:
        kept = levels.filter(F.col("column_name") == c).select(F.col("level").alias("_level"), F.lit(True).alias("_kept"))
        keyed = df.withColumn("_level", F.col(c).cast("string"))
        # what is looked up is frequent, so the levels of many rows, and rows without one, are salted
        hot = find_hot(keyed, ["_level"], min_rows=HOT_ROWS)
        df = keyed_join(keyed, [(kept, "left")], ["_level"], hot).withColumn(
            c, F.when(F.col(c).isNotNull() & F.col("_kept").isNull(), F.lit(other)).otherwise(F.col(c))
        ).select(*order)
    return df


def combine_rare_levels(df: DataFrame, cols: Sequence[str], min_pct: float,
                        fit_on: DataFrame | None = None) -> DataFrame:
    """Lump the levels below ``min_pct`` percent of the rows of ``fit_on`` (default: ``df``)."""
    return lump_levels(df, fit_levels(df if fit_on is None else fit_on, cols, min_pct), cols)
