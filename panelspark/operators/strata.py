"""Cuts in the hash order of any number of strata, as a table.

Every stratum asks for the rows at some ranks of its hash order. Rows are counted per stratum and leading bits of
the hash; a rank falls into one such range, and only rows of these ranges are looked at again, by the next bits,
until the ranges are small enough to be sorted. Hashes are even, so that a level of ``LEVEL_BITS`` leaves about a
4,096th of a stratum per rank, however large it is. The rows themselves meet the cuts in one join; strata that hold
a large share of them are salted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.hashing import HASH_BITS
from panelspark.operators.joins import find_hot, keyed_join
from panelspark.operators.ranking import POSITION, with_position
from panelspark.session import checkpointed

LEVEL_BITS = 12
SORTED_ROWS = 100_000
SALTS = 32


def _range(level: int) -> Column:
    """The leading bits of the hash that number the ranges of a level."""
    return F.shiftright("hash", max(0, HASH_BITS - LEVEL_BITS * level))


def rank_positions(df: DataFrame, stratum: str, keys: Sequence[str], seed: int, ends: DataFrame) -> DataFrame:
    """(stratum, cuts): for each of the 1-based ranks of ``ends`` (stratum, ends: array of ascending ranks) the place
    ``hash, key`` of the row there, rows of one key being together. A rank below 1 has no place, one beyond the last
    row has the place behind all rows.
    """
    rows = with_position(df.filter(F.col(stratum).isNotNull()), keys, seed).select(
        F.col(stratum).alias("name"), *(F.col(c).alias(n) for c, n in zip(POSITION, ("hash", "key"))), F.lit(1).cast("long").alias("w"))
    asked = ends.filter(F.col(stratum).isNotNull()).select(F.col(stratum).alias("name"), F.posexplode_outer("ends").alias("j", "rank"))
    asked = checkpointed(asked)
    # the ranges under way: the rows of their stratum before them, and the ranks that fall into them
    level, inside = 0, asked.groupBy("name").agg(F.collect_list(F.struct("j", "rank")).alias("ranks"))
    inside = inside.withColumns({"range": F.lit(0).cast("long"), "before": F.lit(0).cast("long")})
    while True:
        level += 1
        own = rows.select("name", _range(level - 1).alias("range") if level > 1 else F.lit(0).cast("long").alias("range"),
                          _range(level).alias("next"), "w")
        counted = own.groupBy("name", "range", "next").agg(F.sum("w").alias("n"))
        running = Window.partitionBy("name", "range").orderBy("next").rowsBetween(Window.unboundedPreceding, -1)
        counted = counted.withColumn("sum_before", F.coalesce(F.sum("n").over(running), F.lit(0)))
        found = counted.join(inside, ["name", "range"]).withColumn("before", F.col("before") + F.col("sum_before"))
        first, last = F.col("before"), F.col("before") + F.col("n")
        hit = F.filter("ranks", lambda r: (r["rank"] > first) & (r["rank"] <= last))
        inside = found.select("name", F.col("next").alias("range"), "before", "n", hit.alias("ranks")).filter(F.size("ranks") > 0)
        inside = checkpointed(inside)
        open_ranges = inside.select("name", "range")
        rows = rows.withColumn("range", _range(level)).join(open_ranges, ["name", "range"], "left_semi")
        rows = checkpointed(rows.groupBy("name", "hash", "key").agg(F.sum("w").alias("w")))
        largest = rows.groupBy("name", _range(level).alias("range")).count().agg(F.max("count")).first()[0] or 0
        if largest <= SORTED_ROWS or LEVEL_BITS * level >= HASH_BITS:
            break
        inside = inside.drop("n")
    running = Window.partitionBy("name", "range").orderBy("hash", "key").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("range", _range(level))
    placed = placed.withColumn("sum_before", F.coalesce(F.sum("w").over(running), F.lit(0))).join(inside, ["name", "range"])
    first = F.col("before") + F.col("sum_before")
    hit = F.filter("ranks", lambda r: (r["rank"] > first) & (r["rank"] <= first + F.col("w")))
    cuts = placed.select("name", "hash", "key", F.explode(hit).alias("r")).select("name", "r.j", F.struct("hash", "key").alias("cut"))
    behind = F.struct(F.lit(1 << HASH_BITS).cast("long").alias("hash"), F.lit("").alias("key"))
    cut = F.when(F.col("rank") >= 1, F.coalesce("cut", behind))
    numbered_cut = F.when(F.col("j").isNotNull(), F.struct("j", cut.alias("cut")))  # none where no rank is asked for
    listed = asked.join(cuts, ["name", "j"], "left").groupBy("name").agg(F.sort_array(F.collect_list(numbered_cut)).alias("cuts"))
    return listed.select(F.col("name").alias(stratum), F.transform("cuts", lambda c: c["cut"]).alias("cuts"))


def numbered(df: DataFrame, order: Sequence[Column], out_col: str) -> DataFrame:
    """``df`` (stored) with its row numbers from 0 in the given order: ranges are sorted by themselves, and one row per
    range tells the rows before it."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # the high bits of the id are the partition, the low ones the place in it
    placed = checkpointed(ordered.withColumn("_id", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_id", 33)))
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_range", (before - F.col("_first")).alias("_shift"))
    return placed.join(offsets, "_range").select(*df.columns, (F.col("_id") + F.col("_shift")).alias(out_col))


def interval_numbers(df: DataFrame, stratum: str, keys: Sequence[str], seed: int, ends: DataFrame, out_col: str) -> DataFrame:
    """``df`` with ``out_col``: how many of its stratum's ``ends`` (see :func:`rank_positions`) the row is behind in
    hash order; NULL for rows without stratum or of a stratum that is not in ``ends``."""
    cuts = checkpointed(rank_positions(df, stratum, keys, seed, ends)).withColumnRenamed("cuts", "_cuts")
    hot = find_hot(df, [stratum], min_rows=SORTED_ROWS)
    joined = keyed_join(with_position(df, keys, seed), [(cuts, "left")], [stratum], hot, SALTS)
    h, key = map(F.col, POSITION)
    passed = F.filter("_cuts", lambda c: c.isNull() | (h > c["hash"]) | ((h == c["hash"]) & (key > c["key"])))
    return joined.select(*df.columns, F.when(F.col("_cuts").isNotNull(), F.size(passed)).alias(out_col))
