"""Panel joins on composite keys, with protection against hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALT = "_salt"


def hot_keys(df: DataFrame, keys: Sequence[str], min_share: float = 0.01, fraction: float = 1.0,
             min_rows: int = 1, seed: int = 42) -> DataFrame:
    """Keys that hold at least ``min_share`` of the rows: (keys…). At most 1 / min_share of them.

    A key of fewer than ``min_rows`` rows seen is never hot. ``fraction`` below 1 looks at a part of the rows only. What is found decides how rows are
    spread over tasks, never which rows a join returns.
    """
    seen = df.select(*keys) if fraction >= 1.0 else df.select(*keys).sample(fraction, seed)
    counts = seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("n_total"))
    hot = (F.col("n") >= F.lit(min_share) * total.scalar()) & (F.col("n") >= min_rows)
    return counts.filter(hot).select(*keys)


def _matches_hot(keys: Sequence[str], hot: list[tuple]) -> Column:
    """True for rows of a hot key; NULL counts as a value of its own."""
    matches = [
        reduce(and_, [F.col(k).cast("string").eqNullSafe(F.lit(v)) for k, v in zip(keys, key)])
        for key in hot
    ]
    return reduce(or_, matches)


def find_hot(df: DataFrame, keys: Sequence[str], min_share: float = 0.01, fraction: float = 1.0,
             min_rows: int = 1) -> list[tuple]:
    """The hot keys as text tuples; a bounded list by construction."""
    rows = hot_keys(df, keys, min_share, fraction, min_rows).select(*[F.col(k).cast("string") for k in keys])
    return [tuple(row) for row in rows.collect()]


def salt_left(df: DataFrame, keys: Sequence[str], hot: list[tuple], salts: int) -> DataFrame:
    """Spread the rows of hot keys over ``salts`` sub-keys.

    The sub-key hashes the row and the partition it is read in, so full copies spread too and a
    task that is run again after a lost executor sends every row the same way.
    """
    plain = [F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    spread = F.pmod(F.xxhash64(*plain, F.spark_partition_id()), F.lit(salts))
    return df.withColumn(SALT, F.when(_matches_hot(keys, hot), spread).otherwise(F.lit(0).cast("long")))


def salt_right(df: DataFrame, keys: Sequence[str], hot: list[tuple], salts: int) -> DataFrame:
    """Repeat the rows of hot keys once per sub-key; all others stay single."""
    every = F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
    only = F.array(F.lit(0).cast("long"))
    return df.withColumn(SALT, F.explode(F.when(_matches_hot(keys, hot), every).otherwise(only)))


def keyed_join(left: DataFrame, rights: Sequence[tuple[DataFrame, str]], keys: Sequence[str],
               hot: list[tuple] | None = None, salts: int = 32) -> DataFrame:
    """Join one left table to several right ones on the same keys: [(right, how), …].

    Right columns that the left already has are dropped first, so names stay unambiguous and the
    left's value wins. All joins share one partitioning of the left. ``hot`` keys are salted;
    join types are ``inner`` and ``left``, the ones for which repeating right rows is exact.
    """
    for _, how in rights:
        if how not in ("inner", "left"):
            raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    on = list(keys)
    if hot:
        left = salt_left(left, keys, hot, salts)
        on.append(SALT)
    for right, how in rights:
        extra = [c for c in right.columns if c not in left.columns]
        right = right.select(*keys, *extra)
        if hot:
            right = salt_right(right, keys, hot, salts)
        left = left.join(right, on, how)
    return left.drop(SALT)


def rows_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > 1)
