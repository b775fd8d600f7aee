"""Oversampling of the minority class with synthetic rows between neighbours.

Tables hold ``row_key`` (text), a label and a vector as array<double>. How many rows a seed
yields, which neighbour each one takes and how far it lies between them follow from hashes of the
seed's key, so a run can be repeated and a lost task gives the same rows again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.hashing import row_hash, row_uniform
from panelspark.operators.joins import find_hot, keyed_join
from panelspark.operators.neighbors import nearest
from panelspark.operators.ranking import POSITION, at_or_before, hash_cuts, with_position
from panelspark.operators.sampling import class_counts, minority_and_majority
from panelspark.session import checkpointed

KEY = "row_key"
COPIES_PER_BLOCK = 10_000
HOT_NEIGHBOUR_ROWS = 10_000
FEW_SEEDS = 50_000


@dataclass(frozen=True)
class Neighbourhoods:
    """The ``k`` nearest of each minority row, among the minority and among all rows, as stored tables."""

    k: int
    minority: DataFrame
    every: DataFrame


def rows_to_add(counts: dict, ratio: float) -> int:
    """Synthetic rows needed for minority / majority = ``ratio``."""
    minority, majority = minority_and_majority(counts)
    wanted = int(counts[majority] * ratio - counts[minority])
    if wanted < 0:
        raise ValueError(
            f"minority / majority is {counts[minority] / counts[majority]:.3f} already; "
            f"a ratio of {ratio} cannot be reached by adding minority rows"
        )
    return wanted


def _even_copies(seeds: DataFrame, n_seeds: int, total: int, seed: int) -> DataFrame:
    """``copies`` per seed: as equal as can be, the remainder to the first seeds in hash order."""
    each, extra = divmod(total, n_seeds)
    if extra and n_seeds <= FEW_SEEDS:
        cut = tuple(with_position(seeds, [KEY], seed).select(*POSITION).orderBy(*POSITION).offset(extra - 1).limit(1).first())
    else:
        cut = hash_cuts(seeds.withColumn("_all", F.lit(1)), [KEY], seed, {1: [extra]}, "_all")[1][0] if extra else None
    copies = F.lit(each) + at_or_before(cut).cast("int")
    return with_position(seeds, [KEY], seed).withColumn("copies", copies).drop(*POSITION)


def _interpolate(seeds: DataFrame, minority: DataFrame, neighbours: DataFrame, k: int, label, label_col: str,
                 vec_col: str, seed: int, most_copies: int, n_minority: int) -> DataFrame:
    """One row per copy: seed + u · (neighbour - seed) with u in [0, 1).

    The k neighbour vectors are put beside each seed before copies are made, so copies of one
    seed never meet in a join.
    """
    vectors = minority.select(F.col(KEY).alias("neighbor_id"), F.col(vec_col).alias("_nvec"))
    beside = (
        _beside_neighbour(neighbours.filter(F.col("rank") <= k), vectors, n_minority * k)
        .groupBy(F.col("query_id").alias(KEY))
        .agg(F.sort_array(F.collect_list(F.struct("rank", "_nvec"))).alias("_near"))
    )
    ready = seeds.filter(F.col("copies") > 0).select(KEY, vec_col, "copies").join(beside, KEY)
    last_block = F.expr(f"(copies - 1) div {COPIES_PER_BLOCK}")
    blocks = ready.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last_block)))
    if most_copies > COPIES_PER_BLOCK:
        blocks = blocks.repartition(KEY, "_block")
    start = F.col("_block") * COPIES_PER_BLOCK
    numbers = F.sequence(start + 1, F.least(F.col("copies").cast("long"), start + COPIES_PER_BLOCK))
    copies = blocks.withColumn("_copy", F.explode(numbers))
    pick = F.pmod(row_hash([KEY, "_copy"], seed), F.size("_near")).cast("int")
    drawn = copies.withColumns({
        "_other": F.col("_near")[pick]["_nvec"],
        "_u": row_uniform([KEY, "_copy"], seed + 1),
    })
    between = F.zip_with(vec_col, "_other", lambda x, y: x + F.col("_u") * (y - x))
    return drawn.select(
        F.concat_ws("#", KEY, "_copy").alias(KEY), F.lit(label).alias(label_col), between.alias(vec_col),
        F.lit(True).alias("synthetic"),
    )


def _original(df: DataFrame, label_col: str, vec_col: str) -> DataFrame:
    return df.select(KEY, label_col, vec_col, F.lit(False).alias("synthetic"))


def _beside_neighbour(neighbours: DataFrame, values: DataFrame, most_rows: int) -> DataFrame:
    """Values of a neighbour beside each row of a stored neighbour table. All copies of a vector name the same few
    ids, and some vectors are near very many; such ids are salted. A table of few rows (``most_rows``) has none."""
    hot = find_hot(neighbours, ["neighbor_id"], min_rows=HOT_NEIGHBOUR_ROWS) if most_rows >= HOT_NEIGHBOUR_ROWS else []
    return keyed_join(neighbours, [(values, "inner")], ["neighbor_id"], hot)


def neighbourhoods(df: DataFrame, label_col: str, vec_col: str, k: int = 10) -> Neighbourhoods:
    """Both neighbour tables of a table of vectors, searched once and stored for any number of samplers."""
    label, _ = minority_and_majority(class_counts(df, label_col))
    minority = df.filter(F.col(label_col) == F.lit(label))
    return Neighbourhoods(
        k, checkpointed(nearest(minority, minority, k, KEY, vec_col)), checkpointed(nearest(minority, df, k, KEY, vec_col)))


def _among_minority(minority: DataFrame, queries: DataFrame, vec_col: str, k: int, ready: Neighbourhoods | None) -> DataFrame:
    if ready is None or ready.k < k:
        return checkpointed(nearest(queries, minority, k, KEY, vec_col))
    return ready.minority.join(queries.select(F.col(KEY).alias("query_id")), "query_id", "left_semi")


def _among_all(minority: DataFrame, df: DataFrame, vec_col: str, k: int, ready: Neighbourhoods | None) -> DataFrame:
    if ready is None or ready.k < k:
        return checkpointed(nearest(minority, df, k, KEY, vec_col))
    return ready.every.filter(F.col("rank") <= k)


def _majority_among(neighbours: DataFrame, df: DataFrame, majority, label_col: str, most_rows: int) -> DataFrame:
    """(row_key, n_majority): majority rows among each query's neighbours."""
    labels = df.select(F.col(KEY).alias("neighbor_id"), (F.col(label_col) == F.lit(majority)).alias("_maj"))
    joined = _beside_neighbour(neighbours, labels, most_rows)
    return joined.groupBy(F.col("query_id").alias(KEY)).agg(F.count_if("_maj").alias("n_majority"))


def _check_k(k: int, n: int) -> None:
    if n <= k:
        raise ValueError(f"{k} neighbours need more than {k} minority rows, found {n}")


def smote(df: DataFrame, label_col: str, vec_col: str, ratio: float = 0.1, k: int = 5, seed: int = 42,
          ready: Neighbourhoods | None = None) -> DataFrame:
    """All rows and enough synthetic minority rows; every minority row is a seed.

    ``ready`` may hold the neighbour tables of the same rows, here and in the other samplers.
    """
    counts = class_counts(df, label_col)
    total = rows_to_add(counts, ratio)
    if total == 0:
        return _original(df, label_col, vec_col)
    label, _ = minority_and_majority(counts)
    _check_k(k, counts[label])
    minority = df.filter(F.col(label_col) == F.lit(label))
    neighbours = ready.minority if ready and ready.k >= k else checkpointed(nearest(minority, minority, k, KEY, vec_col))
    seeds = _even_copies(minority, counts[label], total, seed)
    most = -(-total // counts[label])
    made = _interpolate(seeds, minority, neighbours, k, label, label_col, vec_col, seed, most, counts[label])
    return _original(df, label_col, vec_col).unionByName(made)


def in_danger(df: DataFrame, label_col: str, vec_col: str, m: int = 10, ready: Neighbourhoods | None = None,
              counts: dict | None = None) -> DataFrame:
    """(row_key, n_majority) of minority rows with half or more, but not all, of m neighbours majority. ``counts`` are the
    rows per class where they are known, here and below."""
    counts = counts or class_counts(df, label_col)
    label, majority = minority_and_majority(counts)
    minority = df.filter(F.col(label_col) == F.lit(label))
    near = _majority_among(_among_all(minority, df, vec_col, m, ready), df, majority, label_col, counts[label] * m)
    return near.filter((F.col("n_majority") >= m / 2) & (F.col("n_majority") < m))


def borderline_smote(df: DataFrame, label_col: str, vec_col: str, ratio: float = 0.1, k: int = 5, m: int = 10,
                     seed: int = 42, ready: Neighbourhoods | None = None) -> DataFrame:
    """As SMOTE, but only minority rows near the border are seeds. Without any, nothing is added."""
    counts = class_counts(df, label_col)
    total = rows_to_add(counts, ratio)
    if total == 0:
        return _original(df, label_col, vec_col)
    label, _ = minority_and_majority(counts)
    _check_k(k, counts[label])
    minority = df.filter(F.col(label_col) == F.lit(label))
    danger = in_danger(df, label_col, vec_col, m, ready, counts).select(KEY)
    seeds = checkpointed(minority.join(danger, KEY, "left_semi"))
    n_seeds = seeds.count()
    if n_seeds == 0:
        return _original(df, label_col, vec_col)
    copied = _even_copies(seeds, n_seeds, total, seed)
    neighbours = _among_minority(minority, seeds, vec_col, k, ready)
    made = _interpolate(copied, minority, neighbours, k, label, label_col, vec_col, seed, -(-total // n_seeds), n_seeds)
    return _original(df, label_col, vec_col).unionByName(made)


def adasyn_copies(df: DataFrame, label_col: str, vec_col: str, total: int, k: int = 5,
                  ready: Neighbourhoods | None = None, counts: dict | None = None) -> DataFrame:
    """(row_key, copies): shares of ``total`` by how many of k neighbours are majority rows."""
    counts = counts or class_counts(df, label_col)
    label, majority = minority_and_majority(counts)
    minority = df.filter(F.col(label_col) == F.lit(label))
    near = _majority_among(_among_all(minority, df, vec_col, k, ready), df, majority, label_col, counts[label] * k)
    near = checkpointed(near)
    n_hard = near.agg(F.sum("n_majority").alias("n")).first()["n"]
    if not n_hard:
        raise ValueError("no minority row has a majority neighbour; use plain SMOTE instead")
    share: Column = F.col("n_majority") / F.lit(float(n_hard))
    return near.select(KEY, F.rint(share * total).cast("int").alias("copies"))


def adasyn(df: DataFrame, label_col: str, vec_col: str, ratio: float = 0.1, k: int = 5, seed: int = 42,
           ready: Neighbourhoods | None = None) -> DataFrame:
    """Synthetic rows where the minority is hardest to tell apart. Their number is rounded per seed."""
    counts = class_counts(df, label_col)
    total = rows_to_add(counts, ratio)
    if total == 0:
        return _original(df, label_col, vec_col)
    label, _ = minority_and_majority(counts)
    _check_k(k, counts[label])
    minority = df.filter(F.col(label_col) == F.lit(label))
    seeds = minority.join(adasyn_copies(df, label_col, vec_col, total, k, ready, counts), KEY)
    neighbours = _among_minority(minority, minority, vec_col, k, ready)
    # a seed can get no more than k times the average share
    made = _interpolate(seeds, minority, neighbours, k, label, label_col, vec_col, seed, total, counts[label])
    return _original(df, label_col, vec_col).unionByName(made)


SAMPLERS: dict[str, Callable] = {"SMOTE": smote, "BorderlineSMOTE": borderline_smote, "ADASYN": adasyn}

# Names of the samplers' settings in a search, and the argument each one sets.
SAMPLER_ARGUMENTS = {
    "SMOTE": {"k_neighbors": "k"},
    "BorderlineSMOTE": {"k_neighbors": "k", "m_neighbors": "m"},
    "ADASYN": {"n_neighbors": "k"},
}


def oversample(df: DataFrame, name: str, params: dict, label_col: str, vec_col: str, ratio: float,
               seed: int = 42, ready: Neighbourhoods | None = None) -> DataFrame:
    """Apply a sampler by name, with settings under their search names."""
    if name not in SAMPLERS:
        raise ValueError(f"sampler must be one of {sorted(SAMPLERS)}, not {name!r}")
    arguments = {SAMPLER_ARGUMENTS[name][p]: int(float(v)) for p, v in params.items()}
    return SAMPLERS[name](df, label_col, vec_col, ratio, seed=seed, ready=ready, **arguments)
