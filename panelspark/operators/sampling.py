"""Seeded, repeatable sampling: class down-sampling, stratified splits and folds.

All of them follow the order of a portable row hash. Exact counts come from cut points in that
order, so the sampled table itself is only filtered or labelled, never shuffled or sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.hashing import row_uniform
from panelspark.operators import strata
from panelspark.operators.ranking import POSITION, at_or_before, hash_cuts, with_position

#: up to so many strata the cuts are part of the plan, for more they are a table; the rows are the same
MAX_STRATA = 1000


def class_count_table(df: DataFrame, *label_cols: str) -> DataFrame:
    """(label…, n): rows per class."""
    return df.groupBy(*label_cols).agg(F.count(F.lit(1)).alias("n"))


def few_class_counts(df: DataFrame, label_col: str) -> dict | None:
    """Rows per class, or None for more than ``MAX_STRATA`` classes, which are not for the driver."""
    rows = class_count_table(df, label_col).limit(MAX_STRATA + 1).collect()
    return {r[label_col]: r["n"] for r in rows if r[label_col] is not None} if len(rows) <= MAX_STRATA else None


def class_counts(df: DataFrame, label_col: str) -> dict:
    """Rows per class of an outcome; more than ``MAX_STRATA`` classes are taken for a mistake."""
    counts = few_class_counts(df, label_col)
    if counts is None:
        raise ValueError(f"{label_col} has more than {MAX_STRATA} values and is no outcome")
    return counts


def class_balance(df: DataFrame, label_col: str) -> DataFrame:
    """(label, n, share) per class, as a table."""
    counted = class_count_table(df, label_col)
    return counted.withColumn("share", F.col("n") / counted.agg(F.sum("n").alias("total")).scalar())


def down_sample_share(counts: dict, ratio: float) -> float:
    """Share of negatives kept: positives · ratio / all rows, at most 1."""
    positives, negatives = counts.get(1, 0), counts.get(0, 0)
    return min(1.0, positives * ratio / max(1, positives + negatives))


def down_sample_by_share(df: DataFrame, label_col: str, keys: Sequence[str], ratio: float = 4,
                         seed: int = 0) -> DataFrame:
    """Keep all positives and a random share of the negatives. Other labels are dropped."""
    share = down_sample_share(class_counts(df, label_col), ratio)
    if not keys:
        return df.sampleBy(label_col, {1: 1.0, 0: share}, seed)
    chosen = (F.col(label_col) == 0) & (row_uniform(keys, seed) < F.lit(share))
    return df.filter((F.col(label_col) == 1) | chosen)


def minority_and_majority(counts: dict) -> tuple:
    ordered = sorted(counts, key=lambda label: (counts[label], str(label)))
    if len(ordered) != 2:
        raise ValueError(f"two classes are needed, found {sorted(map(str, counts))}")
    return ordered[0], ordered[1]


def under_sample(df: DataFrame, label_col: str, keys: Sequence[str], ratio: float = 0.5,
                 seed: int = 42) -> DataFrame:
    """Drop random majority rows until minority / majority = ``ratio``; the minority stays whole."""
    counts = class_counts(df, label_col)
    minority, majority = minority_and_majority(counts)
    wanted = int(counts[minority] / ratio)
    if wanted > counts[majority]:
        raise ValueError(
            f"minority / majority is {counts[minority] / counts[majority]:.3f} already; "
            f"a ratio of {ratio} cannot be reached by dropping majority rows"
        )
    cut = hash_cuts(
        df.filter(F.col(label_col) == F.lit(majority)), keys, seed, {majority: [wanted]}, label_col, counts[majority])
    chosen = (F.col(label_col) == F.lit(majority)) & at_or_before(cut[majority][0])
    placed = with_position(df, keys, seed)
    return placed.filter((F.col(label_col) == F.lit(minority)) | chosen).drop(*POSITION)


def _per_class(label_col: str, choices: dict, otherwise=None) -> Column:
    expr = F.lit(otherwise)
    for label, value in choices.items():
        expr = F.when(F.col(label_col) == F.lit(label), value).otherwise(expr)
    return expr


def largest_remainder(counts: dict, total: int) -> dict:
    """Split ``total`` over the classes in proportion, whole numbers that add up."""
    n = sum(counts.values())
    quotas = {c: total * m / n for c, m in counts.items()}
    parts = {c: int(q) for c, q in quotas.items()}
    order = sorted(counts, key=lambda c: (parts[c] - quotas[c], str(c)))
    for c in order[: total - sum(parts.values())]:
        parts[c] += 1
    return parts


def stratified_split(df: DataFrame, label_col: str, keys: Sequence[str], share: float = 0.5,
                     seed: int = 42, names: tuple[str, str] = ("test", "calibration"),
                     out_col: str = "part") -> DataFrame:
    """Label each row with one of two parts; the second gets ``share`` of every class.

    The second part has ceil(share · rows) rows in all, shared out over the classes by largest
    remainder.
    """
    counts = few_class_counts(df, label_col)
    if counts is None:
        return _split_many(df, label_col, keys, share, seed, names, out_col)
    total = -(-sum(counts.values()) * share // 1)
    sizes = largest_remainder(counts, int(total))
    cuts = hash_cuts(df, keys, seed, {c: [size] for c, size in sizes.items()}, label_col, max(counts.values(), default=0))
    chosen = _per_class(label_col, {c: at_or_before(cuts[c][0]) for c in counts})
    part = F.when(chosen, names[1]).when(F.col(label_col).isNotNull(), names[0])
    return with_position(df, keys, seed).withColumn(out_col, part).drop(*POSITION)


def _split_many(df: DataFrame, label_col: str, keys: Sequence[str], share: float, seed: int, names: tuple[str, str],
                out_col: str) -> DataFrame:
    """The same split with the sizes per class as a table."""
    counts = class_count_table(df.filter(F.col(label_col).isNotNull()), label_col)
    n_rows = counts.agg(F.sum("n")).first()[0]
    total = int(-(-n_rows * share // 1))
    quota = F.lit(float(total)) * F.col("n") / F.lit(float(n_rows))
    parts = counts.withColumns({"_quota": quota, "_part": F.floor(quota)})
    left = total - parts.agg(F.sum("_part")).first()[0]
    order = [F.col("_part") - F.col("_quota"), F.col(label_col).cast("string")]
    sizes = strata.numbered(parts, order, "_place").withColumn("_size", F.col("_part") + (F.col("_place") < left).cast("long"))
    number = strata.interval_numbers(df, label_col, keys, seed, sizes.select(label_col, F.array("_size").alias("ends")), "_part")
    part = F.when(F.col("_part") == 0, names[1]).when(F.col("_part") == 1, names[0])
    return number.withColumn(out_col, part).drop("_part")


def fold_ends(n: int, k: int) -> list[int]:
    """Last rank of each fold but the last; the first ``n % k`` folds hold one row more."""
    size, extra = divmod(n, k)
    ends, end = [], 0
    for i in range(k - 1):
        end += size + (1 if i < extra else 0)
        ends.append(end)
    return ends


def stratified_folds(df: DataFrame, label_col: str, keys: Sequence[str], k: int = 2, seed: int = 42,
                     out_col: str = "fold") -> DataFrame:
    """Fold number 0 … k-1 per row; every fold holds each class to within one row."""
    counts = few_class_counts(df, label_col)
    if counts is None:
        size, extra = F.floor(F.col("n") / k), F.col("n") % k
        ends = F.array(*[(size * (i + 1) + F.least(F.lit(i + 1), extra)).cast("long") for i in range(k - 1)]).cast("array<long>")
        sizes = class_count_table(df, label_col).select(label_col, ends.alias("ends"))
        return strata.interval_numbers(df, label_col, keys, seed, sizes, out_col)
    cuts = hash_cuts(df, keys, seed, {c: fold_ends(n, k) for c, n in counts.items()}, label_col, max(counts.values(), default=0))

    def fold(label) -> Column:
        after = [F.when(at_or_before(cut), 0).otherwise(1) for cut in cuts[label]]
        return sum(after, F.lit(0))

    number = _per_class(label_col, {c: fold(c) for c in counts}).cast("int")
    return with_position(df, keys, seed).withColumn(out_col, number).drop(*POSITION)


def nested_samples(df: DataFrame, label_col: str, keys: Sequence[str], shares: Sequence[float],
                   seed: int = 42, out_col: str = "first_share") -> DataFrame:
    """The smallest of the ascending ``shares`` whose sample holds the row; samples are nested."""
    counts = few_class_counts(df, label_col)
    if counts is None:
        ends = F.array(*[F.rint(F.lit(float(s)) * F.col("n")).cast("long") for s in shares])
        sizes = class_count_table(df, label_col).select(label_col, ends.alias("ends"))
        numbered = strata.interval_numbers(df, label_col, keys, seed, sizes, "_share")
        listed = F.array(*[F.lit(float(s)) for s in shares])
        return numbered.withColumn(out_col, F.get(listed, F.col("_share"))).drop("_share")
    ends = {c: [int(round(s * n)) for s in shares] for c, n in counts.items()}
    cuts = hash_cuts(df, keys, seed, ends, label_col, max(counts.values(), default=0))

    def first(label) -> Column:
        expr = F.lit(None).cast("double")
        for share, cut in reversed(list(zip(shares, cuts[label]))):
            expr = F.when(at_or_before(cut), F.lit(float(share))).otherwise(expr)
        return expr

    smallest = _per_class(label_col, {c: first(c) for c in counts})
    return with_position(df, keys, seed).withColumn(out_col, smallest).drop(*POSITION)
