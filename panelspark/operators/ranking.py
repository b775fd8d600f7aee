"""Exact global ranks, running totals and quantiles without a single-task window.

Each operator works on two levels. A first pass counts rows per bucket of the order, which
leaves a bounded table; running totals over that table give every bucket its offset. Rows are
then only ordered within a bucket. Buckets are cut at fixed values, so a task that is run again
puts every row where it was before.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.hashing import HASH_BITS, row_hash

MIN_BUCKETS, MAX_BUCKETS = 8, 1024


def default_buckets(df: DataFrame) -> int:
    """As many buckets as the session has shuffle partitions, within bounds; where the platform sets them by
    itself, as many as tasks run at a time."""
    setting = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    partitions = int(setting) if setting.isdigit() else df.sparkSession.sparkContext.defaultParallelism
    return max(MIN_BUCKETS, min(MAX_BUCKETS, partitions))


# -- running totals by value --------------------------------------------------------------------


SMALL_TABLE = 100_000


def bucket_edges(df: DataFrame, value: str, n_buckets: int) -> list[float]:
    """Up to ``n_buckets - 1`` cut values that split the rows about evenly; none for few rows."""
    shares = [i / n_buckets for i in range(1, n_buckets)]
    row = df.agg(
        F.percentile_approx(value, shares, 20 * n_buckets).alias("edges"), F.count(F.lit(1)).alias("n")).first()
    return sorted(set(row["edges"])) if row["n"] > SMALL_TABLE else []


def _bucket_of(value: Column, edges: Sequence[float]) -> Column:
    """How many edges lie below the value."""
    return F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e < value))


def running_totals(df: DataFrame, value: str, weights: Sequence[str], by: Sequence[str] = (),
                   descending: bool = False, n_buckets: int | None = None) -> DataFrame:
    """(by…, value, weights…, cum_<w>…, total_<w>…) with one row per distinct value.

    ``cum_<w>`` is the total of ``w`` over all values up to and including this one, in the given
    direction. Equal values are summed before the shuffle, so ties cost nothing.
    """
    n_buckets = n_buckets or default_buckets(df)
    distinct = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg(*[F.sum(w).alias(w) for w in weights])
    )
    edges = bucket_edges(distinct, value, n_buckets)
    direction = F.col(value).desc() if descending else F.col(value).asc()
    running = (Window.unboundedPreceding, Window.currentRow)
    if not edges:  # few distinct values, or one
        group, upto = Window.partitionBy(*by), Window.partitionBy(*by).orderBy(direction).rowsBetween(*running)
        return distinct.select(
            *by, value, *weights,
            *[F.sum(w).over(upto).alias(f"cum_{w}") for w in weights],
            *[F.sum(w).over(group).alias(f"total_{w}") for w in weights],
        )
    bucket = _bucket_of(F.col(value), edges)
    placed = distinct.withColumn("_bucket", -bucket if descending else bucket)
    # one row per group and bucket
    sums = placed.groupBy(*by, "_bucket").agg(*[F.sum(w).alias(f"_s_{w}") for w in weights])
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *by,
        "_bucket",
        *[F.coalesce(F.sum(f"_s_{w}").over(earlier), F.lit(0)).alias(f"_before_{w}") for w in weights],
        *[F.sum(f"_s_{w}").over(group).alias(f"total_{w}") for w in weights],
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy(direction).rowsBetween(*running)
    ranked = placed.withColumns({f"_in_{w}": F.sum(w).over(inside) for w in weights})
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}")) for c in by]
    on = reduce(and_, same, F.col("r._bucket") == F.col("o._bucket"))
    if not by:
        offsets = F.broadcast(offsets)  # one row per bucket
    return ranked.alias("r").join(offsets.alias("o"), on).select(
        *[F.col(f"r.{c}").alias(c) for c in [*by, value, *weights]],
        *[(F.col(f"o._before_{w}") + F.col(f"r._in_{w}")).alias(f"cum_{w}") for w in weights],
        *[F.col(f"o.total_{w}").alias(f"total_{w}") for w in weights],
    )


# -- rows at given ranks ------------------------------------------------------------------------


def _covers(ranks: dict, group: str) -> Column:
    """True for counted values (``n`` rows, ``cum`` up to and including) that hold a wanted rank."""
    hits = [
        (F.col(group) == F.lit(name)) & (F.col("cum") >= rank) & (F.col("cum") - F.col("n") < rank)
        for name, listed in ranks.items()
        for rank in set(listed)
    ]
    return reduce(or_, hits, F.lit(False))


def _row_at(rows: list, name, rank: int):
    return next((r for r in rows if r["name"] == name and r["cum"] - r["n"] < rank <= r["cum"]), None)


MAX_VALUES_IN_BRACKET = 200_000


@dataclass(frozen=True)
class Bracket:
    """A range of values known to hold the wanted ranks: rows below it, and rows inside it."""

    low: float | None
    high: float | None
    below: int
    inside: int

    def holds(self, ranks: Sequence[int]) -> bool:
        return self.below < min(ranks) and max(ranks) <= self.below + self.inside

    def contains(self, value: Column) -> Column:
        return value.isNotNull() if self.low is None else value.between(F.lit(self.low), F.lit(self.high))


def _quantiles(df: DataFrame, brackets: dict[str, Bracket], ranks: dict, slack: float, accuracy: int) -> dict:
    """Per column two approximate quantiles of the values inside its bracket, around its ranks."""
    def shares(c: str, b: Bracket) -> list[float]:
        low, high = ((r - b.below) / b.inside for r in ranks[c])
        return [max(0.0, low - slack), min(1.0, high + slack)]

    return df.agg(*[
        F.percentile_approx(F.when(b.contains(F.col(c)), F.col(c)), shares(c, b), accuracy).alias(c)
        for c, b in brackets.items()
    ]).first().asDict()


def _counted(df: DataFrame, bounds: dict[str, tuple]) -> dict[str, Bracket]:
    """The brackets between given bounds, with exact counts."""
    row = df.agg(*[
        expr
        for i, (c, (low, high)) in enumerate(bounds.items())
        for expr in (
            F.count_if(F.col(c) < F.lit(low)).alias(f"below{i}"),
            F.count_if(F.col(c).between(F.lit(low), F.lit(high))).alias(f"inside{i}"),
        )
    ]).first()
    return {c: Bracket(low, high, row[f"below{i}"], row[f"inside{i}"]) for i, (c, (low, high)) in enumerate(bounds.items())}


def exact_medians(df: DataFrame, cols: Sequence[str], sizes: dict[str, int] | None = None, accuracy: int = 10_000,
                  max_inside: int = MAX_VALUES_IN_BRACKET) -> dict[str, float | None]:
    """The exact median of every column; an even count takes the mean of the middle two.

    ``sizes`` are the numbers of known values, counted here where not given. Approximate
    quantiles bracket each median, and counting tells whether the bracket holds it. A bracket
    with too many rows is narrowed again, by a factor of about accuracy / 4 per round; one that
    misses is widened. Only the values inside the last bracket are ever put in order.
    """
    if sizes is None:
        sizes = df.agg(*[F.count(c).alias(c) for c in cols]).first().asDict()
    ranks = {c: ((sizes[c] + 1) // 2, sizes[c] // 2 + 1) for c in cols if sizes[c]}
    whole = {c: Bracket(None, None, 0, sizes[c]) for c in ranks}
    final = {c: b for c, b in whole.items() if b.inside <= max_inside}
    brackets = {c: b for c, b in whole.items() if c not in final}
    slack = 2.0 / accuracy
    while brackets:
        bounds = _quantiles(df, brackets, ranks, slack, accuracy)
        for c, b in _counted(df, bounds).items():
            if not b.holds(ranks[c]):
                slack = min(0.5, slack * 8)
            elif b.inside <= max_inside or b.low == b.high or b.inside == brackets[c].inside:
                final[c] = b
            else:
                brackets[c] = b
        brackets = {c: b for c, b in brackets.items() if c not in final}
    medians = _medians_inside(df, final, ranks) if final else {}
    return {c: medians.get(c) for c in cols}


def _medians_inside(df: DataFrame, brackets: dict[str, Bracket], ranks: dict) -> dict[str, float]:
    inside = F.array(*[
        F.when(
            b.contains(F.col(c)), F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value"))
        )
        for c, b in brackets.items()
    ])
    counts = (
        df.select(F.inline(F.filter(inside, lambda s: s.isNotNull())))
        .groupBy("name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = Window.partitionBy("name").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = {c: [r - b.below for r in ranks[c]] for c, b in brackets.items()}
    rows = counts.withColumn("cum", F.sum("n").over(upto)).filter(_covers(middle, "name")).collect()
    return {c: sum(_row_at(rows, c, r)["value"] for r in listed) / 2.0 for c, listed in middle.items()}


def key_text(keys: Sequence[str]) -> Column:
    """The key as one text; a bar or backslash in a value is escaped and NULL differs from an empty text."""
    values = [F.regexp_replace(F.col(c).cast("string"), r"([|\\])", r"\\$1") for c in keys]
    return F.concat_ws("|", *[F.coalesce(v, F.lit("\\0")) for v in values])


BEYOND_LAST = (1 << HASH_BITS, "")


ROWS_PER_BUCKET = 50_000
LEAST_BITS, MOST_BITS = 6, 24


def hash_cuts(df: DataFrame, keys: Sequence[str], seed: int, ranks: dict, stratum: str, rows: int | None = None,
              bucket_bits: int = 14) -> dict:
    """{stratum: [(hash, key text) …]}: the keys at the given 1-based ranks in hash order.

    ``ranks`` maps each stratum value to ascending ranks. A rank below 1 gives None, one beyond
    the last row a cut that all rows are before. Rows of one key stay together.

    Pass one counts rows per stratum and leading hash bits; pass two orders the keys of just the
    buckets a rank falls into. The bits follow ``rows``, where the rows of the largest stratum are
    known, so that a bucket has about ``ROWS_PER_BUCKET`` keys. Only the cuts reach the driver, and the caller's wide
    rows are never shuffled.
    """
    if rows is not None:
        bucket_bits = min(MOST_BITS, max(LEAST_BITS, (rows // ROWS_PER_BUCKET).bit_length()))
    narrow = df.select(
        F.col(stratum).alias("name"), row_hash(keys, seed).alias("hash"), key_text(keys).alias("key")
    ).withColumn("bucket", F.shiftright("hash", HASH_BITS - bucket_bits))
    place = F.concat_ws("|", "bucket", F.col("name").cast("string"))
    running = (Window.unboundedPreceding, Window.currentRow)
    by_bucket = Window.partitionBy("name").orderBy("bucket").rowsBetween(*running)
    buckets = (
        narrow.groupBy("name", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("cum", F.sum("n").over(by_bucket))
        .filter(_covers(ranks, "name"))
        .select(place.alias("place"), (F.col("cum") - F.col("n")).alias("before"))
        .distinct()
        .collect()
    )
    pairs = [F.lit(x) for r in buckets for x in (r["place"], r["before"])]
    # one lookup per row, so that a pushed-down filter does not hash a row again per bucket
    before = F.create_map(*pairs)[place] if pairs else F.lit(None).cast("long")
    by_hash = Window.partitionBy("name", "bucket").orderBy("hash", "key").rowsBetween(*running)
    rows = (
        narrow.withColumn("before", before)
        .filter(F.col("before").isNotNull())
        .groupBy("name", "bucket", "before", "hash", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("cum", F.col("before") + F.sum("n").over(by_hash))
        .filter(_covers(ranks, "name"))
        .collect()
    )

    def cut(name, rank: int):
        if rank < 1:
            return None
        row = _row_at(rows, name, rank)
        return (row["hash"], row["key"]) if row else BEYOND_LAST

    return {name: [cut(name, rank) for rank in listed] for name, listed in ranks.items()}


POSITION = ("_hash", "_hash_key")


def with_position(df: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    """Each row's place in hash order as two columns, hashed once however often they are compared."""
    return df.withColumns(dict(zip(POSITION, (row_hash(keys, seed), key_text(keys)))))


def at_or_before(cut: tuple[int, str] | None) -> Column:
    """True for rows of :func:`with_position` up to and including the cut."""
    if cut is None:
        return F.lit(False)
    h, key = map(F.col, POSITION)
    return (h < F.lit(cut[0])) | ((h == F.lit(cut[0])) & (key <= F.lit(cut[1])))
