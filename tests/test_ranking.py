import random
import statistics
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from panelspark.operators import ranking


def numbers(kind, n=2000, seed=1):
    rng = random.Random(seed)
    make = {
        "even": rng.random,
        "ties": lambda: rng.randrange(5) / 5,
        "narrow": lambda: 0.5 if rng.random() < 0.6 else 0.5 + rng.random() / 1e6,
        "one": lambda: 0.25,
    }[kind]
    return [make() for _ in range(n)]


@pytest.mark.parametrize("kind", ["even", "ties", "narrow", "one"])
@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("small", [0, 10_000])
def test_running_totals(spark, monkeypatch, kind, descending, small):
    monkeypatch.setattr(ranking, "SMALL_TABLE", small)
    values = numbers(kind)
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(values)], "v double, w long")
    found = {r.v: (r.w, r.cum_w, r.total_w) for r in ranking.running_totals(df, "v", ["w"], descending=descending, n_buckets=16).collect()}
    weights = {}
    for i, v in enumerate(values):
        weights[v] = weights.get(v, 0) + i % 3
    order = sorted(weights, reverse=descending)
    sums = list(accumulate(weights[v] for v in order))
    assert found == {v: (weights[v], s, sums[-1]) for v, s in zip(order, sums)}


@pytest.mark.parametrize("small", [0, 10_000])
def test_running_totals_by_group(spark, monkeypatch, small):
    monkeypatch.setattr(ranking, "SMALL_TABLE", small)
    rows = [("a", 1.0, 2), ("a", 3.0, 5), (None, 2.0, 7), (None, 2.0, 1), ("b", None, 1)]
    df = spark.createDataFrame(rows, "g string, v double, w long")
    found = {(r.g, r.v): (r.cum_w, r.total_w) for r in ranking.running_totals(df, "v", ["w"], by=["g"]).collect()}
    assert found == {("a", 1.0): (2, 7), ("a", 3.0): (7, 7), (None, 2.0): (8, 8)}


def test_running_totals_have_no_single_task_window(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SMALL_TABLE", 0)
    df = spark.createDataFrame([(v, 1) for v in numbers("even")], "v double, w long")
    plan = ranking.running_totals(df, "v", ["w"])._jdf.queryExecution().executedPlan().toString()
    rows = [line for line in plan.splitlines() if "SinglePartition" in line]
    # only the table of bucket sums, one row per bucket, is put into one task
    assert len(rows) <= 1


@pytest.mark.parametrize("kind", ["even", "ties", "narrow", "one"])
@pytest.mark.parametrize("n", [1, 2, 501, 2000])
def test_exact_medians(spark, kind, n):
    values = numbers(kind, n)
    other = [None if i % 4 == 0 else -i for i in range(n)]
    df = spark.createDataFrame(list(zip(values, other)), "a double, b int").withColumn("c", F.lit(None).cast("double"))
    found = ranking.exact_medians(df, ["a", "b", "c"], accuracy=100, max_inside=200)
    known = [x for x in other if x is not None]
    assert found == {"a": statistics.median(values), "b": statistics.median(known) if known else None, "c": None}


@pytest.mark.parametrize("kind", ["even", "ties", "narrow"])
def test_brackets_are_narrowed_and_widened(spark, monkeypatch, kind):
    seen = []
    plain = ranking._counted

    def counted(df, bounds):
        if not seen:  # the first bracket misses
            bounds = {c: (2.0, 3.0) for c in bounds}
        seen.append(bounds)
        return plain(df, bounds)

    monkeypatch.setattr(ranking, "_counted", counted)
    values = numbers(kind, 3001)
    df = spark.createDataFrame([(v,) for v in values], "a double")
    assert ranking.exact_medians(df, ["a"], accuracy=20, max_inside=5) == {"a": statistics.median(values)}
    assert len(seen) >= 2


def test_hash_cuts(spark):
    df = spark.range(1000).selectExpr("cast(id as string) as k", "cast(id % 4 as int) as s")
    ranks = {0: [0, 1, 125, 250], 1: [100], 2: [251], 3: []}
    cuts = ranking.hash_cuts(df, ["k"], 7, ranks, "s", bucket_bits=4)
    for stratum, listed in ranks.items():
        rows = ranking.with_position(df.filter(df.s == stratum), ["k"], 7)
        sizes = [rows.filter(ranking.at_or_before(cut)).count() for cut in cuts[stratum]]
        assert sizes == [min(r, 250) for r in listed]


def test_hash_cuts_keep_copies_of_a_key_together(spark):
    df = spark.range(300).selectExpr("case when id < 100 then 'same' else cast(id as string) end as k", "1 as s")
    cut = ranking.hash_cuts(df, ["k"], 7, {1: [150]}, "s")[1][0]
    kept = ranking.with_position(df, ["k"], 7).filter(ranking.at_or_before(cut))
    assert kept.filter("k = 'same'").count() in (0, 100)
    assert kept.count() >= 150
