import pytest
from pyspark.sql import functions as F

from panelspark.operators import sampling, strata
from panelspark.operators.ranking import with_position


@pytest.fixture
def rows(spark):
    """70 positives, 930 negatives."""
    return spark.range(1000).selectExpr("cast(id as string) as k", "cast(id < 70 as int) as y").persist()


def counts(df, *by):
    return {tuple(r[:-1]): r[-1] for r in df.groupBy(*by).count().collect()}


def test_down_sample(spark):
    df = spark.createDataFrame([(str(i), int(i >= 100)) for i in range(102)], "k string, target int")
    share = sampling.down_sample_share({0: 100, 1: 2}, 4)
    assert share == pytest.approx(8 / 102)
    for keys in (["k"], []):
        found = counts(sampling.down_sample_by_share(df, "target", keys, 4), "target")
        assert found[(1,)] == 2 and 1 <= found.get((0,), 0) <= 20
    assert sampling.down_sample_share({0: 1, 1: 10}, 4) == 1.0


def test_under_sample_is_exact_and_repeatable(rows):
    found = sampling.under_sample(rows, "y", ["k"], 0.5)
    assert counts(found, "y") == {(1,): 70, (0,): 140}
    again = sampling.under_sample(rows.repartition(17), "y", ["k"], 0.5)
    assert found.exceptAll(again).count() == 0
    other = sampling.under_sample(rows, "y", ["k"], 0.5, seed=1)
    assert found.exceptAll(other).count() > 50
    with pytest.raises(ValueError, match="cannot be reached"):
        sampling.under_sample(rows, "y", ["k"], 0.01)


def test_split_is_complete_and_stratified(rows):
    parts = sampling.stratified_split(rows, "y", ["k"], 0.5)
    assert counts(parts, "part", "y") == {("test", 1): 35, ("test", 0): 465, ("calibration", 1): 35, ("calibration", 0): 465}
    third = counts(sampling.stratified_split(rows, "y", ["k"], 1 / 3), "part")
    assert third == {("test",): 666, ("calibration",): 334}


@pytest.mark.parametrize("k", [2, 3, 7])
def test_folds_differ_by_one_row_at_most(rows, k):
    found = counts(sampling.stratified_folds(rows, "y", ["k"], k), "fold", "y")
    assert sum(found.values()) == 1000 and {f for f, _ in found} == set(range(k))
    for y in (0, 1):
        sizes = [n for (_, label), n in found.items() if label == y]
        assert len(sizes) == k and max(sizes) - min(sizes) <= 1


def test_nested_samples(rows):
    found = sampling.nested_samples(rows, "y", ["k"], [0.2, 0.6, 1.0])
    assert counts(found, "first_share", "y") == {
        (0.2, 1): 14, (0.2, 0): 186, (0.6, 1): 28, (0.6, 0): 372, (1.0, 1): 28, (1.0, 0): 372}


def test_labels_do_not_shuffle_the_rows(rows):
    plan = sampling.stratified_folds(rows, "y", ["k"], 5)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_too_many_strata(spark):
    df = spark.range(2000).withColumn("s", F.col("id"))
    with pytest.raises(ValueError, match="no outcome"):
        sampling.class_counts(df, "s")


def test_largest_remainder():
    assert sampling.largest_remainder({0: 10, 1: 3}, 7) == {0: 5, 1: 2}
    assert sum(sampling.largest_remainder({"a": 33, "b": 33, "c": 34}, 50).values()) == 50


def test_balance(rows):
    found = {r.y: (r.n, r.share) for r in sampling.class_balance(rows, "y").collect()}
    assert found == {0: (930, 0.93), 1: (70, 0.07)}


@pytest.mark.parametrize("sample", [
    lambda df: sampling.stratified_folds(df, "y", ["k"], 3, 7),
    lambda df: sampling.stratified_folds(df, "y", ["k"], 2, 8),
    lambda df: sampling.stratified_split(df, "y", ["k"], 0.37, 9),
    lambda df: sampling.nested_samples(df, "y", ["k"], [0.1, 0.5, 0.9], 10),
])
def test_many_strata_are_sampled_alike(spark, monkeypatch, sample):
    df = spark.range(700).selectExpr("id AS k", "CASE WHEN id % 13 > 0 THEN CAST(sqrt(id % 40) AS INT) END AS y")
    df = df.unionByName(df.where("k < 20"))  # rows of one key stay together
    few = sample(df)
    monkeypatch.setattr(sampling, "MAX_STRATA", 2)
    many = sample(df)
    assert few.columns == many.columns and few.dtypes == many.dtypes
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))


def by_hand(df, ends):
    """Per row the number of its stratum's ranks that it is behind, in hash order; rows of one key have one rank."""
    rows = with_position(df, ["k"], 3).collect()
    out = []
    for r in rows:
        before = sum(o["y"] == r["y"] and (o["_hash"], o["_hash_key"]) < (r["_hash"], r["_hash_key"]) for o in rows)
        out.append((r["k"], r["y"], None if r["y"] is None else sum(before + 1 > end for end in ends[r["y"]])))
    return sorted(out, key=str)


@pytest.mark.parametrize("level_bits, sorted_rows", [(12, 100_000), (4, 5), (12, 1)])
def test_cuts_of_strata_of_any_size(spark, monkeypatch, level_bits, sorted_rows):
    """A third of the rows in one stratum, a key of many rows, rows without stratum; ranks below the first row and
    behind the last, and none at all. Ranges are divided anew until few rows are left in them."""
    monkeypatch.setattr(strata, "LEVEL_BITS", level_bits)
    monkeypatch.setattr(strata, "SORTED_ROWS", sorted_rows)
    df = spark.range(900).selectExpr("CASE WHEN id % 9 = 0 THEN -1 ELSE id END AS k", "CASE WHEN id % 3 = 0 THEN 0 WHEN id % 50 > 0 THEN id % 40 END AS y")
    names = [r[0] for r in df.where("y IS NOT NULL").select("y").distinct().collect()]
    ends = {y: [] if y == 7 else sorted([0, 1 + y % 4, 90 + y, 5000]) for y in names}
    table = spark.createDataFrame(list(ends.items()), "y long, ends array<long>")
    out = strata.interval_numbers(df, "y", ["k"], 3, table, "part")
    assert sorted(((r["k"], r["y"], r["part"]) for r in out.collect()), key=str) == by_hand(df, ends)


def test_one_fold_and_empty_tables_of_many_strata(spark, monkeypatch):
    monkeypatch.setattr(sampling, "MAX_STRATA", 0)
    df = spark.range(30).selectExpr("id AS k", "id % 7 AS y")
    assert {r["fold"] for r in sampling.stratified_folds(df, "y", ["k"], 1).collect()} == {0}
    strange = spark.createDataFrame([], "k long, y long")
    table = spark.createDataFrame([], "y long, ends array<long>")
    assert strata.interval_numbers(strange, "y", ["k"], 3, table, "part").collect() == []


def test_row_numbers_in_order(spark):
    df = spark.range(500).selectExpr("id % 90 AS a", "id AS b").repartition(7)
    out = strata.numbered(df, [F.col("a").desc(), F.col("b")], "place").collect()
    assert [r["place"] for r in sorted(out, key=lambda r: (-r["a"], r["b"]))] == list(range(500))
