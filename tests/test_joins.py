import pytest
from pyspark.sql import functions as F

from panelspark.operators import joins


@pytest.fixture
def sides(spark):
    left = spark.range(3000).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else cast(id as string) end as k", "id % 2 as w", "id as v")
    right = left.select("k", "w").distinct().withColumn("x", F.xxhash64("k", "w")).unionByName(
        spark.createDataFrame([("hot", 0, 5), ("new", 0, 6)], "k string, w long, x long"))
    return left, right


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(sides, how):
    left, right = sides
    hot = joins.find_hot(left, ["k", "w"], min_share=0.1)
    assert sorted(hot) == [("hot", "0"), ("hot", "1")]
    plain = left.join(right, ["k", "w"], how)
    salted = joins.keyed_join(left, [(right, how)], ["k", "w"], hot, salts=7)
    assert salted.columns == plain.columns
    assert sorted(map(tuple, salted.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_hot_rows_spread(sides):
    left, _ = sides
    salted = joins.salt_left(left, ["k", "w"], [("hot", "0"), ("hot", "1")], 8)
    by_heat = salted.groupBy(F.col("k").eqNullSafe("hot").alias("hot"))
    used = {r["hot"]: r["n"] for r in by_heat.agg(F.countDistinct("_salt").alias("n")).collect()}
    assert used == {True: 8, False: 1}


def test_hot_null_key(spark):
    left = spark.range(100).selectExpr("case when id < 50 then null else id end as k", "id")
    right = spark.range(100).selectExpr("id as k", "id * 2 as x")
    hot = joins.find_hot(left, ["k"], min_share=0.4)
    assert hot == [(None,)]
    found = joins.keyed_join(left, [(right, "left")], ["k"], hot)
    assert found.count() == 100 and found.filter("x is null").count() == 50


def test_left_value_wins_and_two_joins(spark):
    left = spark.createDataFrame([("1", "train")], "k string, set_type string")
    right = spark.createDataFrame([("1", "test", 3)], "k string, set_type string, x int")
    other = spark.createDataFrame([("1", 9), ("2", 8)], "k string, y int")
    found = joins.keyed_join(left, [(right, "left"), (other, "inner")], ["k"])
    assert [tuple(r) for r in found.collect()] == [("1", "train", 3, 9)]
    with pytest.raises(ValueError):
        joins.keyed_join(left, [(right, "full")], ["k"])


def test_duplicate_right_keys_fan_out(spark):
    left = spark.createDataFrame([("1",)], "k string")
    right = spark.createDataFrame([("1", 1), ("1", 2)], "k string, x int")
    assert joins.keyed_join(left, [(right, "left")], ["k"]).count() == 2
    assert [tuple(r) for r in joins.rows_per_key(right, ["k"]).collect()] == [("1", 2)]
