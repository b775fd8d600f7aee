import pytest
from pyspark.sql import functions as F

from panelspark.llm import store


@pytest.mark.parametrize("span", [1, 3, 1024])
def test_offsets(spark, span):
    blocks = [(b, (b * 7) % 5) for b in range(40) if b % 3]
    out = store.offsets(spark.createDataFrame(blocks, "block long, n long"), "block", "n", "start", span)
    assert sorted(tuple(r) for r in out.collect()) == [(b, sum(n for c, n in blocks if c < b)) for b, _ in blocks]


def test_stored_tables_are_written_once(spark):
    out = store.stored(spark.range(5).withColumn("x", F.rand()), "numbers")
    assert out.collect() == out.collect()


def test_let(spark):
    df = spark.range(3).select(store.let(F.col("id") + 1, lambda x: x * x).alias("v"))
    assert [r["v"] for r in df.collect()] == [1, 4, 9]
