"""Shards by a two-pass external shuffle.

Pass one scatters the records by a seeded hash into buckets small enough for one task's memory. Pass two puts
each bucket into a random order (Fisher-Yates) and writes it. Buckets laid end to end are one random order of
all rows, and a shard is an equal part of it, so that row counts differ by one at most.

Null ids and texts are ordinary values (a null text has no bytes), repeated rows are rows of their own, fewer
rows than shards leave shards empty, and an empty table writes no shard. Other columns are written along.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from panelspark.llm.store import free_names, offsets, stored, text_or_empty

BUCKET_BYTES = 16 << 20
MOST_BUCKETS_FULL = 4


def fisher_yates(n: int, seed: int) -> np.ndarray:
    """A random order of 0 … n-1, the same for the same seed."""
    draws = np.random.Generator(np.random.Philox(seed)).integers(0, np.arange(1, n + 1)).tolist()
    order = list(range(n))
    for i in range(n - 1, 0, -1):
        j = draws[i]
        order[i], order[j] = order[j], order[i]
    return np.array(order, dtype=np.int64)


def write_shards(
    docs: DataFrame, path: str, shards: int, seed: int = 17, id_col: str = "doc_id", text_col: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Write ``docs`` to ``path`` as Parquet, one folder per shard, and return the table read back.

    It has the columns of ``docs``, ``slot`` (the row's place in its shard, gapless from 0) and ``shard``. Rows are
    in the order of their slots inside each file. A task holds ``bucket_bytes`` of rows in the mean, and
    ``MOST_BUCKETS_FULL`` times as many beside its longest row at most: where rows of one id (or of one text, without
    id) are more, all rows are scattered by their place in a stored copy of the table instead.
    """
    clash = {"shard", "slot"} & {c.lower() for c in docs.columns}
    if clash:
        docs = docs.withColumnsRenamed({c: f"source_{c}" for c in docs.columns if c.lower() in clash})
    spark, size = docs.sparkSession, F.octet_length(text_or_empty(text_col)) + F.lit(8)
    n_rows, n_bytes = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()
    n_buckets = max(1, math.ceil(n_bytes / bucket_bytes))
    key = F.xxhash64(F.lit(seed), F.col(id_col), F.when(F.col(id_col).isNull(), F.col(text_col)))
    bucket_no, first, row_no = free_names(docs, "_bucket", "_start", "_row")

    def scatter(rows: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
        rows = rows.withColumn(bucket_no, F.pmod(key, F.lit(n_buckets)))
        sizes = rows.groupBy(bucket_no).agg(F.count(F.lit(1)).alias("n"), F.sum(size.cast("long")).alias("bytes"), F.max(size).alias("longest"))
        return rows, stored(sizes, "buckets")

    scattered, counts = scatter(docs, key)
    if not counts.where(F.col("bytes") - F.col("longest") > MOST_BUCKETS_FULL * bucket_bytes).isEmpty():
        # rows of one id are too many for a bucket: each row goes its own way, by its place in a table that stays
        numbered = stored(docs.withColumn(row_no, F.monotonically_increasing_id()), "numbered")
        scattered, counts = scatter(numbered, F.xxhash64(F.lit(seed), F.col(row_no)))
    starts = stored(offsets(counts, bucket_no, "n", first), "bucket_starts")

    schema = StructType([*docs.schema.fields, StructField("slot", LongType()), StructField("shard", IntegerType())])
    columns, place = docs.columns, [id_col, text_col]

    def shuffle(bucket: pa.Table) -> pa.Table:
        number, start = bucket[bucket_no][0].as_py(), bucket[first][0].as_py()
        bucket = bucket.sort_by([(c, "ascending") for c in place])  # a repeated task starts from the same order
        rows = bucket.take(pa.array(fisher_yates(bucket.num_rows, (seed << 40) ^ number))).select(columns)
        position = start + np.arange(rows.num_rows, dtype=np.int64)
        shard = _shard_of(position, n_rows, shards)
        slot = position - _first_of(shard, n_rows, shards)
        return rows.append_column("slot", pa.array(slot)).append_column("shard", pa.array(shard.astype(np.int32)))

    shuffled = scattered.join(starts, bucket_no).groupBy(bucket_no).applyInArrow(shuffle, schema)
    shuffled.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return read_shards(spark, path, schema)


def _shard_of(position: np.ndarray, rows: int, shards: int) -> np.ndarray:
    """The first ``rows % shards`` shards have one row more than the others."""
    small, larger = divmod(rows, shards)
    border = larger * (small + 1)
    return np.where(position < border, position // (small + 1), larger + (position - border) // max(small, 1))


def _first_of(shard: np.ndarray, rows: int, shards: int) -> np.ndarray:
    small, larger = divmod(rows, shards)
    return shard * small + np.minimum(shard, larger)


def read_shards(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
