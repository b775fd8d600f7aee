"""Intermediate tables in the folder that all machines of a cluster share, and running totals over blocks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a single-machine session may go without the setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/llm/{uuid.uuid4().hex}/{name}"


ROWS_PER_FILE = 100_000
LEAST_FILES = 8


def stored(df: DataFrame, name: str, rows: int | None = None, packed: bool = True) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here, and lost executors lose nothing.

    ``rows``, where it is known what they are at most, keeps narrow tables from being written in very many small
    files: a task then takes several shuffle partitions, of ``ROWS_PER_FILE`` rows or so together.
    """
    path = new_folder(df.sparkSession, name)
    if rows is not None:
        df = df.coalesce(max(LEAST_FILES, -(-rows // ROWS_PER_FILE)))
    plain = {} if packed else {"compression": "none", "parquet.enable.dictionary": "false"}
    df.write.options(**plain).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def offsets(blocks: DataFrame, block: str, amount: str, out: str, span: int = 1024) -> DataFrame:
    """For each block (numbered by a long, one row each) the sum of ``amount`` over all blocks before it.

    Totals of ``span`` blocks are summed first, so the one window without a key sees a ``span``-th of the rows.
    """
    group = F.floor(F.col(block) / F.lit(span))
    rows = blocks.select(block, F.col(amount).alias("_amount"), group.alias("_group"))
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = rows.groupBy("_group").agg(F.sum("_amount").alias("_total"))
    groups = groups.select("_group", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_group").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
    return rows.join(groups, "_group").select(block, (F.col("_before") + F.col("_inside")).cast("long").alias(out))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores in front as it takes to differ from all columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        found.append(name)
    return found


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, also where ``use`` refers to it in an inner lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)
