"""Reading and writing tables: catalog tables, files with a declared schema, overwrite sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, schema: str, table: str) -> DataFrame:
    return spark.table(f"{schema}.{table}")


def read_files(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: StructType | str | None = None, **options) -> DataFrame:
    """Read files. Text formats need a declared schema, so that no inference pass is run."""
    if schema is None and fmt in ("csv", "json"):
        raise ValueError(f"reading {fmt} needs a declared schema")
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def overwrite_table(df: DataFrame, schema: str, table: str, path: str | None = None,
                    fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Replace a catalog table, new schema included. ``path`` makes it an external table.

    Partition the panel by wave to let later reads of single waves prune their files.
    """
    writer = df.write.mode("overwrite").format(fmt).option("overwriteSchema", True)
    if path is not None:
        writer = writer.option("path", f"{path.rstrip('/')}/{table}")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(f"{schema}.{table}")


def append_table(df: DataFrame, schema: str, table: str, fmt: str = "parquet") -> None:
    df.write.mode("append").format(fmt).saveAsTable(f"{schema}.{table}")


def register_raw(spark: SparkSession, path: str, schema: str, table: str, fmt: str = "parquet",
                 declared: StructType | str | None = None, **options) -> DataFrame:
    """Bring raw files into the catalog under a declared (or the files' own) schema."""
    overwrite_table(read_files(spark, path, fmt, declared, **options), schema, table)
    return read_table(spark, schema, table)
