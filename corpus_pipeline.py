"""A corpus pipeline over ``documents``: quality rules, line dedup, near-dedup, personal data, packing.

Each stage takes the session, the documents that the stage before it wrote, and the folder of the tables. All but
the last return the columns of ``documents``; where a stage changes a text, ``n_chars`` follows. Rows with a null id
or text, empty texts, repeated rows and an empty table pass through every stage as its operator defines.

SQL can state neither the learned rules nor the signatures, so there is no SQL of the result; the tests compare it
with the stages computed by brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import line_dedup, minhash, packing, pii, quality_rules
from panelspark.llm.store import stored
from panelspark.llm.tokens import default_tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
END_ID = 1


def counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` as it is after a change of the text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base limits or a learned rule go."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line equals or nearly equals go; every document stays."""
    return counted(line_dedup.dedup_lines(docs, counts=False))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, similarity 0.8 or more."""
    return minhash.drop_near_duplicates(docs, width=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by the name of their kind."""
    return counted(pii.mask(docs)).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its place in a sequence."""
    rows = packing.pack(docs, default_tokenizer(), end_id=END_ID)
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_duplicates),
    ("personal_data", personal_data),
    ("best_fit_packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
