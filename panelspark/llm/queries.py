"""One query per operator over the whole of its table, and the SQL of its result where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import (
    alignment, bpe, chat, exact_dedup, line_dedup, minhash, packing, periodic_runs, pii, quality_rules, sharding, token_files, toxicity,
)
from panelspark.llm.store import let, new_folder, stored, text_or_empty
from panelspark.llm.tokens import default_tokenizer

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
EXPECTED_SQL: dict[str, str] = {}

SHARDS = 24


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            EXPECTED_SQL[name] = sql
        return build

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op2_chat_formatting")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat.read_conversations(stored(chat.format_turns(rows.unionByName(added)), "chat"))


@query("op3_token_files")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "token_files")
    token_files.write_token_files(documents(spark, sf_dir), path, default_tokenizer(), end_id=2)
    rows = token_files.with_starts(stored(token_files.read_token_files(spark, path), "token_rows"))
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op4_best_fit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.pack(documents(spark, sf_dir), default_tokenizer(), end_id=1)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op7_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(documents(spark, sf_dir), default_tokenizer(), digest=True)


@query("op9_exact_dedup", """
    WITH texts AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents),
    groups AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY text)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
    FROM texts JOIN groups USING (text)""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir), keep="largest")


@query("op10_sharding")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    rows = sharding.write_shards(docs, new_folder(spark, "shards"), SHARDS)
    text = text_or_empty()
    return rows.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


@query("op1_quality_rules")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality_rules.quality_verdicts(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return verdicts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


@query("op8_minhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), width=3, percent=85)


@query("op5_line_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n")))
    return rows.select(
        "doc_id", "n_copy_lines", "n_near_lines", n_lines.cast("long").alias("n_lines_left"),
        F.sha2(text_or_empty(), 256).alias("text_sha256"))


@query("op6_pii")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.spans_of(documents(spark, sf_dir))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id", *map(count, pii.KINDS), F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(pii.all_spans()).alias("spans"))


@query("op13_toxicity")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def made_periodic(doc_id: Column, text: Column) -> Column:
    """The text with its words from a given one on repeated, where a hash of the id asks for it."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        first = (g % n).cast("int")
        period = (1 + F.floor((n - first) / (3 + g % 8))).cast("int")
        rest = F.transform(F.sequence(F.lit(0), n - first - 1), lambda i: F.get(words, first + i % period))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), first), rest), " ")).otherwise("")

    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return F.when(h % 10 == 0, let(words, repeated)).otherwise(text)


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", made_periodic(F.col("doc_id"), text_or_empty()).alias("text"))
    rows = periodic_runs.periodic_runs(docs)
    longest = F.array_sort("runs", lambda x, y: (
        F.when(x["length"] != y["length"], F.signum(y["length"] - x["length"]))
        .when(x["start"] != y["start"], F.signum(x["start"] - y["start"]))
        .otherwise(F.signum(x["period"] - y["period"]))).cast("int"))
    best = F.get(longest, F.lit(0))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment.align(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
        digest=True)
