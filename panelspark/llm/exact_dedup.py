"""Exact deduplication: groups of equal texts by a 128-bit hash, with the bytes of each group compared.

DataFrame functions only. Texts are equal when they are identical after lower-casing A-Z. A null text counts
as empty. Rows with one id and one text are one record: all of them stay or go together. A null id is kept
only where its whole group has none. An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.store import free_names, stored, text_or_empty


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does that by itself where a text is all ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    fingerprint: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Only ids and hashes are shuffled for the grouping, with counts and the id that stays combined on the map
    side. Texts move once, by id, so that no task gets a large group; the smallest and the largest text of each
    group of two or more are then compared byte by byte, again combined on the map side. Where they differ, the
    hash collided, and those groups are divided by their texts.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is {keep}; it can be smallest or largest")
    pick = F.min if keep == "smallest" else F.max
    texts = docs.select(F.col(id_col).alias("doc_id"), ascii_lower(text_or_empty(text_col)).alias("text"))
    marks = stored(texts.select("doc_id", fingerprint(F.col("text")).alias("mark"), F.sha2("text", 256).alias("text_sha256")), "marks")
    groups = stored(marks.groupBy("mark").agg(pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")

    repeated = marks.join(groups.where("group_size > 1"), "mark").select("doc_id", "mark").distinct()
    members = texts.withColumn("mark", fingerprint(F.col("text"))).join(
        repeated.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left_semi")
    collided = stored(
        members.groupBy("mark").agg(F.min("text").alias("low"), F.max("text").alias("high"))
        .where("low != high").select("mark"), "collided")

    result = marks.join(groups, "mark")
    if not collided.isEmpty():
        wrong = members.join(collided, "mark", "left_semi")
        parts = stored(wrong.groupBy("mark", "text").agg(pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "parts")
        again = wrong.join(parts, ["mark", "text"]).select("doc_id", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
        result = result.join(collided, "mark", "left_anti").select(again.columns).unionByName(again)
    return result.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Rows of one id, and rows without id, are told apart by
    a hash of their texts."""
    own_id, own_mark = free_names(docs, "_kept_id", "_mark")
    kept = exact_groups(docs, id_col, text_col, keep).where("kept")
    kept = kept.select(F.col("doc_id").alias(own_id), F.col("text_sha256").alias(own_mark)).distinct()
    mark = F.sha2(ascii_lower(F.coalesce(docs[text_col], F.lit(""))), 256)
    return docs.join(kept, docs[id_col].eqNullSafe(F.col(own_id)) & (mark == F.col(own_mark)), "left_semi")
