"""Operators that drop or change rows: columns of any name, rows without id, and rows of one id."""

import pytest
from pyspark.sql import functions as F

from panelspark.llm import exact_dedup, line_dedup, minhash, pii, quality_rules, sharding
from panelspark.llm.store import free_names, new_folder
from tests.llm.conftest import AWKWARD

HELPERS = ["_id", "_mark", "_spans", "_gone", "_GOOD", "_kept_id", "_row", "_bucket", "_start", "_n", "__mark", "kept", "text_mark", "bytes"]
OTHERS = AWKWARD + [(None, "b"), (11, "x"), (15, "x"), (15, "y"), (13, "y"), (None, "Write to a@b.cd"), (15, "Write to e@f.gh now")]


def drop_by_rules(docs):
    labels = docs.sparkSession.createDataFrame([(1, 0), (4, 1)], "doc_id long, quality int")
    return quality_rules.keep_good(docs, labels)


def sharded(docs):
    return sharding.write_shards(docs, new_folder(docs.sparkSession, "shards"), 3).drop("slot", "shard")


OPERATORS = {
    "rules": drop_by_rules, "lines": lambda docs: line_dedup.dedup_lines(docs, counts=False), "near": minhash.drop_near_duplicates,
    "personal": pii.mask, "exact": exact_dedup.exact_dedup, "shards": sharded,
}


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text").collect()), key=repr)


@pytest.mark.parametrize("name", OPERATORS)
def test_columns_may_have_any_name(frame, name):
    docs = frame(OTHERS)
    more = docs.select("*", *(F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in HELPERS))
    out = OPERATORS[name](more)
    assert out.columns == more.columns
    kept = out.collect()
    assert all(r[c] == f"{c} of {'none' if r['doc_id'] is None else r['doc_id']}" for r in kept for c in HELPERS)
    assert rows_of(out) == rows_of(OPERATORS[name](docs))


def test_free_names(frame):
    docs = frame([]).withColumnRenamed("lang", "_ID").withColumnRenamed("source", "__id")
    assert free_names(docs, "_id", "_mark") == ["___id", "_mark"]


@pytest.mark.parametrize("keep, gone", [
    ("smallest", [(None, "a"), (5, "A"), (15, "x"), (15, "y"), (None, None), (None, ""), (2, "")]),
    ("largest", [(None, "a"), (4, "a"), (4, "a"), (11, "x"), (13, "y"), (None, None), (None, ""), (1, None)]),
])
def test_exact_copies_go_by_id_and_text(frame, keep, gone):
    left = list(OTHERS)
    for row in gone:
        left.remove(row)
    assert rows_of(exact_dedup.exact_dedup(frame(OTHERS), keep=keep)) == sorted(left, key=repr)


@pytest.mark.parametrize("one", [None, 7])
def test_rows_of_one_id_are_scattered(spark, frame, one):
    rows = [(one, "same text " * 20)] * 600 + [(i, f"text {i}") for i in range(100, 500)]
    path = new_folder(spark, "shards")
    out = sharding.write_shards(frame(rows, 5), path, 4, bucket_bytes=4_000).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=repr) == sorted(rows, key=repr)
    for shard in range(4):
        own = [r for r in out if r["shard"] == shard]
        assert sorted(r["slot"] for r in own) == list(range(250))
        assert 100 < sum(r["doc_id"] == one for r in own) < 200
