from collections import Counter

import numpy as np
import pytest

from panelspark.llm import sharding
from panelspark.llm.store import new_folder
from tests.llm.conftest import AWKWARD


def write(spark, df, shards, **more):
    return sharding.write_shards(df, new_folder(spark, "shards"), shards, **more)


def check(rows, out, shards):
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter(rows)
    slots = {s: sorted(r["slot"] for r in out if r["shard"] == s) for s in range(shards)}
    assert all(v == list(range(len(v))) for v in slots.values())
    sizes = [len(v) for v in slots.values()]
    assert sum(sizes) == len(out) and max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("bucket_bytes", [1 << 30, 20_000])
def test_documents(spark, frame, documents, bucket_bytes):
    out = write(spark, frame(documents), 7, bucket_bytes=bucket_bytes).collect()
    check(documents, out, 7)
    in_order = [r["doc_id"] for r in sorted(out, key=lambda r: (r["shard"], r["slot"]))]
    assert in_order != sorted(in_order)


def test_partitions_do_not_matter(spark, frame, documents):
    one, two = (write(spark, frame(documents, n), 5, bucket_bytes=50_000).collect() for n in (1, 6))
    place = lambda out: {r["doc_id"]: (r["shard"], r["slot"]) for r in out}
    assert place(one) == place(two)


def test_awkward_rows(spark, frame):
    check(AWKWARD, write(spark, frame(AWKWARD), 3).collect(), 3)


def test_fewer_rows_than_shards(spark, frame):
    check([(1, "a"), (2, "b")], write(spark, frame([(1, "a"), (2, "b")]), 24).collect(), 24)


def test_empty_table(spark, frame):
    assert write(spark, frame([]), 4).collect() == []


def test_clashing_columns_are_renamed(spark, frame):
    rows = frame([(1, "a"), (2, "b")]).withColumnRenamed("lang", "shard").withColumnRenamed("source", "SLOT")
    out = write(spark, rows, 2)
    assert {"source_shard", "source_SLOT", "shard", "slot"} <= set(out.columns) and out.count() == 2


def test_rows_lie_in_the_order_of_their_slots(spark, frame, documents):
    out = write(spark, frame(documents), 3)
    files = out.selectExpr("*", "_metadata.file_path AS file").collect()
    for file in {r["file"] for r in files}:
        slots = [(r["shard"], r["slot"]) for r in files if r["file"] == file]
        assert slots == sorted(slots)


def test_fisher_yates_is_fair_and_repeatable():
    assert sharding.fisher_yates(50, 3).tolist() == sharding.fisher_yates(50, 3).tolist()
    first = np.bincount([sharding.fisher_yates(4, s)[0] for s in range(4000)], minlength=4)
    assert (abs(first - 1000) < 120).all()
    assert sharding.fisher_yates(0, 1).tolist() == []
