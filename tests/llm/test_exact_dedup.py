import hashlib
import string

import pytest
from pyspark.sql import functions as F

from panelspark.llm import exact_dedup
from tests.llm.conftest import AWKWARD

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows, keep):
    texts = [(i, (t or "").translate(LOWER)) for i, t in rows]
    out = []
    for i, t in texts:
        ids = [j for j, u in texts if u == t]
        known = [j for j in ids if j is not None]
        stays = (max if keep == "largest" else min)(known) if known else None
        out.append((i, stays, len(ids), i == stays, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_awkward_rows(frame, keep):
    assert result(exact_dedup.exact_groups(frame(AWKWARD), keep=keep)) == brute(AWKWARD, keep)


def test_documents(frame, documents):
    assert result(exact_dedup.exact_groups(frame(documents), keep="largest")) == brute(documents, "largest")


def test_collisions_are_told_apart(frame):
    rows = [(1, "aa"), (2, "bb"), (3, "aa"), (4, "cc"), (5, "BB"), (6, "long text"), (7, None), (8, "")]
    weak = exact_dedup.exact_groups(frame(rows), fingerprint=lambda t: F.char_length(t))
    assert result(weak) == brute(rows, "smallest")


def test_only_a_to_z_are_lowered(frame):
    rows = [(1, "É"), (2, "é"), (3, "AÉ"), (4, "aÉ")]
    assert [r[1] for r in result(exact_dedup.exact_groups(frame(rows)))] == [1, 2, 3, 3]


def test_rows_that_stay_keep_their_columns(frame):
    rows = frame([(1, "a"), (2, "A"), (3, "b")]).withColumnRenamed("lang", "keep_id").withColumnRenamed("source", "mark")
    out = exact_dedup.exact_dedup(rows)
    assert out.columns == rows.columns and sorted(r["doc_id"] for r in out.collect()) == [1, 3]


def test_empty_table(frame):
    assert result(exact_dedup.exact_groups(frame([]))) == []


def test_keep_is_checked(frame):
    with pytest.raises(ValueError, match="smallest or largest"):
        exact_dedup.exact_groups(frame([]), keep="first")
