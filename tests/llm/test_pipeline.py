import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from panelspark.llm import quality_rules
from panelspark.llm.store import stored
from panelspark.llm.tokens import PieceIds, default_tokenizer
from tests.llm import test_line_dedup, test_minhash, test_pii
from tests.llm.conftest import AWKWARD
from tests.llm.test_quality_rules import made

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def tables(folder, rows, labels):
    folder.mkdir()
    docs = {"doc_id": pa.array([i for i, _ in rows], pa.int64()), "text": pa.array([t for _, t in rows], pa.string())}
    docs |= {"lang": pa.array(["en"] * len(rows), pa.string()), "source": pa.array(["s"] * len(rows), pa.string())}
    docs["n_chars"] = pa.array([len(t or "") for _, t in rows], pa.int64())
    pq.write_table(pa.table(docs), folder / "documents.parquet")
    known = {"doc_id": pa.array([i for i, _ in labels], pa.int64()), "quality": pa.array([q for _, q in labels], pa.int32())}
    pq.write_table(pa.table(known | {"toxic": pa.array([0] * len(labels), pa.int32())}), folder / "labels.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def corpus():
    """Good and bad prose in lines, near copies, shared lines, and personal data."""
    draw = random.Random(5)
    rows, labels = made(250)
    rows = [(i, "\n".join(" ".join(w) for w in np.array_split(t.split(" "), 6))) for i, t in rows]
    near = []
    for k in range(40):
        words = rows[5 * k][1].split(" ")
        words[draw.randrange(len(words))] = "changed"
        near.append((1000 + k, " ".join(words)))
    shared = [(2000 + k, rows[5 * k + 3][1].replace("\n", f" more{k} ") + "\nA line that a good many documents have in common.") for k in range(20)]
    private = [(3000 + k, rows[5 * k + 4][1].replace(" ", f" own{k} ", 4) + f" write to user{k}@host.org from 10.0.0.{k}") for k in range(20)]
    return rows + near + shared + private, labels


def test_stages_against_brute_force(spark, tmp_path, corpus):
    rows, labels = corpus
    folder = tables(tmp_path / "sf", rows, labels)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, folder), name)
        out.append({r["doc_id"]: r for r in docs.collect()} if name != "best_fit_packing" else docs.collect())
        assert name == "best_fit_packing" or docs.columns == COLUMNS
    judged, lines, near, masked, packed = out

    stats = stored(quality_rules.statistics(spark.read.parquet(f"{folder}/documents.parquet")), "statistics")
    assert quality_rules.learn_rules(stats, spark.read.parquet(f"{folder}/labels.parquet"))
    good = {i for i, q in labels if q} | {i for i, _ in rows if i >= 1000}
    assert set(judged) == {i for i, t in rows if i in good and len(t.split()) >= 50}

    kept = [(i, r["text"]) for i, r in judged.items()]
    want = {i: (sha, c, n) for i, sha, c, n in test_line_dedup.brute(kept, 1, 20)}
    assert set(lines) == set(judged) and sum(c for _, c, _ in want.values()) > 100
    assert {i: test_line_dedup.hashlib.sha256(r["text"].encode()).hexdigest() for i, r in lines.items()} == {i: w[0] for i, w in want.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in lines.values())

    stay = {i for i, _, _, kept_ in test_minhash.brute([(i, r["text"]) for i, r in lines.items()], 5, 80) if kept_}
    assert set(near) == stay

    assert set(masked) == set(near)
    for i, r in masked.items():
        assert not test_pii.brute(r["text"]) and r["n_chars"] == len(r["text"])
        if not test_pii.brute(near[i]["text"]):
            assert r["text"] == near[i]["text"]

    ids, end, pieces = PieceIds(default_tokenizer()), (corpus_pipeline.END_ID).to_bytes(4, "little"), []
    for i, r in masked.items():
        raw = ids.encode(r["text"].encode()) + end
        pieces += [(i, k, zlib.crc32(raw[at:at + 16384])) for k, at in enumerate(range(0, len(raw), 16384))]
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed) == sorted(pieces)


def test_run_is_the_stages(spark, tmp_path, corpus):
    rows, labels = corpus
    folder = tables(tmp_path / "sf", rows[:120] + rows[250:270], labels)
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 50
    assert entry.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("rows", [[], [(i, t) for i, t in AWKWARD]])
def test_awkward_and_empty_tables(spark, tmp_path, rows):
    folder = tables(tmp_path / "sf", rows, [])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, folder), name)
        assert out.count() <= max(1, 40 * len(rows))
        if name != "best_fit_packing" and name != "quality_rules":
            docs = out  # the base limits would leave next to nothing of these rows
