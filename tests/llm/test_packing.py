import random
import zlib

import numpy as np
import pytest

from panelspark.llm import packing
from panelspark.llm.tokens import PieceIds, default_tokenizer
from tests.llm.conftest import AWKWARD


def ids_of(text, end_id=1):
    return PieceIds(default_tokenizer()).encode((text or "").encode()) + int(end_id).to_bytes(4, "little")


def check(rows, out, tokens):
    ids = PieceIds(default_tokenizer())
    want = []
    for doc_id, text in rows:
        raw = ids.encode((text or "").encode()) + (1).to_bytes(4, "little")
        want += [(doc_id, k, at // 4, len(raw[at:at + 4 * tokens]) // 4, zlib.crc32(raw[at:at + 4 * tokens]))
                 for k, at in enumerate(range(0, len(raw), 4 * tokens))]
    found = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    bins = {}
    for r in out:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= tokens
    return len(bins), sum(r["length"] for r in out) / tokens


@pytest.mark.parametrize("tokens", [64, 4096])
def test_documents(frame, documents, tokens):
    out = packing.pack(frame(documents), default_tokenizer(), 1, tokens).collect()
    used, least = check(documents, out, tokens)
    assert used <= 1.05 * least + 2


def test_awkward_rows(frame):
    check(AWKWARD, packing.pack(frame(AWKWARD), default_tokenizer(), 1, 100).collect(), 100)


def test_several_tasks(frame, documents):
    out = packing.pack(frame(documents), default_tokenizer(), 1, 256, pieces_per_task=100).collect()
    check(documents, out, 256)
    assert len({r["sequence_id"] >> 40 for r in out}) > 1


def test_empty_table(frame):
    assert packing.pack(frame([]), default_tokenizer(), 1).collect() == []


def test_sequences_hold_the_tokens(frame, documents):
    docs = frame(documents[:40])
    placed = packing.pack(docs, default_tokenizer(), 1, 512).persist()
    texts = dict(documents)
    whole = {r["sequence_id"]: r for r in packing.sequences(docs, placed, default_tokenizer(), 1, 512).collect()}
    for r in placed.collect():
        ids = np.frombuffer(ids_of(texts[r["doc_id"]]), "<u4")[r["start"]:r["start"] + r["length"]]
        there = np.frombuffer(whole[r["sequence_id"]]["ids"], "<u4")
        assert there[r["offset"]:r["offset"] + r["length"]].tolist() == ids.tolist()
    assert sum(r["n_tokens"] for r in whole.values()) == sum(r["length"] for r in placed.collect())


def test_bins_against_a_plain_list():
    draw = random.Random(8)
    bins, plain, opened = packing.OpenBins(100, 6), {}, 0
    for _ in range(3000):
        length = draw.randint(1, 100)
        fitting = [(free, k) for k, free in plain.items() if free >= length]
        number, offset = bins.place(length)
        if fitting:
            assert plain[number] == min(fitting)[0] and offset == 100 - plain[number]
            plain[number] -= length
        else:
            if len(plain) == 6:
                fullest = min(plain.values())
                closed = [k for k, free in plain.items() if free == fullest and k not in {x for s in bins.by_free for x in s}]
                plain.pop(closed[0])
            assert number == opened and offset == 0
            opened += 1
            plain[number] = 100 - length
        if plain[number] == 0:
            plain.pop(number)
        assert len(plain) == bins.count <= 6
