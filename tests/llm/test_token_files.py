import glob
import random
import zlib

import numpy as np
import pytest
import zstandard

from panelspark.llm import token_files, tokens
from panelspark.llm.store import new_folder
from panelspark.llm.tokens import PieceIds, default_tokenizer
from tests.llm.conftest import AWKWARD

ODD = [
    "It's <|endoftext|> don't <|startoftext|>x", "Σ ΑΣ ß İ ñ", " nbsp\xa0x\x1cy\x85z", "a" * 3000, "12345 $$$###***",
    "Kelvin \u212a \u1e9e \u0130x \u017fs \u01c5 \u0149", "we'll've 're 's", "x'", "<|", "a<|endoftext|>b", "é ﬁ ½", "a.<|endoftext|>.", "日本語テキスト ไทย",
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


def whole(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_pieces_give_the_ids_of_the_whole_text(tokenizer, documents):
    draw = random.Random(4)
    marks = ["a", "à", "B", "'s", ".", ",", "<|endoftext|>", "\t", "\n", "\xa0", "é", "Σ", "1", "٣", " "]
    texts = [t for _, t in documents] + ODD + ["".join(draw.choices(marks, k=40)) for _ in range(500)]
    ids = PieceIds(default_tokenizer())
    for text in texts:
        assert np.frombuffer(ids.encode(text.encode()), "<u4").tolist() == whole(tokenizer, text)


def test_a_small_cache_changes_nothing(tokenizer, documents, monkeypatch):
    monkeypatch.setattr(tokens, "PIECES_KEPT", 20)
    ids = PieceIds(default_tokenizer())
    for _, text in documents[:40]:
        assert np.frombuffer(ids.encode(text.encode()), "<u4").tolist() == whole(tokenizer, text)
        assert len(ids) <= 21 and len(ids.older) <= 21


def expected(tokenizer, rows, end_id):
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*whole(tokenizer, text), end_id]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("sizes", [{}, {"text_bytes_per_file": 30_000, "frame_bytes": 2_000}])
@pytest.mark.parametrize("kind", ["documents", "awkward"])
def test_round_trip(spark, frame, documents, tokenizer, sizes, kind):
    rows = documents if kind == "documents" else AWKWARD
    path = new_folder(spark, "tokens")
    token_files.write_token_files(frame(rows), path, default_tokenizer(), 2, **sizes)
    out = token_files.with_starts(token_files.read_token_files(spark, path)).collect()
    found = sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in out), key=lambda r: r[1])
    assert found == expected(tokenizer, rows, 2)


def test_files_are_plain_zstandard(spark, frame, documents, tokenizer):
    path = new_folder(spark, "tokens")
    token_files.write_token_files(frame(documents), path, default_tokenizer(), 2, text_bytes_per_file=1 << 30, frame_bytes=5_000)
    (file,) = glob.glob(f"{path.removeprefix('file:')}/part-*")
    content = open(file, "rb").read()
    raw = zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True).read()
    want = [i for _, t in sorted(documents) for i in [*whole(tokenizer, t), 2]]
    assert np.frombuffer(raw, "<u4").tolist() == want

    _, frames, docs = token_files.seek_table(content)
    assert len(frames) > 3 and len(docs) == len(documents)


def test_only_wanted_frames_are_read(tokenizer):
    docs = [(i, np.arange(i, i + 50, dtype="<u4").tobytes()) for i in range(100)]
    content = b"".join(f + b"\n" for f in token_files.frames_of(docs, 3, frame_bytes=1_000))
    _, frames, _ = token_files.seek_table(content)
    at = int(frames["at"][0])
    broken = content[:at + 8] + b"\xff" * 20 + content[at + 28:]  # the first frame is damaged
    assert [x[3:] for x in token_files.documents_in(broken, [77])] == [docs[77]]
    with pytest.raises(Exception):  # noqa: B017
        list(token_files.documents_in(broken, [0]))


def test_checksums(tokenizer):
    content = bytearray(b"".join(f + b"\n" for f in token_files.frames_of([(1, b"abcd" * 10)], 0)))
    content[-30] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        token_files.seek_table(bytes(content))


def test_empty_table(spark, frame):
    path = new_folder(spark, "tokens")
    token_files.write_token_files(frame([]), path, default_tokenizer(), 2)
    assert token_files.with_starts(token_files.read_token_files(spark, path)).collect() == []
