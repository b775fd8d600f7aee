import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from panelspark.llm import alignment, queries
from panelspark.llm.bpe import byte_symbols
from tests.llm.conftest import AWKWARD, SCHEMA

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "  two  spaces ", "a \t b", "tab\tand\nline \n end", "no\xa0break and 　 wide", "<|endoftext|> <s> </s> <0x41> [INST]",
    "▁ below", "é and e ́ alone", "\U0001f600 \U0001f468‍\U0001f469", "日本語 テキスト", "it's we'll I'd", "x" * 5000,
    "123 4567 ½ ²", "\x00\x1c \x1f", " ", "\n", "ﬁ ① ﷺ", "a b " * 40,
]


@pytest.fixture(scope="module")
def plain():
    """Tokens of whole texts: ids, and the bytes of each, by the two libraries alone."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    byte, name = {s: i for i, s in enumerate(byte_symbols())}, {i: t for t, i in a.get_vocab().items()}

    def of_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode()

    def tokens(text):
        raw, in_a, in_b = (" " + text).encode(), a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        parts = [[bytes(byte[c] for c in name[i]) for i in in_a], list(map(of_b, in_b))]
        return (in_a, in_b, *parts) if text and all(b"".join(p) == raw for p in parts) else ([], [], [], [])

    return tokens


def slow(texts, tokens):
    """Per text the numbers of tokens, groups and links, links of best pairs, their counts, and the groups."""
    found, counts = [], collections.Counter()
    for text in texts:
        in_a, in_b, bytes_a, bytes_b = tokens(text or "")
        end_a = {int(e): k for k, e in enumerate(np.cumsum([len(x) for x in bytes_a]))}
        groups, links, i, j = [], [], 0, 0
        for k, end in enumerate(np.cumsum([len(x) for x in bytes_b]).tolist()):
            if end in end_a:
                m = end_a[end]
                groups.append(",".join(map(str, in_a[i:m + 1])) + "|" + ",".join(map(str, in_b[j:k + 1])))
                links.append((in_a[m], in_b[k]))
                i, j = m + 1, k + 1
        found.append((len(in_a), len(in_b), groups, links))
        counts.update(links)
    best = collections.Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return counts, [(a, b, len(g), len(ln), sum(counts[x] == best[x[1]] for x in ln), sum(counts[x] for x in ln), ";".join(g))
                    for a, b, g, ln in found]


FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


def test_odd_texts(spark, frame, plain):
    draw = random.Random(7)
    texts = ODD + ["".join(draw.choices([*"ab 1.é\n", "  ", "the ", " of", "'s", "\xa0", "日", "́"], k=draw.randint(1, 40))) for _ in range(300)]
    got = alignment.align(frame(list(enumerate(texts))), A, B).orderBy("doc_id").collect()
    assert [tuple(r[f] for f in FIELDS) for r in got] == slow(texts, plain)[1]


@pytest.mark.parametrize("links,docs", [(1 << 21, 1 << 16), (500, 1 << 16), (1 << 21, 3)])
def test_blocks_of_any_size(spark, frame, plain, documents, monkeypatch, links, docs):
    monkeypatch.setattr(alignment, "LINKS_PER_BLOCK", links)
    monkeypatch.setattr(alignment, "DOCS_PER_BLOCK", docs)
    some = documents[:60] + [(1000 + i, "the same text of all") for i in range(40)]
    index = alignment.indexed(frame(some).select("doc_id", "text"), A, B)
    counts, rows = slow([t for _, t in some], plain)
    pairs = {(r.a, r.b): r for r in alignment.pair_counts(index).collect()}
    assert {k: r.n_links for k, r in pairs.items()} == dict(counts)
    assert max(r.n_docs for r in pairs.values()) <= len(some) and all(r.n_docs <= r.n_links for r in pairs.values())
    got = {r.doc_id: tuple(r[f] for f in FIELDS) for r in alignment.align(frame(some), A, B).collect()}
    assert got == dict(zip((i for i, _ in some), rows))


def test_bitmaps():
    draw = random.Random(3)
    for docs in (1, 9, 1000, 60_000):
        for n in {1, docs // 100, docs // 3, docs}:
            numbers = np.array(sorted(draw.sample(range(docs), n)), np.int64)
            packed = alignment.container(numbers, docs)
            assert alignment.members(packed).tolist() == numbers.tolist()
            assert len(packed) <= 1 + min(2 * n, (docs + 7) // 8)
    pair = np.array([5 << 32 | 7], np.int64)
    (row,) = alignment.postings([np.repeat(pair, k).tobytes() for k in (6, 0, 1, 3)])
    assert row[:4] == (5, 7, 3, 10)
    assert [alignment.members(p).tolist() for p in row[4]] == [[2, 3], [0, 3], [0]]


def test_awkward_rows(spark, frame, plain):
    docs = frame(AWKWARD).withColumns({"block": F.lit(1), "pos": F.lit("p"), "a": F.lit(3), "n_best": F.lit(0), "_block": F.lit(2)})
    got = alignment.align(docs, A, B).collect()
    want = [(i, *row) for (i, _), row in zip(AWKWARD, slow([t for _, t in AWKWARD], plain)[1])]
    assert sorted(map(str, (tuple(r[f] for f in ("doc_id", *FIELDS)) for r in got))) == sorted(map(str, want))
    assert alignment.align(spark.createDataFrame([], SCHEMA), A, B).count() == 0


def test_query(spark, sf, documents, plain):
    rows = slow([t for _, t in documents], plain)[1]
    want = {i: (*row[:6], hashlib.sha256(row[6].encode()).hexdigest() if row[6] else "") for (i, _), row in zip(documents, rows)}
    assert {r.doc_id: tuple(r[f] for f in (*FIELDS[:6], "groups_sha256")) for r in queries.op12(spark, sf).collect()} == want
