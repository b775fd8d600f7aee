import hashlib
import random

import numpy as np
import pytest

from panelspark.llm import bpe
from panelspark.llm.tokens import default_tokenizer
from tests.llm.conftest import AWKWARD
from tests.llm.test_token_files import ODD


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


@pytest.fixture(scope="module")
def coder():
    return bpe.Bpe(default_tokenizer())


def check(coder, tokenizer, texts):
    found = list(coder.encode_batch([t.encode() for t in texts]))
    for text, (n, ids, decoded) in zip(texts, found):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert (n, ids.decode()) == (len(want), " ".join(map(str, want)))
        assert decoded.decode() == tokenizer.decode(want, skip_special_tokens=False)


def test_documents(coder, tokenizer, documents):
    check(coder, tokenizer, [t for _, t in documents])


def test_odd_texts(coder, tokenizer):
    check(coder, tokenizer, ODD)


def test_random_texts(coder, tokenizer):
    draw = random.Random(9)
    marks = [*"aaabcdeilnorst", "A", "à", "é", "é", "Σ", "ς", "'s", "'ll", "1", "٣", ".", "--", "<|endoftext|>", " ", "\n", "\xa0", " "]
    check(coder, tokenizer, ["".join(draw.choices(marks, k=draw.randint(1, 120))) for _ in range(1500)])


def test_caches_may_be_emptied(tokenizer, documents, monkeypatch):
    monkeypatch.setattr(bpe, "PIECES_KEPT", 50)
    small = bpe.Bpe(default_tokenizer())
    for _, text in documents[:30]:
        check(small, tokenizer, [text])


def test_rounds_against_one_merge_at_a_time(coder):
    rank = dict(zip(coder.keys.tolist(), coder.ranks.tolist()))
    merged = dict(zip(coder.keys.tolist(), coder.merged.tolist()))

    def slow(word):
        raw = word.encode()
        ids = [int(coder.first[b]) for b in raw[:-1]] + [int(coder.last[raw[-1]])]
        while True:
            pairs = [(rank.get(a * coder.base + b, 1 << 40), k) for k, (a, b) in enumerate(zip(ids, ids[1:]))]
            if not pairs or min(pairs)[0] == 1 << 40:
                return ids
            k = min(pairs)[1]
            ids[k:k + 2] = [merged[ids[k] * coder.base + ids[k + 1]]]

    draw = random.Random(2)
    words = ["".join(draw.choices("aaeinst", k=draw.randint(1, 25))) for _ in range(400)] + ["a" * 97, "ab" * 40]
    assert coder.merge(words) == [slow(w) for w in words]


def test_operator(frame, tokenizer):
    out = bpe.encode_decode(frame(AWKWARD), default_tokenizer(), batch_bytes=1000).collect()
    want = []
    for doc_id, text in AWKWARD:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), " ".join(map(str, ids)), tokenizer.decode(ids, skip_special_tokens=False)))
    assert sorted((tuple(r) for r in out), key=repr) == sorted(want, key=repr)
    digests = bpe.encode_decode(frame(AWKWARD), default_tokenizer(), digest=True).collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert sorted((tuple(r) for r in digests), key=repr) == sorted(((i, n, sha(a), sha(b)) for i, n, a, b in want), key=repr)


def test_empty_table(frame):
    assert bpe.encode_decode(frame([]), default_tokenizer()).collect() == []


def test_byte_symbols_cover_all_bytes(coder):
    assert len(set(bpe.byte_symbols())) == 256 and len(np.unique(coder.first)) == 256
