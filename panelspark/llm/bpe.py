"""Byte-pair encoding and decoding with batched numpy merge rounds, from the vocabulary file of a tokenizer.

Made for tokenizers of this kind: NFC, white space runs to one space, lower case, then words by a pattern, each
word's UTF-8 bytes as symbols with a mark at the word's end, and ids joined by spaces when decoded. The words of a
batch that were not seen before lie in one flat array of symbols. In each round every word's pairs are looked up in
the sorted pair keys by binary search, the pair of the lowest rank of each word is merged wherever it occurs there,
and words without a known pair leave the array. All special tokens are recognised in the raw text first.

A null text is empty; an empty text has no ids. Repeated rows and null ids are ordinary; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.store import text_or_empty
from panelspark.llm.worker import kept

PIECES_KEPT = 250_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself where it is printable
    in Latin-1, else the next free character from 256 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Bpe:
    """Encoder and decoder of one vocabulary file. ``pieces`` caches per stretch between ASCII white space."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or steps != ["NFC", "Replace", "Lowercase"] or spec["decoder"] or model["byte_fallback"]:
            raise ValueError(f"{path} is not a vocabulary of the kind that this operator encodes")
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        symbols = byte_symbols()
        self.first = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + end] for s in symbols], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.base = 1 + max([*vocab.values(), *self.special.values()])
        keys = np.array([vocab[a] * self.base + vocab[b] for a, b in merges], np.int64)
        merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        if len(set(merged.tolist())) != len(merged):
            raise ValueError("two merges give one token; whole rounds would not be exact")
        order = np.argsort(keys)
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged[order]
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.tokens = [names.get(i, "").encode() for i in range(self.base)]
        self.cache: dict[bytes, tuple[int, bytes, bytes]] = {}
        self.older: dict[bytes, tuple[int, bytes, bytes]] = {}
        self.word_ids: dict[str, list[int]] = {}

    def merge(self, words: list[str]) -> list[list[int]]:
        """Ids of each word."""
        raw = [w.encode() for w in words]
        lengths = np.array([len(r) for r in raw], np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(lengths)
        ids = self.first[flat]
        ids[ends - 1] = self.last[flat[ends - 1]]
        owner = np.repeat(np.arange(len(words)), lengths)
        done: list[list[int]] = [[]] * len(words)
        while len(ids):
            key = ids[:-1] * self.base + ids[1:]
            at = np.searchsorted(self.keys, key)
            at[at == len(self.keys)] = 0
            known = (self.keys[at] == key) & (owner[:-1] == owner[1:])
            rank = np.append(np.where(known, self.ranks[at], len(self.keys)), len(self.keys))
            begins = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.minimum.reduceat(rank, begins)
            sizes = np.diff(np.append(begins, len(ids)))
            finished = lowest == len(self.keys)
            for b, n in zip(begins[finished].tolist(), sizes[finished].tolist()):
                done[owner[b]] = ids[b:b + n].tolist()
            hit = (rank == np.repeat(lowest, sizes)) & (rank < len(self.keys))
            # of hits in a row (a pair of one symbol), every second one counts, from the left
            place = np.flatnonzero(hit)
            if not len(place):
                break
            run = np.append(True, np.diff(place) > 1)
            in_run = np.arange(len(place)) - np.flatnonzero(run)[np.cumsum(run) - 1]
            place = place[in_run % 2 == 0]
            ids[place] = self.merged[at[place]]
            stay = np.repeat(~finished, sizes)
            stay[place + 1] = False
            ids, owner = ids[stay], owner[stay]
        return done

    def words_of(self, piece: str) -> list[str | int]:
        """The words of a text; a special token is given by its id."""
        parts: list[str | int] = []
        for k, text in enumerate(self.special_pattern.split(piece) if "<" in piece else [piece]):
            if k % 2:
                parts.append(self.special[text])
            else:
                text = unicodedata.normalize("NFC", text)
                text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
                parts += self.words.findall(text)
        return parts

    def learn(self, pieces: set[bytes]) -> None:
        """Encode pieces that were not seen before, all in one batch."""
        if len(self.word_ids) > PIECES_KEPT:
            self.word_ids.clear()
        cut = {p: self.words_of(p.decode("utf-8", "replace")) for p in pieces}
        new = list({w for words in cut.values() for w in words if isinstance(w, str) and w not in self.word_ids})
        self.word_ids.update(zip(new, self.merge(new)) if new else ())
        for piece, words in cut.items():
            ids = [i for w in words for i in ((w,) if isinstance(w, int) else self.word_ids[w])]
            self.cache[piece] = (len(ids), b"".join(b" %d" % i for i in ids), b"".join(b" " + self.tokens[i] for i in ids))

    def encode_batch(self, texts: list[bytes]) -> Iterator[tuple[int, bytes, bytes]]:
        """Per text: number of ids, decimal ids joined by one space, and the decoded text in UTF-8."""
        cut = [t.split() for t in texts]
        needed = {p for pieces in cut for p in pieces}
        new = needed - self.cache.keys()
        if len(self.cache) + len(new) > PIECES_KEPT:  # frequent pieces move over to a new half
            self.older, self.cache, new = self.cache, {}, needed
        found = {p: self.older[p] for p in new if p in self.older}
        self.cache.update(found)
        self.learn(new - found.keys())
        for pieces in cut:
            found = [self.cache[p] for p in pieces]
            yield sum(f[0] for f in found), b"".join([f[1] for f in found])[1:], b"".join([f[2] for f in found])[1:]


def bpe(path: str) -> Bpe:
    """One per vocabulary file and Python worker."""
    return kept(("bpe", path), lambda: Bpe(path))


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False,
                  batch_bytes: int = 4 << 20) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: decimal ids joined by spaces and the text that they decode to; with
    ``digest`` the last two are given as ``ids_sha256`` and ``decoded_sha256`` instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(vocabulary)
        for batch in batches:
            texts, held, first = [], 0, 0
            for k, text in enumerate(batch["text"].cast(pa.binary())):
                texts.append(text.as_py())
                held += len(texts[-1])
                if held >= batch_bytes or k + 1 == batch.num_rows:
                    n, ids, decoded = zip(*coder.encode_batch(texts))
                    if digest:
                        ids, decoded = ([hashlib.sha256(x).hexdigest() for x in c] for c in (ids, decoded))
                    else:
                        ids, decoded = ([x.decode() for x in c] for c in (ids, decoded))
                    yield pa.RecordBatch.from_arrays(
                        [batch["doc_id"].slice(first, len(texts)), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)],
                        ["doc_id", "n_tokens", *names])
                    first, texts, held = k + 1, [], 0

    names = ["ids_sha256", "decoded_sha256"] if digest else ["ids", "decoded"]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, n_tokens long, {names[0]} string, {names[1]} string")
