"""Alignment of the tokens of two tokenizers, scored through inverted bitmaps of token pairs.

1. Each text, with a space before it, is encoded by a byte-level tokenizer (A) and by a piece tokenizer with byte
   fallback (B). Byte offsets at which tokens of both end cut them into groups; the two tokens that end there
   are a link. Encoders are asked for stretches between single spaces, at which tokens of both always end, and remember
   frequent ones.
2. Documents are numbered within blocks of bounded size. For every pair of ids a block holds its postings: one bitmap
   of documents per binary digit of the pair's multiplicity in them, stored as sorted numbers where that is smaller.
   The OR of these planes is the pair's document bitmap. Popcounts, weighted by the digit, give the block's counts of
   documents and links; Spark adds them up over blocks, whose documents differ.
3. Corpus counts and the mark of being the highest of their B id return along the postings to the blocks, where planes
   spread them over the documents. A block has bounded size, however frequent a pair is.

A null or empty text, and one that either tokenizer does not give back byte for byte, has no tokens, zero counts
and empty groups. Rows with null or repeated ids are rows of their own, counted each. Only ``id_col`` and ``text_col``
are read, whatever other columns there are; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.bpe import byte_symbols
from panelspark.llm.store import stored
from panelspark.llm.worker import kept

LINKS_PER_BLOCK = 1 << 21
DOCS_PER_BLOCK = 1 << 16
PIECES_KEPT, LONGEST_KEPT = 250_000, 200
BYTES_AT_ONCE = 1 << 20
SALTS = 8
SPACE = "▁"
DOC_FIELDS = [("doc_id", "long"), ("pos", "int"), ("n_a", "long"), ("n_b", "long"), ("n_groups", "long"),
              ("n_links", "long"), ("groups", "string")]
PAIR_FIELDS = [("a", "int"), ("b", "int"), ("n_docs", "long"), ("pair_links", "long"), ("planes", "array<binary>")]
TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<binary>": pa.list_(pa.binary())}


def pieces_of(text: str) -> list[str]:
    """A text cut at single spaces between two characters that are no white space; the spaces are left out."""
    if "  " not in text and text.isascii() and text == text.strip() and not any(c + " " in text or " " + c in text for c in "\t\n\v\f\r\x1c\x1d\x1e\x1f"):
        return text.split(" ")
    out: list[str] = []
    open_ = False  # the piece before may not end here
    for word in text.split(" "):
        joined = not word or word[0].isspace() or not (word[0].isascii() or word[0].isalnum())
        if out and (open_ or joined):
            out[-1] += " " + word
        else:
            out.append(word)
        open_ = not word or word[-1].isspace()
    return out


class Aligner:
    """Tokens of pieces by both tokenizers, cut into groups: numbers of tokens, groups as text, and links."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = {symbol: b for b, symbol in enumerate(byte_symbols())}
        self.bytes_a = {i: bytes(map(byte.get, t)) for t, i in self.a.get_vocab(with_added_tokens=False).items()
                        if all(c in byte for c in t)}
        pieces = {i: self.b.id_to_piece(i) for i in range(self.b.get_piece_size())}
        self.bytes_b = {i: bytes([int(t[3:5], 16)]) if self.b.is_byte(i) else t.replace(SPACE, " ").encode()
                        for i, t in pieces.items()}
        if not all(self.bytes_a.values()) or not all(self.bytes_b.values()):
            raise ValueError("a token without bytes has no end of its own")
        if any(SPACE in t.lstrip(SPACE) for t in pieces.values()):
            raise ValueError("a token that spans words; pieces could not be encoded on their own")
        most = 1 + max(max(self.bytes_a), max(self.bytes_b))
        self.sizes_a, self.sizes_b = (np.array([len(x.get(i, b"")) for i in range(most)]) for x in (self.bytes_a, self.bytes_b))
        self.decimals = list(map(str, range(most)))
        self.digits = np.array(list(map(len, self.decimals)))
        self.known: dict[str, tuple | None] = {}

    def same(self, raws: list[bytes], ids: list[list[int]], tokens: dict[int, bytes]) -> list[bool]:
        """Which pieces the tokens give back; most often all do, and together."""
        found = [b"".join([tokens[i] for i in part]) for part in ids]
        return [x == y for x, y in zip(raws, found)]

    def learn(self, pieces: list[str], found: dict) -> None:
        """Encode pieces and cut them into groups, all in one flat array."""
        ids_a = [e.ids for e in self.a.encode_batch_fast([" " + p for p in pieces], add_special_tokens=False)]
        ids_b = self.b.encode(pieces, num_threads=1)
        raws = [b" " + p.encode() for p in pieces]
        good = [x and y for x, y in zip(self.same(raws, ids_a, self.bytes_a), self.same(raws, ids_b, self.bytes_b))]
        if not all(good):
            found.update((p, None) for p, ok in zip(pieces, good) if not ok)
            pieces, raws, ids_a, ids_b = (list(compress(x, good)) for x in (pieces, raws, ids_a, ids_b))
        if not pieces:
            return
        a, b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (ids_a, ids_b))
        _, last_a, last_b = np.intersect1d(
            np.cumsum(self.sizes_a[a]), ends_b := np.cumsum(self.sizes_b[b]), assume_unique=True, return_indices=True)
        links = (a[last_a] << 32 | b[last_b]).tobytes()
        ends = np.cumsum([len(r) for r in raws])
        bounds = [0, *np.searchsorted(ends_b[last_b], ends, "right").tolist()]  # groups before the end of each piece
        text_a, cut_a = self.decimal(a, last_a)
        text_b, cut_b = self.decimal(b, last_b)
        groups = [f"{text_a[i:j - 1]}|{text_b[k:m - 1]}" for i, j, k, m in zip(cut_a, cut_a[1:], cut_b, cut_b[1:])]
        for piece, part_a, part_b, first, last in zip(pieces, ids_a, ids_b, bounds, bounds[1:]):
            found[piece] = (len(part_a), len(part_b), last - first, ";".join(groups[first:last]), links[8 * first:8 * last])

    def decimal(self, ids: np.ndarray, last: np.ndarray) -> tuple[str, list[int]]:
        """Ids joined by commas, and where the groups begin in that."""
        texts = [self.decimals[i] for i in ids.tolist()]
        ends = np.cumsum(self.digits[ids] + 1)
        return ",".join(texts) + ",", [0, *ends[last].tolist()]

    def texts(self, texts: list[str]) -> Iterator[tuple[int, int, int, str, bytes]]:
        cut = [pieces_of(t) if t else [] for t in texts]
        new = {p for pieces in cut for p in pieces} - self.known.keys()
        long = [p for p in new if len(p) > LONGEST_KEPT]
        held: dict = {}
        if len(self.known) + len(new) > PIECES_KEPT:
            new = {p for pieces in cut for p in pieces}
            self.known.clear()
        short = [p for p in new if len(p) <= LONGEST_KEPT]
        if short:
            self.learn(short, self.known)
        for piece in long:
            self.learn([piece], held)
        for pieces in cut:
            parts = [self.known[p] if len(p) <= LONGEST_KEPT else held[p] for p in pieces]
            if not parts or None in parts:
                yield 0, 0, 0, "", b""
                continue
            n_a, n_b, n, groups, links = zip(*parts)
            yield sum(n_a), sum(n_b), sum(n), ";".join(groups), b"".join(links)


def container(numbers: np.ndarray, docs: int) -> bytes:
    """A compressed bitmap: the sorted numbers as 16-bit integers, or the bits where those are smaller."""
    if 2 * len(numbers) <= (docs + 7) // 8:
        return b"\0" + numbers.astype("<u2").tobytes()
    bits = np.zeros(docs, bool)
    bits[numbers] = True
    return b"\1" + np.packbits(bits).tobytes()


def members(packed: bytes) -> np.ndarray:
    if packed[0] == 0:
        return np.frombuffer(packed, "<u2", offset=1)
    return np.flatnonzero(np.unpackbits(np.frombuffer(packed, np.uint8, offset=1)))


def postings(links: list[bytes]) -> list[tuple]:
    """``a, b, n_docs, n_links, planes`` of each pair in a block, given the links of its documents."""
    docs = len(links)
    pairs = np.frombuffer(b"".join(links), np.int64)
    owner = np.repeat(np.arange(docs), [len(x) // 8 for x in links])
    distinct, number = np.unique(pairs, return_inverse=True)
    cells, times = np.unique(number * docs + owner, return_counts=True)
    begins = np.searchsorted(cells, np.arange(len(distinct) + 1) * docs)
    owner, out = cells % docs if docs else cells, []
    for k, (low, high) in enumerate(zip(begins[:-1].tolist(), begins[1:].tolist())):
        where, n = owner[low:high], times[low:high]
        if high - low == 1:
            n = [int(n[0])]
            planes = [container(where if n[0] >> d & 1 else where[:0], docs) for d in range(n[0].bit_length())]
            links_here = n[0]
        else:
            planes = [container(where[n >> d & 1 == 1], docs) for d in range(int(n.max()).bit_length())]
            links_here = int(n.sum())
        out.append((int(distinct[k]) >> 32, int(distinct[k]) & 0xFFFFFFFF, high - low, links_here, planes))
    return out


def indexed(docs: DataFrame, path_a: str, path_b: str, digest: bool = False) -> DataFrame:
    """Rows of documents (``a`` is null) and of postings, with the block of each (stored)."""
    names = ["block", *(n for n, _ in DOC_FIELDS + PAIR_FIELDS)]
    kinds = [pa.int64(), *(TYPES[k] for _, k in DOC_FIELDS + PAIR_FIELDS)]

    def table(columns: list) -> pa.RecordBatch:
        n = max(len(c) for c in columns if c is not None)
        return pa.RecordBatch.from_arrays(
            [pa.nulls(n, k) if c is None else pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = kept(("aligner", path_a, path_b), lambda: Aligner(path_a, path_b))
        block, links, held = TaskContext.get().partitionId() << 32, [], 0

        def finished() -> Iterator[pa.RecordBatch]:
            rows = postings(links)
            for i in range(0, len(rows), 10_000):
                part = rows[i:i + 10_000]
                yield table([[block] * len(part), *[None] * len(DOC_FIELDS), *zip(*part)])

        for batch in batches:
            ids, texts = batch["doc_id"].to_pylist(), batch["text"]
            first = 0
            while first < len(ids):
                some, size = [], 0
                while first + len(some) < len(ids) and size < BYTES_AT_ONCE:
                    some.append(texts[first + len(some)].as_py() or "")
                    size += len(some[-1])
                rows = []
                for doc_id, (n_a, n_b, n, groups, pairs) in zip(ids[first:], aligner.texts(some)):
                    if held >= LINKS_PER_BLOCK or len(links) >= DOCS_PER_BLOCK:
                        yield from finished()
                        block, links, held = block + 1, [], 0
                    if digest and groups:
                        groups = hashlib.sha256(groups.encode()).hexdigest()
                    rows.append((block, doc_id, len(links), n_a, n_b, n, n, groups))
                    links.append(pairs)
                    held += n
                first += len(some)
                yield table([*zip(*rows), *[None] * len(PAIR_FIELDS)])
        if links:
            yield from finished()

    fields = ", ".join(f"{n} {k}" for n, k in [("block", "long"), *DOC_FIELDS, *PAIR_FIELDS])
    rows = docs.select("doc_id", "text").mapInArrow(run, fields)
    return stored(rows, "pair_postings")


def pair_counts(index: DataFrame) -> DataFrame:
    """``a, b, n_docs, n_links, best``: in how many documents and links a pair of ids occurs, and whether no pair of
    its B id has more links."""
    counts = index.filter("a IS NOT NULL").groupBy("a", "b").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("pair_links").alias("n_links"))
    counts = stored(counts, "pair_counts")
    most = counts.groupBy("b").agg(F.max("n_links").alias("most"))
    return counts.join(most, "b").select("a", "b", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


def returned(index: DataFrame, counts: DataFrame) -> DataFrame:
    """``block, pos, n_best, count_sum`` of the documents with links."""
    salted = counts.select("a", "b", F.col("n_links").alias("count"), "best",
                           F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = index.filter("a IS NOT NULL").select("block", "a", "b", "planes", (F.xxhash64("block") % SALTS).cast("int").alias("salt"))
    rows = rows.withColumn("salt", F.abs("salt")).join(salted, ["a", "b", "salt"]).select("block", "planes", "count", "best")

    def spread(key: tuple, group: pa.Table) -> pa.Table:
        sums, best, last = np.zeros(DOCS_PER_BLOCK, np.int64), np.zeros(DOCS_PER_BLOCK, np.int64), 0
        for planes, count, is_best in zip(*(group[c].to_pylist() for c in ("planes", "count", "best"))):
            for digit, plane in enumerate(planes):
                where = members(plane)
                sums[where] += count << digit
                if is_best:
                    best[where] += 1 << digit
        where = np.flatnonzero(sums)
        return pa.table({"block": pa.array([key[0].as_py()] * len(where), pa.int64()), "pos": pa.array(where, pa.int32()),
                         "n_best": best[where], "count_sum": sums[where]})

    return rows.groupBy("block").applyInArrow(spread, "block long, pos int, n_best long, count_sum long")


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          digest: bool = False) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``, one row per row of ``docs``; with ``digest``
    the groups are given as ``groups_sha256``."""
    index = indexed(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), path_a, path_b, digest)
    scores = returned(index, pair_counts(index)).withColumnsRenamed({"block": "_block", "pos": "_pos"})
    rows = index.filter("a IS NULL")
    joined = rows.join(scores, (F.col("block") == F.col("_block")) & (F.col("pos") == F.col("_pos")), "left")
    return joined.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), F.col("groups").alias("groups_sha256" if digest else "groups"))
