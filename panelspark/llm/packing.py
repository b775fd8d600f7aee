"""Bounded-space online best-fit packing of documents into sequences of a fixed number of tokens.

Documents are encoded where they lie; only longer ones than a sequence are cut, into full pieces and a rest. The
lengths alone are then dealt out in hashed order to packing tasks, each of which takes its pieces as they come: a
piece goes to the open bin that it fills best, and when a new bin would exceed the fixed number of open bins, the
fullest is closed first. Open bins are found in a bitset with a bit per amount of free space. A task's memory is
bounded by the open bins; each task leaves some bins part full, so tasks are made large (``pieces_per_task``).

A null text is empty and gives a piece of the end id alone. Repeated rows are documents of their own, each with a
place of its own. Null ids are ordinary values; an empty table gives an empty result; other columns are not looked
at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.store import stored, text_or_empty
from panelspark.llm.tokens import piece_ids

SEQUENCE_TOKENS = 4096
OPEN_BINS = 2048
PIECES_PER_TASK = 250_000


class OpenBins:
    """A fixed number of open bins, best fit, closing the fullest first."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most, self.count, self.opened = capacity, most, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.free_bits = 0  # bit f is set where a bin with f free places is open

    def take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.free_bits &= ~(1 << free)
        self.count -= 1
        return number

    def put(self, number: int, free: int) -> None:
        if free:
            self.by_free[free].append(number)
            self.free_bits |= 1 << free
            self.count += 1

    def place(self, length: int) -> tuple[int, int]:
        """The bin and the offset there of a piece of this length."""
        fitting = self.free_bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self.take(free)
        else:
            if self.count >= self.most:
                self.take((self.free_bits & -self.free_bits).bit_length() - 1)
            free, number = self.capacity, self.opened
            self.opened += 1
        self.put(number, free - length)
        return number, self.capacity - free


def pieces_of(
    docs: DataFrame, tokenizer: str, end_id: int, tokens: int = SEQUENCE_TOKENS,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``, and ``ids`` (little-endian bytes) if asked for."""
    end, most = int(end_id).to_bytes(4, "little"), 4 * tokens
    kinds = [("doc_id", pa.int64()), ("text_crc32", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
             ("length", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * with_ids

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows), kinds)], [n for n, _ in kinds])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = piece_ids(tokenizer).encode
        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary())):
                text = text.as_py()
                ids, crc = encode(text) + end, zlib.crc32(text)
                for piece, at in enumerate(range(0, len(ids), most)):
                    part = ids[at:at + most]
                    row = (doc_id, crc, piece, at // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, part) if with_ids else row)
                    held += len(part) if with_ids else 0
                    if held >= 8 << 20:
                        yield table(rows)
                        rows, held = [], 0
            if rows:
                yield table(rows)

    schema = "doc_id long, text_crc32 long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(cut, schema)


def place(pieces: DataFrame, tokens: int = SEQUENCE_TOKENS, open_bins: int = OPEN_BINS, pieces_per_task: int = PIECES_PER_TASK) -> DataFrame:
    """``pieces`` (a stored table) with ``sequence_id`` and ``offset``. A repeated task places alike."""
    names = pieces.columns
    n_tasks = max(1, math.ceil(pieces.count() / pieces_per_task))
    order = F.xxhash64("doc_id", "piece", "ids_crc32")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, task = OpenBins(tokens, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(length) for length in batch["length"].to_pylist()]
            arrays = [batch[c] for c in names]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array([task + b for b, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())],
                [*names, "sequence_id", "offset"])

    dealt = pieces.withColumn("_order", order).repartition(n_tasks, "_order").sortWithinPartitions("_order", *names)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return dealt.mapInArrow(fit, f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, end_id: int, tokens: int = SEQUENCE_TOKENS, open_bins: int = OPEN_BINS,
         pieces_per_task: int = PIECES_PER_TASK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, text_crc32, piece, start, length, ids_crc32, sequence_id, offset``."""
    pieces = stored(pieces_of(docs, tokenizer, end_id, tokens, id_col, text_col), "pieces")
    return place(pieces, tokens, open_bins, pieces_per_task)


def sequences(docs: DataFrame, placed: DataFrame, tokenizer: str, end_id: int, tokens: int = SEQUENCE_TOKENS,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The packed sequences: ``sequence_id, n_tokens, ids`` (little-endian bytes). A sequence has a bounded size.

    Rows of one id and one text have the same ids, so that their places may be exchanged freely.
    """
    key = ["doc_id", "text_crc32", "piece"]
    ids = pieces_of(docs, tokenizer, end_id, tokens, id_col, text_col, with_ids=True).select(*key, "ids").dropDuplicates(key)
    ids = ids.withColumnsRenamed({c: f"_{c}" for c in key})
    same = F.lit(True)
    for c in key:
        same = same & placed[c].eqNullSafe(ids[f"_{c}"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "length")))
    whole = placed.join(ids, same).groupBy("sequence_id").agg(parts.alias("parts"))
    joined = F.aggregate("parts", F.unhex(F.lit("")), lambda done, part: F.concat(done, part["ids"]))
    return whole.select("sequence_id", F.expr("aggregate(parts, 0L, (n, p) -> n + p.length)").alias("n_tokens"), joined.alias("ids"))
