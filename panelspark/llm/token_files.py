"""Token files: independent zstandard frames, then a seek table with a checksum per frame.

A file is a run of standard zstandard frames, so any zstandard reader can decompress it whole:

* data frames: the ids of some documents, end to end, as little-endian unsigned 32-bit integers; each frame has
  zstandard's own content checksum and is followed by a skippable frame of one byte;
* a skippable frame with the seek table: a zstandard-compressed index (per frame: place, sizes, crc32 of the ids,
  number of documents; per document: id, number of ids), its length and crc32, and ``TOKSEEK1`` and a line end.

A reader takes the seek table from the end of the file and decompresses only the frames that hold the documents
it was asked for. The files are written by Spark's text writer, so that they reach any store with Spark's commit
protocol and a lost executor leaves no half file; the byte that this writer puts behind each row (a line end) is
the payload of the skippable frames.

Documents are in ascending id order over all files (null ids first; rows of one id by text). A null text is empty
and has just the end id. An empty table writes no data. Other columns are not looked at.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm.store import offsets, text_or_empty
from panelspark.llm.tokens import piece_ids

MAGIC = b"TOKSEEK1"
SKIPPABLE = 0x184D2A50
PAD = struct.pack("<II", SKIPPABLE, 1)
NO_ID = -(1 << 63)
HEAD = "<QQQ"  # number of the file, frames, documents
FOOT = "<QI8s"  # bytes and crc32 of the compressed index, magic
FRAMES = np.dtype([("at", "<u8"), ("packed", "<u4"), ("size", "<u8"), ("crc32", "<u4"), ("docs", "<u8")])
DOCS = np.dtype([("doc_id", "<i8"), ("n_tokens", "<u8")])
TEXT_BYTES_PER_FILE = 32 << 20
FRAME_BYTES = 256 << 10


def frames_of(docs: Iterable[tuple[int | None, bytes]], file_no: int, frame_bytes: int = FRAME_BYTES) -> Iterator[bytes]:
    """The frames of one file, without the byte that the writer puts behind each."""
    import zstandard

    packer = zstandard.ZstdCompressor(level=1, write_checksum=True, write_content_size=True)
    frames, rows, held, held_bytes, held_docs, at = [], [], [], 0, 0, 0

    def frame() -> bytes:
        nonlocal held, held_bytes, held_docs, at
        raw = b"".join(held)
        packed = packer.compress(raw)
        frames.append((at, len(packed), len(raw), zlib.crc32(raw), held_docs))
        at += len(packed) + len(PAD) + 1
        held, held_bytes, held_docs = [], 0, 0
        return packed + PAD

    for doc_id, ids in docs:
        held.append(ids)
        held_bytes += len(ids)
        held_docs += 1
        rows.append((NO_ID if doc_id is None else doc_id, len(ids) // 4))
        if held_bytes >= frame_bytes:
            yield frame()
    if held:
        yield frame()
    if frames:
        index = struct.pack(HEAD, file_no, len(frames), len(rows)) + np.array(frames, FRAMES).tobytes() + np.array(rows, DOCS).tobytes()
        index = packer.compress(index)
        table = index + struct.pack(FOOT, len(index), zlib.crc32(index), MAGIC)
        yield struct.pack("<II", SKIPPABLE, len(table) + 1) + table


def seek_table(content: bytes) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of the file, frames and documents, from the end of a file's bytes."""
    import zstandard

    n_bytes, crc, magic = struct.unpack_from(FOOT, content, len(content) - struct.calcsize(FOOT) - 1)
    end = len(content) - struct.calcsize(FOOT) - 1
    index = content[end - n_bytes:end]
    if magic != MAGIC or zlib.crc32(index) != crc:
        raise ValueError("damaged seek table")
    index = zstandard.ZstdDecompressor().decompress(index)
    file_no, n_frames, n_docs = struct.unpack_from(HEAD, index)
    at = struct.calcsize(HEAD) + n_frames * FRAMES.itemsize
    return file_no, np.frombuffer(index, FRAMES, n_frames, struct.calcsize(HEAD)), np.frombuffer(index, DOCS, n_docs, at)


def documents_in(content: bytes, wanted: Iterable[int] | None = None) -> Iterator[tuple[int, int, int, int | None, bytes]]:
    """``(file number, place, ids before it in the file, doc_id, ids)`` of the wanted (or all) documents of a file.

    Frames without a wanted document are not decompressed; those that are have their checksums compared.
    """
    import zstandard

    file_no, frames, docs = seek_table(content)
    pick = np.ones(len(docs), bool) if wanted is None else np.isin(docs["doc_id"], np.fromiter(wanted, np.int64))
    starts = np.cumsum(docs["n_tokens"]) - docs["n_tokens"]
    unpacker, first = zstandard.ZstdDecompressor(), 0
    for f in frames:
        last = first + int(f["docs"])
        if pick[first:last].any():
            raw = unpacker.decompress(content[int(f["at"]):int(f["at"]) + int(f["packed"])])
            if len(raw) != f["size"] or zlib.crc32(raw) != f["crc32"]:
                raise ValueError(f"damaged frame at byte {f['at']} of file {file_no}")
            for k in np.flatnonzero(pick[first:last]) + first:
                at = 4 * int(starts[k] - starts[first])
                doc_id = int(docs["doc_id"][k])
                yield file_no, int(k), int(starts[k]), None if doc_id == NO_ID else doc_id, raw[at:at + 4 * int(docs["n_tokens"][k])]
        first = last


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    text_bytes_per_file: int = TEXT_BYTES_PER_FILE, frame_bytes: int = FRAME_BYTES,
) -> None:
    """Encode all documents, append ``end_id`` to each, and write the files to ``path``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    n_bytes = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    n_files = max(1, math.ceil(n_bytes / text_bytes_per_file))
    end = int(end_id).to_bytes(4, "little")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = piece_ids(tokenizer)

        def encoded():
            for batch in batches:
                for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary())):
                    yield doc_id, ids.encode(text.as_py()) + end

        for frame in frames_of(encoded(), TaskContext.get().partitionId(), frame_bytes):
            yield pa.RecordBatch.from_arrays([pa.array([frame], pa.binary())], ["value"])

    ordered = rows.repartitionByRange(n_files, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(write, "value binary").select(F.col("value").cast("string")).write.option("lineSep", "\n").text(path)


def read_token_files(spark: SparkSession, path: str, wanted: list[int] | None = None, with_ids: bool = False) -> DataFrame:
    """Documents of the files at ``path``: ``file_no, place, doc_id, start_in_file, n_tokens, ids_crc32`` and, if
    asked for, ``ids`` (the little-endian bytes)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                content = content.as_py()
                if not content:
                    continue
                out, held = [], 0
                for file_no, place, start, doc_id, ids in documents_in(content, wanted):
                    row = (file_no, place, doc_id, start, len(ids) // 4, zlib.crc32(ids))
                    out.append((*row, ids) if with_ids else row)
                    held += len(ids) if with_ids else 0
                    if len(out) >= 10_000 or held >= 8 << 20:
                        yield table(out)
                        out, held = [], 0
                if out:
                    yield table(out)

    kinds = [("file_no", pa.int64()), ("place", pa.int64()), ("doc_id", pa.int64()), ("start_in_file", pa.int64()),
             ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * with_ids

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows), kinds)], [n for n, _ in kinds])

    files = spark.read.format("binaryFile").load(path).select("content")
    schema = "file_no long, place long, doc_id long, start_in_file long, n_tokens long, ids_crc32 long"
    return files.mapInArrow(read, schema + ", ids binary" * with_ids)


def with_starts(rows: DataFrame) -> DataFrame:
    """Add ``start``: the number of ids before a document, over all files. ``rows`` are read twice."""
    totals = rows.groupBy("file_no").agg(F.sum("n_tokens").alias("_total"))
    before = offsets(totals, "file_no", "_total", "_before")
    return rows.join(before, "file_no").withColumn("start", F.col("_before") + F.col("start_in_file")).drop("_before")
