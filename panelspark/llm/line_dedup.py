"""Line deduplication by a segment-partition edit join.

A line goes when an earlier line (by document id, hash of the text, then line number) of the corpus is equal to it or near.
Two lines are near with at most ``edits`` code points inserted, deleted or replaced, or with at most as many words
inserted, deleted or replaced as the shorter one's number of words allows: ``WORD_STEPS`` names the numbers of words from
which on one, two, ... are allowed, a twentieth of the words. Compared are lines without surrounding ASCII white space of
``min_chars`` code points or more; shorter lines stay as they are, and so do the remaining lines of a document.

1. Equal lines are found by a 128-bit hash; the first place of each is combined on the map side.
2. A line of length n is cut into one segment more than the edits that it allows, which it offers as index keys (length,
   number of the segment, hash of the segment). Lines of equal and greater length probe that index with those of their
   substrings that may match a segment given the difference in length; every pair within the distance shares a key. Lines
   of few words are sequences of code points here, longer ones sequences of words, so that keys do not grow with the
   code points that differ. One changed code point changes one word or joins or parts two, and leaves the other
   segment as it is, so that longer lines need no keys of code points.
3. Keys are kept whose smallest and largest line differ, and the texts of their lines are read again; a bitmap of
   fixed size keeps most other lines out of that join. The lines meet in units of bounded size (blocks of a
   key's lines, and pairs of blocks), where lengths and letter counts exclude most pairs and a banded bit-parallel edit
   distance, many pairs at a time, decides. A unit gives for each line the earliest near one only.

A null text has no lines. Rows of one id (or without id) are told apart by a hash of the text, and rows of one id and
text by a number given once: the first keeps what the text keeps, the others lose all compared lines as copies. Null
ids come first. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.store import free_names, stored, text_or_empty
from panelspark.llm.worker import kept

EDITS = 1
WORD_STEPS = (20, 40, 60)
MIN_CHARS = 20
BLOCK = 512
CHARS_AT_ONCE = 1 << 20
FILTER_BITS = 1 << 25
PAIRS_AT_ONCE = 4096
FEW_PAIRS = 1 << 16
FIRST = ("first_id", "first_mark", "first_no")
SPACE = " \t\r\x0b\x0c"
STEP = 0x9E3779B97F4A7C15
STEP_BACK = pow(STEP, -1, 1 << 64)
WORD_SALT = 0xC2B2AE3D27D4EB4F


def segment(n: np.ndarray, k: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of segment k of lines of length n; the later segments are longer by one where n is not a
    multiple of their number."""
    short, longer = np.divmod(n, edits + 1)
    before = np.maximum(0, k - (edits + 1 - longer))
    return k * short + before, short + (k >= edits + 1 - longer)


def powers(factor: int, n: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def step_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``STEP`` and of its inverse, computed once per worker for the longest text so far."""
    up, down = kept(("step_powers",), lambda: [powers(STEP, 1 << 21), powers(STEP_BACK, 1 << 21)])
    return (up[:n], down[:n]) if n <= len(up) else (powers(STEP, n), powers(STEP_BACK, n))


def code_points(lines: list[str]) -> np.ndarray:
    return np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)


def segment_keys(flat: np.ndarray, lengths: np.ndarray, edits_for, kinds: list[int], salt: int, indexes: np.ndarray) -> tuple:
    """Keys of sequences that lie one behind the other: key, place of the sequence, whether it is an index key.

    ``edits_for`` gives the edits that sequences of each length allow, ``kinds`` all such numbers above 0 (or 0 alone). A
    sequence looks up those of its own and smaller length: of those that are ``more`` shorter, segment k can only match
    at offsets that leave no more edits before and behind it than there are segments.
    """
    flat = flat + np.uint64(1)
    up, down = step_powers(len(flat) + 1)
    sums = np.append(np.uint64(0), np.cumsum(flat * up[:-1]))
    begins = np.cumsum(lengths) - lengths
    keys, owners, index = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
    for edits in kinds:
        for more in range(edits + 1):
            indexed = lengths - more
            allowed = (indexed > edits) & (edits_for(indexed) == edits)
            for k in range(edits + 1):
                start, size = segment(indexed, k, edits)
                for offset in range(max(-k, more - (edits - k)), min(k, more + (edits - k)) + 1):
                    at = start + offset
                    own = np.flatnonzero(allowed & (at >= 0) & (at + size <= lengths))
                    a = begins[own] + at[own]
                    part = (sums[a + size[own]] - sums[a]) * down[a]
                    keys.append(mix(part ^ mix((indexed[own] * 64 + k).astype(np.uint64) ^ np.uint64(salt))))
                    owners.append(own)
                    index.append(indexes[own] if more == 0 and offset == 0 else np.zeros(len(own), bool))
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(index)


def word_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all lines, one behind the other, and how many each line has."""
    raw = np.frombuffer("\n".join([*lines, ""]).encode("utf-8", "surrogatepass"), np.uint8)
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    before = np.append(True, blank[:-1])
    begins, ends = np.flatnonzero(~blank & before), np.flatnonzero(blank & ~before)
    up, down = step_powers(len(raw) + 1)
    sums = np.append(np.uint64(0), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1]))
    line = np.searchsorted(np.flatnonzero(raw == 10), begins)
    return mix((sums[ends] - sums[begins]) * down[begins]), np.bincount(line, minlength=len(lines))


def word_edits(n: np.ndarray, steps: tuple[int, ...]) -> np.ndarray:
    """How many words may differ where the shorter line has ``n``."""
    return np.searchsorted(np.array(steps, np.int64), n, side="right")


def keys_of(lines: list[str], edits: int, steps: tuple[int, ...] = WORD_STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all lines: key, place of the line in the list, whether it is an index key.

    Lines of fewer words than the first of ``steps`` are indexed by code points; those of one word more look them up, as
    a space may be what differs.
    """
    hashes, counts = word_hashes(lines)
    first = steps[0] if steps else np.inf
    by_chars, by_words = np.flatnonzero(counts <= first), np.flatnonzero(counts >= first)
    some = [lines[i] for i in by_chars.tolist()]
    lengths = np.array([len(x) for x in some], np.int64)
    keys, owners, index = segment_keys(
        code_points(some).astype(np.uint64), lengths, lambda n: np.full(len(n), edits), [edits], 0, counts[by_chars] < first)
    if not len(by_words):
        return keys, by_chars[owners], index
    flat = hashes[np.repeat(counts >= first, counts)]
    more = segment_keys(flat, counts[by_words], lambda n: word_edits(n, steps), [*range(1, len(steps) + 1)], WORD_SALT,
                        np.ones(len(by_words), bool))
    return np.append(keys, more[0]), np.append(by_chars[owners], by_words[more[1]]), np.append(index, more[2])


def symbols(line: str) -> np.ndarray:
    return np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)


def within(one: list[str], two: list[str], edits: int) -> np.ndarray:
    """Whether the edit distance of each pair of texts is at most ``edits``."""
    return within_symbols(list(map(symbols, one)), list(map(symbols, two)), edits)


def within_symbols(one: list[np.ndarray], two: list[np.ndarray], edits: int) -> np.ndarray:
    """Whether the edit distance of each pair of sequences is at most ``edits``. Pairs of about one length go together."""
    size = np.frexp([max(len(x), len(y)) for x, y in zip(one, two)])[1]
    found = np.zeros(len(one), bool)
    for n in np.unique(size).tolist():
        at = np.flatnonzero(size == n)
        found[at] = banded([one[k] for k in at.tolist()], [two[k] for k in at.tolist()], edits)
    return found


def banded(one: list[np.ndarray], two: list[np.ndarray], edits: int) -> np.ndarray:
    """The same for sequences of about one length: bit-parallel in a band of 2 * edits + 1 diagonals, one machine word
    per pair. Bit 63 of a column's word stands for the row ``edits`` below the diagonal."""
    if edits and min(map(len, one)) <= edits:  # a common start changes no distance, and the band begins inside the line
        start = np.full(edits, 32, np.uint32)
        one, two = [np.append(start, x) for x in one], [np.append(start, x) for x in two]
    m, n = np.array([len(x) for x in one], np.int64), np.array([len(x) for x in two], np.int64)
    ok = np.abs(m - n) <= edits
    if not ok.any():
        return ok
    if edits == 0:
        return np.array([np.array_equal(x, y) for x, y in zip(one, two)])
    pairs, width = len(one), int(max(m.max(), n.max()))
    rows = np.full((pairs, width + 2 * edits + 1), 0x110000, np.uint32)
    columns = np.full((pairs, width), 0x110001, np.uint32)
    for k in np.flatnonzero(ok).tolist():
        rows[k, edits:edits + len(one[k])] = one[k]
        columns[k, :len(two[k])] = two[k]
    rows, columns = np.ascontiguousarray(rows.T), np.ascontiguousarray(columns.T)
    u = np.uint64
    top, ones = u(1 << 63), u(0xFFFFFFFFFFFFFFFF)
    vp = np.full(pairs, (ones << u(63 - edits)) & ones, u)
    vn = np.zeros(pairs, u)
    distance = np.full(pairs, edits, np.int64)
    turn = m - edits  # from this column on the band's lowest cell moves along the last row
    for j in range(int(n[ok].max())):
        match = np.zeros(pairs, u)
        for b in range(2 * edits + 1):
            match |= (rows[j + b] == columns[j]).astype(u) << u(63 - 2 * edits + b)
        d0 = (((match & vp) + vp) ^ vp) | match | vn
        hp, hn = vn | ~(d0 | vp), d0 & vp
        active = j < n
        diagonal = j < turn
        shift = np.minimum(np.maximum(j - turn, 0), 62).astype(u)
        row = u(1 << 62) >> shift
        along = ((hp & row) != 0).astype(np.int64) - ((hn & row) != 0)
        distance += np.where(active, np.where(diagonal, ((d0 & top) == 0).astype(np.int64), along), 0)
        half = d0 >> u(1)
        vp, vn = hn | ~(half | hp), half & hp
    return ok & (distance <= edits)


def letter_counts(lines: list[str]) -> np.ndarray:
    lengths = [len(x) for x in lines]
    slot = np.repeat(np.arange(len(lines)), lengths) * 32 + (code_points(lines) & 31)
    return np.minimum(np.bincount(slot, minlength=32 * len(lines)), 255).astype(np.int16).reshape(-1, 32)


def lines_of(text: str, min_chars: int) -> list[tuple[int, str]]:
    """Number and content of the lines that are compared."""
    cut = ((k, line.strip(SPACE)) for k, line in enumerate(text.split("\n")))
    return [(k, line) for k, line in cut if len(line) >= min_chars]


def line_ids(lines: list[str]) -> np.ndarray:
    """Two 64-bit halves of each line's 128-bit hash."""
    import xxhash

    digests = b"".join(xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for x in lines)
    return np.frombuffer(digests, np.int64).reshape(-1, 2)


def bits_of(lows: DataFrame) -> bytes:
    """A bitmap of ``FILTER_BITS`` bits in which the values of ``low`` have left theirs. It bounds what is shuffled
    where it is not full; its size does not depend on the data."""
    per = 32768  # bits of one bitmap_construct_agg
    place = F.pmod("low", F.lit(FILTER_BITS))
    parts = lows.groupBy(F.floor(place / per).alias("part")).agg(F.bitmap_construct_agg(F.pmod(place, F.lit(per))).alias("bits"))
    out = bytearray(FILTER_BITS // 8)
    for row in parts.collect():
        out[row["part"] * per // 8:(row["part"] + 1) * per // 8] = row["bits"]
    return bytes(out)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_mark"), text.alias("text"))


def occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """``doc_id, text_mark, line_no, high, low`` (the halves of the line's hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks, numbers, lines = [], [], [], []
            for doc_id, mark, text in zip(batch["doc_id"].to_pylist(), batch["text_mark"].to_pylist(), batch["text"]):
                found = lines_of(text.as_py(), min_chars)
                ids += [doc_id] * len(found)
                marks += [mark] * len(found)
                numbers += [k for k, _ in found]
                lines += [line for _, line in found]
            hashes = line_ids(lines)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), pa.array(numbers, pa.int64()), pa.array(hashes[:, 0]),
                 pa.array(hashes[:, 1])], ["doc_id", "text_mark", "line_no", "high", "low"])

    return docs.mapInArrow(run, "doc_id long, text_mark long, line_no long, high long, low long")


def _lines_with(docs: DataFrame, bits: bytes, min_chars: int) -> DataFrame:
    """``doc_id, text_mark, line_no, high, low, line`` of the lines whose bit is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.frombuffer(bits, np.uint8)

        def hits(owners: list[tuple[int, int]], numbers: list[int], lines: list[str]) -> pa.RecordBatch:
            hashes = line_ids(lines)
            place = hashes[:, 1] & (FILTER_BITS - 1)
            hit = np.flatnonzero((marked[place >> 3] >> (place & 7).astype(np.uint8)) & 1)
            at = hit.tolist()
            return pa.RecordBatch.from_arrays(
                [pa.array([owners[k][0] for k in at], pa.int64()), pa.array([owners[k][1] for k in at], pa.int64()),
                 pa.array([numbers[k] for k in at], pa.int64()), pa.array(hashes[hit, 0]), pa.array(hashes[hit, 1]),
                 pa.array([lines[k] for k in at], pa.string())], ["doc_id", "text_mark", "line_no", "high", "low", "line"])

        for batch in batches:  # lines of many documents go out together
            owners, numbers, lines, chars = [], [], [], 0
            for doc_id, mark, text in zip(batch["doc_id"].to_pylist(), batch["text_mark"].to_pylist(), batch["text"]):
                found = lines_of(text.as_py(), min_chars)
                owners += [(doc_id, mark)] * len(found)
                numbers += [k for k, _ in found]
                lines += [line for _, line in found]
                chars += sum(len(line) for _, line in found)
                if chars >= CHARS_AT_ONCE:
                    yield hits(owners, numbers, lines)
                    owners, numbers, lines, chars = [], [], [], 0
            if lines:
                yield hits(owners, numbers, lines)

    return docs.mapInArrow(run, "doc_id long, text_mark long, line_no long, high long, low long, line string")


def _keys(docs: DataFrame, edits: int, min_chars: int, steps: tuple[int, ...]) -> DataFrame:
    """``key, low, indexed`` for each line and key; lines that repeat near each other count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(lines: list[str]) -> pa.RecordBatch:
            keys, owners, index = keys_of(lines, edits, steps)
            low = line_ids(lines)[:, 1]
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(low[owners]), pa.array(index)], ["key", "low", "indexed"])

        for batch in batches:
            lines, chars = {}, 0
            for text in batch["text"]:
                for _, line in lines_of(text.as_py(), min_chars):
                    if line not in lines:
                        lines[line] = None
                        chars += len(line)
                        if chars >= CHARS_AT_ONCE:
                            yield table(list(lines))
                            lines, chars = {}, 0
            if lines:
                yield table(list(lines))

    return docs.mapInArrow(run, "key long, low long, indexed boolean")


def _keys_with(keys: DataFrame, bits: bytes) -> DataFrame:
    """The keys whose bit is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.frombuffer(bits, np.uint8)
        for batch in batches:
            place = batch["key"].to_numpy() & (FILTER_BITS - 1)
            yield batch.filter(pa.array(((marked[place >> 3] >> (place & 7).astype(np.uint8)) & 1).astype(bool)))

    return keys.mapInArrow(run, "key long, low long, indexed boolean")


def _near_in_units(units: DataFrame, edits: int, steps: tuple[int, ...]) -> DataFrame:
    """``low, near_id, near_mark, near_no``: lines with an earlier line within the distance, and where that one is first."""

    def pairs_in(rows: dict, begin: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (earlier, later) of one unit's lines that lengths and roles allow, and whether they may be near by code
        points."""
        span = np.arange(begin, end)
        first, second, chars = [], [], []
        cross = rows["left"][begin] != rows["right"][begin]
        for i in span.tolist():
            later = span[span > i]  # the unit is sorted by first place
            hit = rows["indexed"][later] | rows["indexed"][i]
            if cross:
                hit &= rows["block"][later] != rows["block"][i]
            later = later[hit]
            allowed = word_edits(np.minimum(rows["words"][later], rows["words"][i]), steps)
            by_words = np.abs(rows["words"][later] - rows["words"][i]) <= allowed
            by_chars = np.abs(rows["n"][later] - rows["n"][i]) <= edits
            apart = rows["letters"][later] - rows["letters"][i]
            by_chars &= np.maximum(np.maximum(apart, 0).sum(axis=1), np.maximum(-apart, 0).sum(axis=1)) <= edits
            may = by_chars | (by_words & (allowed > 0))
            later = later[may]
            chars += by_chars[may].tolist()
            first += [i] * len(later)
            second += later.tolist()
        return np.array(first, np.int64), np.array(second, np.int64), np.array(chars, bool)

    def near(table: pa.Table) -> pa.RecordBatch | None:
        lines = table["line"].to_pylist()
        rows = {c: table[c].to_numpy(zero_copy_only=False) for c in ("key", "left", "right", "block", "indexed", "low", "first_mark", "first_no")}
        words, counts = word_hashes(lines)
        number = np.unique(words, return_inverse=True)[1].astype(np.uint32)
        ends = np.cumsum(counts).tolist()
        rows |= {"n": np.array([len(x) for x in lines], np.int64), "words": counts, "letters": letter_counts(lines), "first_id": table["first_id"].to_pylist()}
        new = (np.diff(rows["key"]) != 0) | (np.diff(rows["left"]) != 0) | (np.diff(rows["right"]) != 0)
        bounds = [0, *(np.flatnonzero(new) + 1).tolist(), len(lines)]
        found = [pairs_in(rows, begin, end) for begin, end in zip(bounds[:-1], bounds[1:])]
        first, second, chars = (np.concatenate(x) for x in zip(*found))
        allowed = word_edits(np.minimum(rows["words"][first], rows["words"][second]), steps)

        def numbers(k: int) -> np.ndarray:
            return number[ends[k] - counts[k]:ends[k]]

        def near_pairs(x: np.ndarray, y: np.ndarray, may_differ: int, by_chars: np.ndarray) -> np.ndarray:
            found = np.zeros(len(x), bool)
            if may_differ:
                found = within_symbols([numbers(k) for k in x.tolist()], [numbers(k) for k in y.tolist()], may_differ)
            rest = np.flatnonzero(~found & by_chars)
            if len(rest):
                found[rest] = within([lines[k] for k in x[rest].tolist()], [lines[k] for k in y[rest].tolist()], edits)
            return found

        best: dict[int, int] = {}
        # each line's candidates from the earliest on, one, then some, then more of them; those behind a near one are not needed
        order = np.lexsort((first, second))
        first, second, allowed, chars = first[order], second[order], allowed[order], chars[order]
        turn = np.arange(len(order)) - np.searchsorted(second, second)
        open_, at, size = np.ones(len(rows["n"]), bool), 0, 1
        while True:
            todo = np.flatnonzero((turn >= at) & open_[second])
            if not len(todo):
                break
            if len(todo) > FEW_PAIRS:
                todo = todo[turn[todo] < at + size]
            else:
                size = int(turn.max()) + 1
            todo = todo[np.lexsort((rows["n"][second[todo]], allowed[todo]))]  # pairs of about one length together
            cuts = np.searchsorted(allowed[todo], np.arange(len(steps) + 2))
            for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                for k in range(begin, end, PAIRS_AT_ONCE):
                    part = todo[k:min(k + PAIRS_AT_ONCE, end)]
                    x, y = first[part], second[part]
                    hit = near_pairs(x, y, int(allowed[part[0]]), chars[part])
                    for i, j in zip(x[hit].tolist(), y[hit].tolist()):
                        best[j] = min(i, best.get(j, i))
            open_[list(best)] = False
            at, size = at + size, 4 * size
        if not best:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(rows["low"][list(best)]), pa.array([rows["first_id"][i] for i in best.values()], pa.int64()),
             pa.array(rows["first_mark"][list(best.values())]), pa.array(rows["first_no"][list(best.values())])],
            ["low", "near_id", "near_mark", "near_no"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            last = [held[c][-1].as_py() for c in ("key", "left", "right")]
            ends = np.ones(held.num_rows, bool)
            for c, v in zip(("key", "left", "right"), last):
                ends &= held[c].to_numpy() == v
            whole = held.num_rows - int(ends.sum())  # the last unit may go on in the next batch
            if whole:
                if (found := near(held.slice(0, whole))) is not None:
                    yield found
                held = held.slice(whole)
        if held is not None and held.num_rows and (found := near(held)) is not None:
            yield found

    place = ["key", "left", "right"]
    ordered = units.repartition(*place).sortWithinPartitions(*place, "first_id", "first_mark", "first_no", "low")
    return ordered.mapInArrow(run, "low long, near_id long, near_mark long, near_no long")


def _at_first() -> Column:
    """Whether a line stands at its first place."""
    return F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_mark") == F.col("first_mark")) & (F.col("line_no") == F.col("first_no"))


def near_lines(docs: DataFrame, firsts: DataFrame, edits: int, min_chars: int, steps: tuple[int, ...] = WORD_STEPS) -> DataFrame:
    """``high, low`` of the lines with an earlier line that is near, and that line's first place. ``docs`` has
    ``doc_id, text_mark, text``; ``firsts`` has each line's hash and first place."""
    keys = stored(_keys(docs, edits, min_chars, steps), "keys", packed=False)
    shared = keys.groupBy("key").agg(F.min("low").alias("a"), F.max("low").alias("b"), F.max("indexed").alias("any"))
    shared = stored(shared.where("a != b and any").select("key"), "shared_keys")
    members = _keys_with(keys, bits_of(shared.select(F.col("key").alias("low")))).join(shared, "key").groupBy("key", "low").agg(F.max("indexed").alias("indexed"))
    members = stored(members, "key_lines")
    blocks = members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))

    wanted = stored(members.select("low").distinct().join(firsts, "low").select("high", "low", *FIRST), "wanted")
    lines = _lines_with(docs, bits_of(wanted), min_chars).join(wanted, ["high", "low"])
    lines = lines.where(_at_first())
    # the line at its first place; all copies of it are the same text
    lines = stored(lines.dropDuplicates(["high", "low"]).select("high", "low", *FIRST, "line"), "lines")

    rows = members.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("low"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    units = rows.join(lines, "low").select(
        "key", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "block", "indexed",
        "low", *FIRST, "line")
    near = _near_in_units(units, edits, steps).groupBy("low").agg(F.min(F.struct("near_id", "near_mark", "near_no")).alias("near"))
    return near.join(lines.select("high", "low"), "low").select("high", "low", "near.near_id", "near.near_mark", "near.near_no")


def line_verdicts(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text",
                  steps: tuple[int, ...] = WORD_STEPS) -> DataFrame:
    """One row per compared line of a document: ``doc_id, text_mark, line_no, copy`` (an equal line is earlier),
    ``near`` (a line within the distance of it is earlier). Rows of one id and text get the same verdicts."""
    if not 0 <= edits < min(min_chars, 32):
        raise ValueError(f"edits is {edits}; it has to be below 32 and below min_chars, {min_chars}")
    if list(steps) != sorted(set(steps)) or len(steps) > 31 or any(n <= 2 * k for k, n in enumerate(steps, 1)):
        raise ValueError(f"steps are {steps}; they have to rise, 31 at most, and be more than twice the words that may differ")
    texts = _texts(docs, id_col, text_col)
    found = stored(occurrences(texts, min_chars), "line_places")
    firsts = found.groupBy("high", "low").agg(F.min(F.struct("doc_id", "text_mark", "line_no")).alias("first"))
    firsts = firsts.select(
        "high", "low", F.col("first.doc_id").alias("first_id"), F.col("first.text_mark").alias("first_mark"), F.col("first.line_no").alias("first_no"))
    firsts = stored(firsts, "first_places")
    near = stored(near_lines(texts, firsts, edits, min_chars, steps), "near_lines")
    judged = firsts.join(near.select("high", "low", F.lit(True).alias("near")), ["high", "low"], "left")
    judged = stored(judged, "judged_lines")
    return found.join(judged, ["high", "low"]).select(
        "doc_id", "text_mark", "line_no", (~_at_first()).alias("copy"), F.coalesce("near", F.lit(False)).alias("near"))


def dedup_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text",
                counts: bool = True, steps: tuple[int, ...] = WORD_STEPS) -> DataFrame:
    """``docs`` with ``text_col`` rid of the lines that go, and with ``counts`` also ``n_copy_lines, n_near_lines``
    (lines that go because an equal one, or else a near one, is earlier) in place of columns of these names. A null
    text stays null."""
    own_id, own_mark, gone_nos, row_no = free_names(docs, "_id", "_mark", "_gone", "_row")
    verdicts = line_verdicts(docs, edits, min_chars, id_col, text_col, steps).where("copy or near")
    line_no = F.col("line_no").cast("int")
    # sets, as rows of one id and text give each verdict more than once
    gone = verdicts.groupBy(F.col("doc_id").alias(own_id), F.col("text_mark").alias(own_mark)).agg(
        F.collect_set(line_no).alias(gone_nos), F.size(F.collect_set(F.when(F.col("copy"), line_no))).cast("long").alias("n_copy_lines"))
    gone = gone.withColumn("n_near_lines", F.size(gone_nos) - F.col("n_copy_lines"))
    added = ["n_copy_lines", "n_near_lines"] if counts else []
    names = [c for c in docs.columns if c.lower() not in added]
    gone = gone.select(own_id, own_mark, gone_nos, *added)
    same = F.col(id_col).eqNullSafe(F.col(own_id)) & (F.xxhash64(text_or_empty(text_col)) == F.col(own_mark))
    lines = F.split(F.col(text_col), "\n")

    def kept_of(rows: DataFrame) -> DataFrame:
        # what goes grows with the corpus, so the same join is asked for at every size
        rows = rows.select(*names).join(gone.hint("merge"), same, "left")
        kept = F.filter(lines, lambda line, k: ~F.array_contains(F.col(gone_nos), k))
        text = F.when(F.col(gone_nos).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
        return rows.withColumn(text_col, text).select(*names, *(F.coalesce(F.col(c), F.lit(0)).alias(c) for c in added))

    repeated = _texts(docs, id_col, text_col).groupBy(F.col("doc_id").alias(own_id), F.col("text_mark").alias(own_mark)).count()
    repeated = stored(repeated.where("count > 1").select(own_id, own_mark), "repeated")
    if repeated.isEmpty():
        return kept_of(docs)
    numbered = docs.join(repeated, same, "left_semi").withColumn(row_no, F.monotonically_increasing_id())
    numbered = stored(numbered, "repeated_rows")
    firsts = numbered.groupBy(F.col(id_col), F.xxhash64(text_or_empty(text_col))).agg(F.min(row_no).alias(row_no)).select(row_no)
    later = numbered.join(firsts, row_no, "left_anti").select(*names)
    short = F.filter(lines, lambda line: F.char_length(F.btrim(line, F.lit(SPACE))) < min_chars)
    n_copies = F.coalesce(F.size(lines) - F.size(short), F.lit(0)).cast("long")
    found = {"n_copy_lines": n_copies, "n_near_lines": F.lit(0).cast("long")}
    later = later.select(
        *(F.array_join(short, "\n").alias(c) if c == text_col else F.col(c) for c in names), *(found[c].alias(c) for c in added))
    single = docs.join(repeated, same, "left_anti").unionByName(numbered.join(firsts, row_no, "left_semi").drop(row_no))
    return kept_of(single).unionByName(later)
