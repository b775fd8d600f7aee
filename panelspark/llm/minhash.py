"""Near-duplicate groups: MinHash signatures, banding, signature verification, exact confirmation, components.

Documents are linked when the Jaccard similarity of their shingle sets reaches the threshold. Work per step:

1. Each text gives one row: size and 128-bit hash of its shingle set, band keys, and a signature of many universal
   hash minima (the low byte of each). Documents of equal sets form a class at once, named by a hash of the set; its
   smallest id and a text with it speak for it.
2. Classes that share a band key are candidates. Every class is compared with the smallest of each of its buckets:
   signatures first, then the full sets of those that may reach the threshold. Linked classes form components.
3. What remains are buckets whose members are in several components. They are cut into blocks of bounded size, and
   in pairs of blocks the signatures of classes in different components are compared, each pair in its first common
   band only. Classes with a candidate get their texts, and the same pairs of blocks confirm candidates on the full
   sets, from the most similar on, until no open pair could join two more components. They put out those links alone.

Large groups of copies thus cost a comparison per member, pairs are never put out, and no bucket is cut short. The
number of rows per band is the largest for which a pair at the threshold is missed by all bands with a chance of at
most ``MISS``; the signature test lets such a pair go with a chance of at most ``MISS_TEST``.

A document without words has an empty set and is linked with nothing. With fewer words than a shingle has, the
whole sequence is the one shingle. Rows of one id and different texts are told apart by a hash of the text and judged
each by its own text. Rows without id belong to the class of an equal set if there is one with an id, and else stand
alone. An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.components import components
from panelspark.llm.store import free_names, stored, text_or_empty
from panelspark.llm.worker import kept

HASHES = 160
MISS = 1e-8
MISS_TEST = 1e-7
BLOCK = 512
PAIRS_PER_UNIT = 512
WORDS_KEPT = 500_000


def rows_per_band(percent: int, hashes: int = HASHES) -> int:
    """The largest number for which a pair at the threshold shares a band almost surely."""
    t = percent / 100
    return max((r for r in range(1, hashes + 1) if (1 - t**r) ** (hashes // r) <= MISS), default=1)


def least_matches(percent: int, hashes: int = HASHES) -> int:
    """Equal minima that a pair at the threshold reaches almost surely."""
    t, below = percent / 100, 0.0
    for m in range(hashes + 1):
        below += math.comb(hashes, m) * t**m * (1 - t) ** (hashes - m)
        if below > MISS_TEST:
            return m
    return hashes


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_hashes(text: bytes, width: int, words: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    parts = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not parts:
        return np.empty(0, np.uint64)
    one = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    n = max(1, len(one) - width + 1)
    mixed = np.zeros(n, np.uint64)
    for k in range(min(width, len(one))):
        mixed = (mixed ^ one[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed * np.uint64(0xBF58476D1CE4E5B9) ^ (mixed >> np.uint64(32)))


def shingle_set(text: bytes, width: int) -> set:
    parts = text.lower().split()
    if len(parts) <= width:
        return {tuple(parts)} if parts else set()
    return set(zip(*(parts[k:] for k in range(width))))


def minima(hashes: np.ndarray, factors: np.ndarray, shifts: np.ndarray, step: int = 1024) -> np.ndarray:
    """The smallest value of each universal hash function over the set."""
    lowest = None
    for at in range(0, len(hashes), step):
        found = (hashes[None, at:at + step] * factors + shifts).min(axis=1)
        lowest = found if lowest is None else np.minimum(lowest, found)
    return lowest >> np.uint64(24)  # the high bits are the good ones


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_mark"), text.alias("text"))


def signatures(docs: DataFrame, width: int, percent: int, hashes: int = HASHES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_mark`` (a hash of the text), ``n_shingles, set_hash`` (16 bytes), ``bands`` (a key per band),
    ``signature`` (a byte per hash); the last three are null for an empty set."""
    rows = rows_per_band(percent, hashes)
    bands = hashes // rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        words = kept(("word_hashes",), WordHashes)
        rng = np.random.Generator(np.random.Philox(2024))
        factors = rng.integers(0, 1 << 63, (hashes, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        shifts = rng.integers(0, 1 << 63, (hashes, 1), dtype=np.uint64)
        for batch in batches:
            out = []
            for doc_id, mark, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "text_mark")), batch["text"].cast(pa.binary())):
                found = shingle_hashes(text.as_py(), width, words)
                if not len(found):
                    out.append((doc_id, mark, 0, None, None, None))
                    continue
                low = minima(found, factors, shifts)
                keys = [xxhash.xxh3_64_intdigest(low[b * rows:(b + 1) * rows].tobytes(), b) - (1 << 63) for b in range(bands)]
                out.append((doc_id, mark, len(found), xxhash.xxh3_128_digest(found.tobytes()), keys, low.astype(np.uint8).tobytes()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary())
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["doc_id", "text_mark", "n_shingles", "set_hash", "bands", "signature"])

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, text_mark long, n_shingles long, set_hash binary, bands array<long>, signature binary")


def similar_signatures(pairs: DataFrame, marks: DataFrame, least: int) -> DataFrame:
    """The pairs ``a, b`` whose signatures agree often enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, two = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("one", "two"))
                yield batch.select(["a", "b"]).filter(pa.array((one == two).sum(axis=1) >= least))

    with_marks = pairs.join(marks.select(F.col("rep").alias("a"), F.col("signature").alias("one")), "a")
    with_marks = with_marks.join(marks.select(F.col("rep").alias("b"), F.col("signature").alias("two")), "b")
    return with_marks.select("a", "b", "one", "two").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` (a stored table) whose full shingle sets reach the threshold.

    The partners of an ``a`` are dealt out to units of bounded size, and each unit gets the text of ``a`` once: it
    comes first in the unit, and the others are compared with it one after the other.
    """
    degrees = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PAIRS_PER_UNIT).alias("units"))
    degrees = stored(degrees, "degrees", pairs.count())
    dealt = pairs.join(degrees, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("units")).alias("unit"))
    asked = dealt.select("a", "unit", F.col("b").alias("doc_id")).unionByName(
        dealt.select("a", "unit", F.col("a").alias("doc_id")).distinct())
    rows = asked.join(texts, "doc_id").select("a", "unit", (F.col("doc_id") != F.col("a")).alias("later"), F.col("doc_id").alias("b"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_a: set = set()
        for batch in batches:
            out = []
            for a, later, b, text in zip(*(batch[c].to_pylist() for c in ("a", "later", "b")), batch["text"].cast(pa.binary())):
                found = shingle_set(text.as_py(), width)
                if not later:
                    of_a = found
                    continue
                common = len(of_a & found)
                if 100 * common >= percent * (len(of_a) + len(found) - common):
                    out.append((a, b))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])

    ordered = rows.repartition("a", "unit").sortWithinPartitions("a", "unit", "later", "b")
    return ordered.mapInArrow(run, "a long, b long")


def _candidates(unit: pa.Table, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a unit's rows in different components whose signatures agree often enough, and how often. A pair
    that shares several buckets counts in that of its first common band only."""
    left, right, key = (unit[c][0].as_py() for c in ("left", "right", "key"))
    rep, comp, block = (unit[c].to_numpy() for c in ("rep", "component", "block"))
    marks = np.frombuffer(b"".join(unit["signature"].to_pylist()), np.uint8).reshape(len(rep), -1)
    bands = np.array(unit["bands"].to_pylist(), np.int64)
    first, second, agree = [], [], []
    for i in np.flatnonzero(block == left).tolist():
        others = np.flatnonzero((comp != comp[i]) & ((rep > rep[i]) if left == right else (block == right)))
        same = (marks[others] == marks[i]).sum(axis=1)
        others, same = others[same >= least], same[same >= least]
        shared = bands[others] == bands[i]
        here = bands[i][shared.argmax(axis=1)] == key if len(others) else np.empty(0, bool)
        first.append(np.full(int(here.sum()), i))
        second.append(others[here])
        agree.append(same[here])
    return tuple(np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64) for x in (first, second, agree))


def _with_candidates(units: DataFrame, least: int) -> DataFrame:
    """The rows of units that have a candidate in their unit."""

    def run(unit: pa.Table) -> pa.Table:
        first, second, _ = _candidates(unit, least)
        return unit.take(pa.array(np.unique(np.concatenate([first, second]))))

    return units.groupBy("key", "left", "right").applyInArrow(run, units.schema)


def _links_in_units(units: DataFrame, least: int, width: int, percent: int) -> DataFrame:
    """Links ``a, b`` that join the components of a unit, as far as its full shingle sets link them: pairs are
    confirmed from the most similar on, and those that confirmed links have joined already are left out."""

    def run(unit: pa.Table) -> pa.Table:
        first, second, agree = _candidates(unit, least)
        rep, comp = unit["rep"].to_pylist(), unit["component"].to_pylist()
        sets: dict[int, set] = {}
        parent = {c: c for c in comp}

        def root(c):
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        def of(k: int) -> set:
            if k not in sets:
                sets[k] = shingle_set(unit["text"][k].as_py().encode("utf-8", "surrogatepass"), width)
            return sets[k]

        links = []
        for k in np.argsort(-agree, kind="stable").tolist():
            i, j = int(first[k]), int(second[k])
            x, y = root(comp[i]), root(comp[j])
            if x != y:
                common = len(of(i) & of(j))
                if 100 * common >= percent * (len(of(i)) + len(of(j)) - common):
                    parent[x] = y
                    links.append((rep[i], rep[j]))
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return units.groupBy("key", "left", "right").applyInArrow(run, "a long, b long")


def _open_units(members: DataFrame, comps: DataFrame, marks: DataFrame, rows: int) -> DataFrame:
    """The members of buckets that lie in several components, in units of one or two blocks."""
    labelled = members.join(comps.select(F.col("node").alias("rep"), "component"), "rep", "left")
    labelled = stored(labelled.select("key", "rep", F.coalesce("component", "rep").alias("component")), "labelled", rows)
    still = labelled.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    still = stored(still.where("low != high").select("key", "blocks"), "open_buckets", rows)
    units = labelled.join(still, "key").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    units = units.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    units = units.select("key", "rep", "component", "block", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"))
    return units.join(marks.select("rep", "signature", "bands"), "rep")


def _judged(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_mark, n_shingles, component_id, kept``."""
    least = least_matches(percent)
    found = stored(signatures(docs, width, percent, id_col=id_col, text_col=text_col), "signatures")
    n_docs = found.count()
    speaker = F.min(F.struct("doc_id", "text_mark")).alias("of")
    classes = found.where("set_hash is not null and doc_id is not null").groupBy("set_hash").agg(speaker)
    classes = classes.select("set_hash", F.xxhash64("set_hash").alias("rep"), F.col("of.doc_id").alias("least_id"), F.col("of.text_mark").alias("mark"))
    classes = stored(classes, "classes", n_docs)
    speaks = (F.col("doc_id") == F.col("least_id")) & (F.col("text_mark") == F.col("mark")) & (F.col("set_hash") == F.col("_set"))
    marks = found.join(classes.withColumnRenamed("set_hash", "_set"), speaks)
    marks = stored(marks.dropDuplicates(["rep"]).select("rep", "bands", "signature"), "marks", 10 * n_docs)

    keys = marks.select("rep", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.min("rep").alias("leader"), F.count(F.lit(1)).alias("n"))
    buckets = stored(buckets.where("n > 1").select("key", "leader"), "buckets", n_docs)
    members = stored(keys.join(buckets, "key").where("rep != leader"), "members", n_docs)
    n_members = members.count()

    pairs = members.select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    pairs = stored(similar_signatures(pairs, marks, least), "similar_pairs")
    wanted = members.select("rep").unionByName(members.select(F.col("leader").alias("rep"))).distinct()
    wanted = wanted.join(classes, "rep").select("rep", "least_id", "mark")
    texts = _texts(docs, id_col, text_col)
    texts = texts.join(wanted, (F.col("doc_id") == F.col("least_id")) & (F.col("text_mark") == F.col("mark")))
    texts = stored(texts.groupBy(F.col("rep").alias("doc_id")).agg(F.min("text").alias("text")), "texts")

    links = stored(confirmed(pairs, texts, width, percent), "links")
    comps = stored(components(links), "components", n_members)
    units = _open_units(members.select("key", "rep"), comps, marks, n_members)
    units = stored(_with_candidates(units, least), "open_units", 20 * n_members)
    if not units.isEmpty():
        with_texts = units.join(texts, units["rep"] == texts["doc_id"]).drop("doc_id")
        more = stored(_links_in_units(with_texts, least, width, percent), "more_links", 20 * n_members)
        joined = more.unionByName(comps.select(F.col("component").alias("a"), F.col("node").alias("b")))
        comps = stored(components(joined), "components", n_members)

    ids = comps.withColumnRenamed("node", "rep").join(classes.select("rep", "least_id"), "rep")
    ids = ids.join(ids.groupBy("component").agg(F.min("least_id").alias("smallest")), "component").select("rep", "smallest")
    result = found.join(classes.select("set_hash", "rep", "least_id"), "set_hash", "left").join(ids, "rep", "left")
    component = F.coalesce("smallest", "least_id", "doc_id")
    return result.select("doc_id", "text_mark", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id`` (the smallest id reachable), ``kept``."""
    return _judged(docs, width, percent, id_col, text_col).drop("text_mark")


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one document of each component, with all their columns. Rows of one id, and
    rows without id, are told apart by a hash of their texts."""
    gone = _judged(docs, width, percent, id_col, text_col).where(~F.col("kept"))
    own_id, own_mark = free_names(docs, "_gone", "_mark")
    gone = gone.select(F.col("doc_id").alias(own_id), F.col("text_mark").alias(own_mark)).distinct()
    same = docs[id_col].eqNullSafe(F.col(own_id)) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == F.col(own_mark))
    return docs.join(gone, same, "left_anti")
