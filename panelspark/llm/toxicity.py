"""Toxicity by class-conditional Kneser-Ney models of the characters of words.

1. Labelled documents are dealt by ``crc32`` of their id: one part is held out, one calibrates, the others are counted.
   An expression is a word (lower-cased, cut at ASCII white space) with marks at its start and end; it counts once per
   document, in the class of that document.
2. The probability of a character after the up to ``ORDER - 1`` before it is, in each class, the discounted count of
   the class plus, with the mass set aside and ``STRENGTH`` more, the probability of both classes together; that one
   backs off to the shared continuation counts (numbers of different characters to the left) of shorter and shorter
   contexts. A rare expression is thus judged by counts that the classes share, and an unknown context not at all.
   Discounts are estimated from numbers of grams seen once, twice, ... (modified Kneser-Ney).
3. A word's log-likelihood ratio is that of all its characters. A toxic document is mostly ordinary words, so a word
   adds ``log(1 - SHARE + SHARE * ratio)``; the sum over the different words of the whole text is divided by their
   number and by its root. These two and the highest ratio enter a logistic curve, fitted on at most
   ``CALIBRATION_ROWS`` labelled documents of the second part (the smallest by a hash of the id).

All counts are Spark aggregates over all labelled documents. The model is one table of hashed grams; with up to
``SHIPPED_ROWS`` rows it is sent to the tasks, with more the words of all documents are joined to it. Both give equal
scores. Two grams share a 64-bit key with a chance of about n * n / 4e19.

A null text is empty; an empty text has three zeros as features. Rows of one id are scored each by its own text, and
all count with the label of the id; several labels of an id count as the highest. A null id has no label and is not
held out. Without labels of both classes the score is the share of toxic labels (0 without labels). Only
``id_col`` and ``text_col`` are read, whatever other columns there are; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.store import stored, text_or_empty
from panelspark.llm.worker import kept

ORDER = 6
STRENGTH = 20.0
SHARE = 0.01
PARTS, HELD_OUT, CALIBRATES = 4, 2, 3
CALIBRATION_ROWS = 20_000
SHIPPED_ROWS = 4_000_000
WORDS_KEPT = 400_000
WORDS_AT_ONCE = 50_000
WORD_START, WORD_END = "\n", "\r"  # no word holds them
FACTOR, LENGTH_FACTOR, CONTEXT_MARK = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
FEATURES = ("mean_ratio", "root_ratio", "top_ratio")


def part_of(id_col: str = "doc_id") -> Column:
    """The part of a labelled document: ``HELD_OUT``, ``CALIBRATES`` or another, which is counted."""
    return F.crc32(F.col(id_col).cast("string")) % PARTS


def words_of(text: Column) -> Column:
    """The different words of a text."""
    return F.array_distinct(F.filter(F.split(F.lower(text), "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))


def gram_key(gram: str) -> int:
    """The key of one gram."""
    key = len(gram) * LENGTH_FACTOR
    for k, letter in enumerate(reversed(gram)):
        key += (ord(letter) + 1) * FACTOR ** k
    return key % (1 << 64)


class Grams:
    """Hashed grams of many words at once: ``keys[k]`` holds the gram of k characters that ends at a position."""

    def __init__(self, words: list[str], order: int = ORDER):
        flat = (WORD_START + (WORD_END + WORD_START).join(words) + WORD_END).encode("utf-32-le", "surrogatepass")
        flat = np.frombuffer(flat, "<u4").astype(np.uint64) + np.uint64(1)
        begins = np.flatnonzero(flat == ord(WORD_START) + 1)
        n = len(flat)
        place = np.arange(n) - np.repeat(begins, np.diff(np.append(begins, n)))
        with np.errstate(over="ignore"):
            self.keys, power, whole = [np.zeros(n, np.uint64)], np.uint64(1), np.zeros(n, np.uint64)
            for k in range(1, order + 1):
                whole = whole.copy()
                whole[k - 1:] += flat[:max(0, n - k + 1)] * power
                power = power * np.uint64(FACTOR)
                self.keys.append(whole + np.uint64(k * LENGTH_FACTOR % (1 << 64)))
        self.position = np.flatnonzero(place > 0)  # a start has no context
        self.top = np.minimum(place[self.position] + 1, order)
        self.word = np.repeat(np.arange(len(words)), np.diff(np.append(begins, n)) - 1)

    def gram(self, k: int) -> np.ndarray:
        """Keys of the k characters up to each position."""
        return self.keys[k][self.position].view(np.int64)

    def context(self, k: int) -> np.ndarray:
        """Keys of the k - 1 characters before each position."""
        return (self.keys[k - 1][self.position - 1] ^ np.uint64(CONTEXT_MARK)).view(np.int64)

    def at_top(self, of) -> np.ndarray:
        out = np.empty(len(self.position), np.int64)
        for k in range(2, len(self.keys)):
            out = np.where(self.top == k, of(k), out)
        return out


# -- fitting ------------------------------------------------------------------------------------


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``words, toxic`` of the documents that are counted."""
    known = class_of(labels, id_col).filter(~part_of("label_id").isin(HELD_OUT, CALIBRATES))
    rows = docs.select(F.col(id_col).cast("string").alias("id"), text_or_empty(text_col).alias("text"))
    rows = rows.filter(~part_of("id").isin(HELD_OUT, CALIBRATES))
    return rows.join(known, rows["id"] == known["label_id"]).select(words_of(F.col("text")).alias("words"), "toxic")


def class_of(labels: DataFrame, id_col: str) -> DataFrame:
    known = labels.select(F.col(id_col).cast("string").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
    return known.filter("label_id IS NOT NULL AND toxic IS NOT NULL").groupBy("label_id").agg(F.max("toxic").alias("toxic"))


def grams_of(words: DataFrame, order: int) -> DataFrame:
    """``gram, n_toxic, n_ordinary``: for each character of a word and its end mark, the up to ``order`` characters that
    end with it."""
    marked = F.concat(F.lit(WORD_START), "word", F.lit(WORD_END))
    ends = F.explode(F.sequence(F.lit(2), F.char_length("marked"))).alias("i")
    rows = words.select(marked.alias("marked"), "n_toxic", "n_ordinary").select("marked", "n_toxic", "n_ordinary", ends)
    first = F.greatest(F.lit(1), F.col("i") - order + 1)
    gram = F.col("marked").substr(first, F.col("i") - first + 1)
    return rows.groupBy(gram.alias("gram")).agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_ordinary").alias("n_ordinary"))


def without_last(gram: str) -> Column:
    return F.col(gram).substr(F.lit(1), F.char_length(gram) - 1)


def discounts(counts: list[int]) -> list[float]:
    """Modified Kneser-Ney: what is taken off a count of 1, 2 and more, given how many grams were seen 1 to 4 times."""
    n = [max(1, c) for c in counts]
    base = n[0] / (n[0] + 2 * n[1])
    return [min(i, max(0.0, i - (i + 1) * base * n[i] / n[i - 1])) for i in (1, 2, 3)]


def seen(column: str) -> list[Column]:
    return [F.count_if(F.col(column) == i).alias(f"{column}_{i}") for i in range(1, 5)]


def taken(column: str, row) -> Column:
    """The discount of each row's count."""
    one, two, more = map(F.lit, discounts([row[f"{column}_{i}"] for i in range(1, 5)]))
    n = F.col(column)
    return F.when(n <= 0, F.lit(0.0)).when(n == 1, one).when(n == 2, two).otherwise(more)


def shared_backoff(grams: DataFrame) -> DataFrame:
    """``gram, shared``: the probability of each gram's last character by the continuation counts of its shorter ends."""
    rest = F.char_length("gram")
    parts = grams.select("gram", F.explode(F.sequence(F.lit(2), rest)).alias("i")).select(
        "gram", "i", F.col("gram").substr(F.col("i"), rest).alias("end"), F.col("gram").substr(F.col("i") - 1, rest).alias("longer"))
    counted = parts.select("end", "longer").distinct().groupBy("end").agg(F.count(F.lit(1)).alias("n"))
    counted = stored(counted.withColumn("context", without_last("end")), "toxic_continuations")
    row = counted.agg(*seen("n"), F.count_if(F.col("context") == "").alias("letters")).first()
    counted = counted.withColumn("off", taken("n", row))
    totals = counted.groupBy("context").agg(F.sum("n").alias("total"), F.sum("off").alias("off_total"))
    terms = counted.join(totals, "context").select(
        "end", ((F.col("n") - F.col("off")) / F.col("total")).alias("own"), (F.col("off_total") / F.col("total")).alias("rest"))
    steps = parts.select("gram", "i", "end").join(terms, "end").groupBy("gram").agg(
        F.sort_array(F.collect_list(F.struct("i", "own", "rest")), asc=False).alias("steps"))  # at most ORDER - 1
    shared = F.aggregate("steps", F.lit(1.0 / max(1, row["letters"])), lambda p, s: s["own"] + s["rest"] * p)
    return steps.select("gram", shared.alias("shared"))


def hashed(model: DataFrame) -> DataFrame:
    """``key, ratio`` of ``gram, is_context, ratio``, with the keys that :class:`Grams` gives to words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [gram_key(g) for g in batch["gram"].to_pylist()]
            mark = np.where(batch["is_context"].to_numpy(zero_copy_only=False), np.uint64(CONTEXT_MARK), np.uint64(0))
            keys = (np.array(keys, np.uint64) ^ mark).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), batch["ratio"]], ["key", "ratio"])

    return model.select("gram", "is_context", "ratio").mapInArrow(run, "key long, ratio double")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
        strength: float = STRENGTH) -> DataFrame:
    """The model (stored): ``key, ratio``, a log ratio of toxic and ordinary probability for every gram seen, and for
    every context for characters not seen after it."""
    rows = labelled(docs, labels, id_col, text_col).select(F.explode("words").alias("word"), "toxic")
    words = rows.groupBy("word").agg(
        F.sum("toxic").alias("n_toxic"), F.sum(1 - F.col("toxic")).cast("long").alias("n_ordinary"))
    grams = grams_of(words, order).withColumns(
        {"n_both": F.col("n_toxic") + F.col("n_ordinary"), "context": without_last("gram")})
    grams = stored(grams, "toxic_grams")
    kinds = ("toxic", "ordinary", "both")
    row = grams.agg(*[c for k in kinds for c in seen(f"n_{k}")]).first()
    counts = grams.withColumns({f"off_{k}": taken(f"n_{k}", row) for k in kinds})
    contexts = counts.groupBy("context").agg(*[F.sum(f"{m}_{k}").alias(f"{m}_total_{k}") for m in ("n", "off") for k in kinds])
    joined = counts.join(contexts, "context").join(shared_backoff(grams), "gram")
    both = ((F.col("n_both") - F.col("off_both")) + F.col("off_total_both") * F.col("shared")) / F.col("n_total_both")

    def probability(kind: str, backoff: Column) -> Column:
        own, rest = F.col(f"n_{kind}") - F.col(f"off_{kind}"), F.col(f"off_total_{kind}") + strength
        return (own + rest * backoff) / (F.col(f"n_total_{kind}") + strength)

    def set_aside(kind: str) -> Column:
        return (F.col(f"off_total_{kind}") + strength) / (F.col(f"n_total_{kind}") + strength)

    by_gram = joined.select(
        "gram", F.lit(False).alias("is_context"), F.log(probability("toxic", both) / probability("ordinary", both)).alias("ratio"))
    by_context = contexts.select(
        F.col("context").alias("gram"), F.lit(True).alias("is_context"),
        F.log(set_aside("toxic") / set_aside("ordinary")).alias("ratio"))
    return stored(hashed(by_gram.unionByName(by_context)), "toxic_model")


# -- scoring ------------------------------------------------------------------------------------


class Ratios:
    """Log ratios of words by the shipped model, those of frequent words remembered."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, order: int):
        self.keys, self.values, self.order = keys, values, order
        self.known: dict[bytes, float] = {}

    def found(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        return hit, np.where(hit, self.values[at], 0.0)

    def learn(self, words: list[bytes]) -> None:
        if len(self.known) > WORDS_KEPT:
            self.known.clear()
        for i in range(0, len(words), WORDS_AT_ONCE):
            some = words[i:i + WORDS_AT_ONCE]
            grams = Grams([w.decode("utf-8", "replace") for w in some], self.order)
            hit, value = self.found(grams.at_top(grams.gram))
            miss = np.flatnonzero(~hit)
            value[miss] = self.found(grams.at_top(grams.context)[miss])[1]
            self.known.update(zip(some, np.bincount(grams.word, value, len(some)).tolist()))

    def of(self, words: list[bytes]) -> np.ndarray:
        new = [w for w in words if w not in self.known]
        if new:
            self.learn(new)
            if len(new) < len(words):  # the others may just have been forgotten
                lost = [w for w in words if w not in self.known]
                if lost:
                    self.learn(lost)
        return np.array([self.known[w] for w in words])


def features_by_tasks(docs: DataFrame, model: DataFrame, order: int = ORDER, share: float = SHARE) -> DataFrame:
    """``doc_id, mean_ratio, root_ratio, top_ratio`` with the model sent to every task."""
    table = model.toArrow()
    keys, values = table["key"].to_numpy(), table["ratio"].to_numpy()
    at = np.argsort(keys)
    shipped, name = docs.sparkSession.sparkContext.broadcast((keys[at], values[at])), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = kept(("toxic_ratios", name), lambda: Ratios(*shipped.value, order))
        for batch in batches:
            out = []
            for text in batch["text"].cast(pa.binary()):
                words = list(set(text.as_py().split()))
                if not words:
                    out.append((0.0, 0.0, 0.0))
                    continue
                ratio = ratios.of(words)
                total = float(np.log1p(share * np.expm1(ratio)).sum())
                out.append((total / len(words), total / math.sqrt(len(words)), max(0.0, float(ratio.max()))))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(c, pa.float64()) for c in (zip(*out) if out else ((),) * 3))],
                ["doc_id", *FEATURES])

    return docs.select("doc_id", F.lower("text").alias("text")).mapInArrow(
        run, "doc_id long, mean_ratio double, root_ratio double, top_ratio double")


def features_by_join(docs: DataFrame, model: DataFrame, order: int = ORDER, share: float = SHARE) -> DataFrame:
    """The same with a model of any size: the different words of all documents are joined to it."""
    marked = stored(docs.select("doc_id", F.expr("uuid()").alias("mark"), words_of(F.col("text")).alias("words")), "toxic_words")
    used = marked.select("mark", F.explode("words").alias("word")).select("mark", "word", F.unhex(F.md5("word")).alias("word_key"))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                grams = Grams(batch["word"].to_pylist(), order)
                yield pa.RecordBatch.from_arrays(
                    [batch["word_key"].take(pa.array(grams.word)), pa.array(grams.at_top(grams.gram)),
                     pa.array(grams.at_top(grams.context))], ["word_key", "gram", "context"])

    distinct = used.groupBy("word_key").agg(F.any_value("word").alias("word"))
    placed = distinct.mapInArrow(keys, "word_key binary, gram long, context long")
    by_gram = model.select(F.col("key").alias("gram"), F.col("ratio").alias("of_gram"))
    by_context = model.select(F.col("key").alias("context"), F.col("ratio").alias("of_context"))
    ratios = placed.join(by_gram, "gram", "left").join(by_context, "context", "left").groupBy("word_key").agg(
        F.sum(F.coalesce("of_gram", "of_context", F.lit(0.0))).alias("ratio"))
    sums = used.select("mark", "word_key").join(ratios, "word_key").groupBy("mark").agg(
        F.sum(F.log1p(share * F.expm1("ratio"))).alias("total"), F.count(F.lit(1)).alias("n"), F.max("ratio").alias("most"))
    zero = F.lit(0.0)
    return marked.join(sums, "mark", "left").select(
        "doc_id", F.coalesce(F.col("total") / F.col("n"), zero).alias("mean_ratio"),
        F.coalesce(F.col("total") / F.sqrt("n"), zero).alias("root_ratio"),
        F.greatest(F.coalesce("most", zero), zero).alias("top_ratio"))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> tuple[np.ndarray, float]:
    """Weights and intercept by Newton's method on standardised columns."""
    mean, spread = x.mean(0), np.where(x.std(0) > 0, x.std(0), 1.0)
    z, w = np.c_[np.ones(len(x)), (x - mean) / spread], np.zeros(x.shape[1] + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + penalty * np.eye(len(w)), z.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w[1:] / spread, float(w[0] - (w[1:] * mean / spread).sum())


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
             strength: float = STRENGTH, share: float = SHARE, shipped_rows: int = SHIPPED_ROWS) -> DataFrame:
    """``doc_id, held_out, score, mean_ratio, root_ratio, top_ratio``: one row per row of ``docs``."""
    model = fit(docs, labels, id_col, text_col, order, strength)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    features = features_by_tasks if model.count() <= shipped_rows else features_by_join
    found = stored(features(rows, model, order, share), "toxic_features")
    known = class_of(labels, id_col).filter(part_of("label_id") == CALIBRATES)
    sample = known.orderBy(F.xxhash64("label_id"), "label_id").limit(CALIBRATION_ROWS)
    one_each = found.groupBy("doc_id").agg(F.max(F.struct(*FEATURES)).alias("best")).select("doc_id", "best.*")
    fitted = one_each.join(F.broadcast(sample), F.col("doc_id").cast("string") == F.col("label_id")).select(*FEATURES, "toxic")
    table = fitted.toArrow().to_pandas()  # at most CALIBRATION_ROWS rows
    x, y = table[list(FEATURES)].to_numpy(float), table["toxic"].to_numpy(float)
    if len(set(y.tolist())) == 2:
        weights, base = logistic(x, y)
        line = sum((F.col(c) * F.lit(float(w)) for c, w in zip(FEATURES, weights)), F.lit(base))
        score = 1 / (1 + F.exp(-line))
    else:
        score = F.lit(float(y.mean()) if len(y) else 0.0)
    held = F.coalesce(part_of() == HELD_OUT, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), score.alias("score"), *FEATURES)
