import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.llm import queries, toxicity
from panelspark.llm.store import text_or_empty
from tests.llm.conftest import AWKWARD, SCHEMA

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, toxic int"


class Slow:
    """The model in plain dictionaries, by strings."""

    def __init__(self, docs, labels, order=toxicity.ORDER):
        words, self.order = {0: collections.Counter(), 1: collections.Counter()}, order
        for i, text in docs:
            if i in labels and zlib.crc32(str(i).encode()) % 4 not in (2, 3):
                words[labels[i]].update(set(WORD.findall((text or "").lower())))
        self.counts = [collections.Counter(), collections.Counter()]
        for kind, counter in words.items():
            for word, n in counter.items():
                for gram in self.grams(word):
                    self.counts[kind][gram] += n
        both = self.counts[0] + self.counts[1]
        longer = collections.defaultdict(set)
        for gram in both:
            for k in range(1, len(gram)):
                longer[gram[k:]].add(gram[k - 1:])
        self.letters = len({g for g in longer if len(g) == 1})
        self.low, self.both = self.level({g: len(s) for g, s in longer.items()}), self.level(both)
        self.classes = list(map(self.level, self.counts))

    def grams(self, word):
        marked = f"\n{word}\r"
        return [marked[max(0, i - self.order + 1):i + 1] for i in range(1, len(marked))]

    def level(self, counts):
        off = [0.0, *toxicity.discounts([sum(n == k for n in counts.values()) for k in range(1, 5)])]
        total, aside = collections.Counter(), collections.Counter()
        for gram, n in counts.items():
            total[gram[:-1]] += n
            aside[gram[:-1]] += off[min(n, 3)]
        return counts, off, total, aside

    def backed(self, level, gram, backoff, strength=0.0):
        counts, off, total, aside = level
        n, t, a = counts.get(gram, 0), total[gram[:-1]], aside[gram[:-1]]
        return (n - off[min(n, 3)] + (a + strength) * backoff) / (t + strength)

    def shared(self, gram):
        return self.backed(self.low, gram, self.shared(gram[1:])) if gram else 1 / self.letters

    def ratio(self, word):
        total = 0.0
        for gram in self.grams(word):
            if self.both[2][gram[:-1]]:
                seen = gram in self.both[0]  # what is not cancels out but for the mass set aside
                p = self.backed(self.both, gram, self.shared(gram[1:])) if seen else 1e-9
                ordinary, toxic = (self.backed(c, gram, p, toxicity.STRENGTH) for c in self.classes)
                total += math.log(toxic / ordinary)
        return total

    def features(self, text):
        ratios = [self.ratio(w) for w in set(WORD.findall((text or "").lower()))]
        if not ratios:
            return 0.0, 0.0, 0.0
        total = sum(math.log(1 - toxicity.SHARE + toxicity.SHARE * math.exp(r)) for r in ratios)
        return total / len(ratios), total / math.sqrt(len(ratios)), max(0.0, *ratios)


@pytest.fixture(scope="module")
def labels(spark, sf):
    return spark.read.parquet(f"{sf}/labels.parquet")


def test_features_by_both_ways_against_dictionaries(spark, sf, labels, documents):
    known = {r.doc_id: r.toxic for r in labels.collect()}
    slow = Slow(documents, known)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity.fit(docs, labels)
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    for way in (toxicity.features_by_tasks, toxicity.features_by_join):
        got = {r.doc_id: (r.mean_ratio, r.root_ratio, r.top_ratio) for r in way(rows, model).collect()}
        assert len(got) == len(documents)
        for i, text in documents[:120]:
            assert got[i] == pytest.approx(slow.features(text), rel=1e-9, abs=1e-9)


def test_probabilities_add_up(documents, spark, labels):
    slow = Slow(documents, {r.doc_id: r.toxic for r in labels.collect()})
    letters = {g for g in slow.low[0] if len(g) == 1}
    for context in ("", "e", "th", "ent"):
        assert sum(slow.shared(context + x) for x in letters) == pytest.approx(1)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = queries.op13(spark, sf)
    assert rows.count() == 10_000
    held = rows.filter("held_out").join(labels, "doc_id").toPandas()
    rank, toxic = held["score"].rank(), held["toxic"] == 1
    area = (rank[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / toxic.sum() / (~toxic).sum()
    assert area > 0.93
    assert held["predicted"][toxic].mean() > 0.8 and held["predicted"][~toxic].mean() < 0.04
    assert held["score"].between(0, 1).all() and (held["predicted"] == (held["score"] >= 0.3)).all()


def test_held_out_labels_are_not_read(spark, sf, labels):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    turned = labels.withColumn("toxic", F.when(toxicity.part_of() == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, toxicity.toxicity(docs, x).select("doc_id", "score").collect())) for x in (labels, turned))
    assert [i for i, _ in a] == [i for i, _ in b] and [s for _, s in a] == pytest.approx([s for _, s in b])


def test_awkward_rows(spark, frame):
    docs = frame(AWKWARD + [(i, "you idiot " * 3 if i % 3 == 0 else "a kind word") for i in range(20, 60)])
    docs = docs.withColumns({"toxic": F.lit(7), "word": F.lit("w"), "key": F.lit("k"), "label_id": F.lit("x"), "score": F.lit("s")})
    labels = spark.createDataFrame(
        [(i, int(i % 3 == 0)) for i in range(20, 60)] + [(None, 1), (1, None), (4, 0), (4, 1), (999, 1)], LABELS)
    for rows in (1, 1 << 30):
        got = toxicity.toxicity(docs, labels, shipped_rows=rows).collect()
        assert len(got) == len(AWKWARD) + 40
        by_id = {r.doc_id: r for r in got}
        assert by_id[None].held_out is False and 0 <= by_id[2].score <= 1 and by_id[1].score == by_id[2].score
        assert by_id[21].score > by_id[20].score
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in toxicity.toxicity(docs, none).collect()} == {0.0}
    assert toxicity.toxicity(spark.createDataFrame([], SCHEMA), labels).count() == 0


def test_discounts_and_curve():
    one, two, more = toxicity.discounts([100, 40, 20, 12])
    base = 100 / 180
    assert (one, two, more) == pytest.approx((1 - 2 * base * 0.4, 2 - 3 * base * 0.5, 3 - 4 * base * 0.6))
    assert toxicity.discounts([0, 0, 0, 0]) == pytest.approx([1 / 3, 1, 5 / 3])
    x = np.array([[-2.0], [-1], [1], [2]])
    weights, base = toxicity.logistic(x, np.array([0.0, 0, 1, 1]))
    assert weights[0] > 0 and abs(base) < 1e-6
