import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from panelspark.llm import quality_rules as rules
from panelspark.llm.store import stored
from tests.llm.conftest import AWKWARD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    out = []
    for doc_id, text in rows:
        text = text or ""
        words = WORD.findall(text)
        windows = list(zip(words, words[1:], words[2:]))
        often = Counter(windows)
        repeated = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        out.append((doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)))
    return sorted(out, key=repr)


def counts(df):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return sorted((tuple(r) for r in df.select(names).collect()), key=repr)


LINES = [
    (1, "a b c a b c a b c"), (2, "a b c x a b c"), (3, "a a a a a"), (4, "a a a"), (5, "a b c d e"), (6, "x\ny\nx\n\n \n \nx "),
    (7, "#*$%&|<> ok"), (8, " lead and trail \t"), (9, "a\x0bb\x0cc\rd\x1ce\xa0f"), (10, "Ä ö \U0001f600"),
]


@pytest.mark.parametrize("kind", ["documents", "awkward", "lines"])
def test_statistics(frame, documents, kind):
    rows = {"documents": documents, "awkward": AWKWARD, "lines": LINES}[kind]
    assert counts(rules.statistics(frame(rows))) == brute(rows)


def test_base_limits(frame):
    rows = [(1, " ".join(f"w{k}" for k in range(50))), (2, " ".join(f"w{k}" for k in range(49))), (3, "a b c " * 40)]
    df = rules.judge(rules.statistics(frame(rows)), [])
    assert {r["doc_id"]: (r["base_failed"], r["kept"]) for r in df.collect()} == {1: (False, True), 2: (True, False), 3: (True, False)}


def made(n, first=0):
    """Good prose, and bad texts of two kinds."""
    rows, labels = [], []
    for k in range(first, first + n):
        words = [f"{'abcdefghij'[(k * 7 + j * j) % 10]}ord{(k * 31 + j * 17) % 997}" for j in range(60 + k % 40)]
        kind = k % 5
        if kind == 1:
            words = [w + "%%%" for w in words]
        if kind == 2:
            words = [w.upper() for w in words]
        rows.append((k, " ".join(words)))
        labels.append((k, int(kind not in (1, 2))))
    return rows, labels


def test_learned_rules_hold_on_unseen_documents(spark, frame):
    rows, labels = made(600)
    known = spark.createDataFrame(labels[:400], "doc_id long, quality int")
    verdicts = {r["doc_id"]: r for r in rules.quality_verdicts(frame(rows), known).collect()}
    unseen = [(verdicts[i]["kept"], bool(q)) for i, q in labels[400:]]
    assert sum(a == b for a, b in unseen) >= 0.98 * len(unseen)
    assert {verdicts[i]["rule"] for i, _ in labels} >= {None, 1, 2}


def test_rules_are_ordered_conditions(spark, frame):
    rows, labels = made(300)
    stats = stored(rules.statistics(frame(rows)), "statistics")
    learned = rules.learn_rules(stats, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert 2 <= len(learned) <= 12 and all(1 <= len(r) <= 4 for r in learned)
    again = rules.learn_rules(stats.repartition(7), spark.createDataFrame(labels, "doc_id long, quality int").repartition(5))
    assert again == learned


def test_labels_without_use(spark, frame):
    rows, _ = made(60)
    for labels in ([], [(None, 0), (1, None), (10**9, 0)], [(k, 1) for k in range(60)], [(k, 0) for k in range(60)]):
        df = rules.quality_verdicts(frame(rows), spark.createDataFrame(labels, "doc_id long, quality int"))
        assert df.where("kept").count() == 60


def test_repeated_labels_count_once(spark, frame):
    rows, labels = made(300)
    df = lambda x: spark.createDataFrame(x, "doc_id long, quality int")
    stats = stored(rules.statistics(frame(rows)), "statistics")
    assert rules.learn_rules(stats, df(labels)) == rules.learn_rules(stats, df(labels * 3 + [(i, 1) for i, _ in labels]))


def test_rows_that_stay_keep_their_columns(spark, frame):
    rows, labels = made(100)
    docs = frame(rows + [(None, None), (None, rows[0][1]), (0, rows[0][1]), (3, "short")]).withColumnRenamed("lang", "kept").withColumnRenamed("source", "n_words")
    out = rules.keep_good(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert out.columns == docs.columns
    kept = Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert kept[None, rows[0][1]] == 1 and kept[0, rows[0][1]] == 2 and (3, "short") not in kept and (None, None) not in kept


def test_empty_table(spark, frame):
    assert rules.quality_verdicts(frame([]), spark.createDataFrame([], "doc_id long, quality int")).collect() == []


def test_no_python_on_the_executors(spark, frame):
    plan = rules.statistics(frame(LINES)).where(F.col("n_words") > 1)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
