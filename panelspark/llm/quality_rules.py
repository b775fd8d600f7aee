"""Quality rules: a decision list learned by sequential covering, over statistics that Spark computes per document.

DataFrame functions only. Fixed base limits fail documents first. The learned list then rejects documents: each rule
is a conjunction of thresholds on the statistics, grown on two thirds of the labelled rows by information gain,
pruned on the other third, and kept only if it is precise there; the rows that it covers leave before the next rule
grows. The list is emitted as one ordered conditional expression.

Learning reads counts per statistic and interval only, of a bounded number of labelled rows (``LABELLED_ROWS``,
chosen by a hash of the id). A null text has no words. Labels that are null or of unknown documents are ignored; of
several labels of one id the lowest counts. Without labels there are no rules and the base limits decide. Repeated
rows get the same verdict. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.store import free_names, let, stored, text_or_empty

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 3
MIN_WORDS = 50
LABELLED_ROWS = 20_000
THRESHOLDS = 32


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more in the text.

    Windows are sorted with their places; those equal to a neighbour are repeated, and each of them adds the words
    that the next repeated window does not cover.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.struct(F.concat_ws(" ", *(F.get(words, i + k) for k in range(WINDOW))).alias("words"), i.alias("at")))

    def places(found: Column) -> Column:
        same = lambda x, k: (x["words"] == F.get(found, k + 1)["words"]) | (x["words"] == F.get(found, k - 1)["words"])
        return F.sort_array(F.transform(F.filter(found, same), lambda x: x["at"]))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    count = let(F.sort_array(windows), lambda found: let(places(found), covered))
    return F.when(F.size(words) > WINDOW, count).otherwise(F.lit(0))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the counts of each whole text (long), and ``text_mark``, a hash of it."""
    text = F.col("text")
    of_words = let(words_of(text), lambda w: F.struct(
        F.size(w).alias("n_words"), F.char_length(F.array_join(w, "")).alias("word_chars"),
        F.size(F.array_distinct(w)).alias("n_distinct_words"), repeated_words(w).alias("n_repeat_words")))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_SPACE))
    of_lines = let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).select(
        "doc_id", of_words.alias("w"), of_lines.alias("l"), F.regexp_count(text, F.lit(SYMBOLS)).alias("n_symbols"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).alias("n_upper"), F.regexp_count(text, F.lit(r"[!-/:-@\[-`{-~]")).alias("n_marks"),
        F.xxhash64(text).alias("text_mark"))
    names = ["w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "w.n_distinct_words", "l.n_lines", "n_upper", "n_marks", "text_mark"]
    return rows.select("doc_id", *(F.col(c).cast("long").alias(c.split(".")[-1]) for c in names))


def features() -> dict[str, Column]:
    """The statistics that rules may use, independent of a text's length."""

    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return {
        "symbols_per_word": share("n_symbols", "n_words"), "marks_per_word": share("n_marks", "n_words"),
        "upper_share": share("n_upper", "word_chars"), "word_length": share("word_chars", "n_words"),
        "repeated_share": share("n_repeat_words", "n_words"), "distinct_share": share("n_distinct_words", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"), "words_per_line": share("n_words", "n_lines"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)


Rule = tuple[Condition, ...]


def decision(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, from 1; null where none does."""
    number = None
    for k, rule in enumerate(rules, 1):
        holds = reduce(lambda a, b: a & b, (c.column() for c in rule))
        number = F.when(holds, k) if number is None else number.when(holds, k)
    return F.lit(None).cast("int") if number is None else number


def learn_rules(
    stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", labelled_rows: int = LABELLED_ROWS,
    min_precision: float = 0.95, min_covered: int = 5, most_rules: int = 12, most_conditions: int = 4,
) -> list[Rule]:
    """Rules for documents of label 0, from ``stats`` (a stored table of ``statistics``) and ``labels``."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("_id")).agg((F.min(label_col) == 0).cast("int").alias("bad"))
    n = known.count()
    part = F.pmod(F.xxhash64(F.lit("labelled"), "_id"), F.lit(1_000_000))
    known = known.where(part < math.floor(1e6 * min(1.0, labelled_rows / max(n, 1))))
    names = list(features())
    rows = stats.dropDuplicates(["doc_id"]).where(~base_failed()).join(known, F.col("doc_id") == F.col("_id"))
    rows = rows.select(
        "bad", (F.pmod(F.xxhash64(F.lit("prune"), "_id"), F.lit(3)) == 0).alias("prune"), *(c.alias(k) for k, c in features().items()))
    rows = stored(rows.coalesce(4), "labelled")
    fractions = [k / THRESHOLDS for k in range(THRESHOLDS + 1)]
    found = rows.agg(*(F.percentile(F.col(k), F.array(*map(F.lit, fractions))).alias(k) for k in names)).first()
    # thresholds lie midway between neighbouring quantiles, so that values just beside the seen ones fall on their side
    seen = [sorted(set(found[k] or ())) for k in names]
    cuts = [[(a + b) / 2 for a, b in zip(own, own[1:])] for own in seen]
    # interval j of a statistic holds the values up to cut j and above cut j - 1

    def place(name: str, own: list[float]) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, own)), lambda cut: cut < F.col(name))) if own else F.lit(0)

    places = [place(k, c) for k, c in zip(names, cuts)]
    # a bounded number of rows, in one partition: counts then need no shuffle
    rows = stored(rows.select("bad", "prune", F.array(*places).alias("places")).coalesce(1), "places").coalesce(1)

    def holds(conditions) -> Column:
        """conditions: (number of the statistic, above, number of the cut)"""
        column = F.lit(True)
        for f, above, j in conditions:
            place = F.get(F.col("places"), F.lit(f))
            column = column & ((place > j) if above else (place <= j))
        return column

    rules: list[Rule] = []
    left = rows
    while len(rules) < most_rules:
        grown = _grow(left, holds, cuts, most_conditions)
        if not grown:
            break
        kept = _prune(left, holds, grown, min_precision, min_covered)
        if not kept:
            break
        rules.append(tuple(Condition(names[f], above, cuts[f][j]) for f, above, j in kept))
        left = left.where(~holds(kept))
    return rules


def _grow(left: DataFrame, holds, cuts: list[list[float]], most_conditions: int) -> list[tuple]:
    """Add the condition of the largest gain until no good row is covered or nothing is gained."""
    conditions: list[tuple] = []
    while len(conditions) < most_conditions:
        rows = left.where(~F.col("prune") & holds(conditions)).select("bad", F.posexplode("places").alias("f", "place"))
        counts = rows.groupBy("f", "place").agg(F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("n")).collect()
        by = {(r["f"], r["place"]): (r["bad"], r["n"]) for r in counts}
        all_bad = sum(b for (f, _), (b, _) in by.items() if f == 0)
        all_n = sum(n for (f, _), (_, n) in by.items() if f == 0)
        if not all_bad or all_bad == all_n:
            break
        best = (0.0, None)
        for f, own in enumerate(cuts):
            bad = n = 0
            for j in range(len(own)):
                b, m = by.get((f, j), (0, 0))
                bad, n = bad + b, n + m
                for above, p, q in ((False, bad, n), (True, all_bad - bad, all_n - n)):
                    if p:
                        gain = p * (math.log2(p / q) - math.log2(all_bad / all_n))
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, above, j))
        if best[1] is None:
            break
        conditions.append(best[1])
    return conditions


def _prune(left: DataFrame, holds, grown: list[tuple], min_precision: float, min_covered: int) -> list[tuple]:
    """The first conditions of the rule that are worth most on the pruning rows; none if they are not precise."""
    sums = []
    for k in range(1, len(grown) + 1):
        covers = holds(grown[:k])
        sums += [F.sum(F.when(covers, F.col("bad")).otherwise(0)).alias(f"bad{k}"), F.count(F.when(covers, 1)).alias(f"n{k}")]
    row = left.where("prune").agg(*sums).first()
    best, kept = 0.0, []
    for k in range(1, len(grown) + 1):
        bad, n = row[f"bad{k}"] or 0, row[f"n{k}"]
        if n >= min_covered and bad / n >= min_precision and (2 * bad - n) / n > best:
            best, kept = (2 * bad - n) / n, grown[:k]
    return kept


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """``stats`` with ``base_failed``, ``rule`` (the number of the rule that rejects, or null) and ``kept``."""
    rule = F.when(~base_failed(), decision(rules))
    return stats.withColumns({"base_failed": base_failed(), "rule": rule}).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def quality_verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Statistics and verdict of every row of ``docs``."""
    stats = stored(statistics(docs, id_col, text_col), "statistics")
    return judge(stats, learn_rules(stats, labels, id_col, label_col))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns. Rows of one id are told apart by a hash of
    their texts."""
    stats = stored(statistics(docs, id_col, text_col), "statistics")
    good = judge(stats, learn_rules(stats, labels, id_col, label_col)).where("kept")
    own_id, own_mark = free_names(docs, "_good", "_mark")
    good = good.select(F.col("doc_id").alias(own_id), F.col("text_mark").alias(own_mark)).distinct()
    same = docs[id_col].eqNullSafe(F.col(own_id)) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == F.col(own_mark))
    return docs.join(good, same, "left_semi")
