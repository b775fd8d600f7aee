"""Personal data by bootstrapped contextual extraction, over base patterns. DataFrame functions only.

Base spans come from regular expressions and checks per kind (``KINDS``). They are the seeds: the word before a seed
is a lexical pattern, alone and with the word after it. The same patterns are read off all other tokens with a digit
or an at sign, which are the candidates. Patterns and instances make a graph whose edges are counted over all
documents. In each round a pattern with ``MIN_SEEDS`` instances of a kind, seeds or accepted ones, scores their share
of all its instances (of any kind, so that mixed contexts stay low), and an instance the chance that not all of its
patterns of ``WEAK`` confidence or more are wrong; with ``MIN_CONFIDENCE`` it is accepted and supports patterns in the
next round, also such as have no seed. A candidate that looks like a kind but fails its check is a known negative of
that kind alone, and a number one of ``email``. Accepted candidates are added as spans where a pattern of
``MIN_CONFIDENCE`` finds them; base spans always stay.

Spans count in code points and their end is exclusive. A null text is empty. Rows of one id and text get the same
spans; null ids are ordinary. An empty table gives an empty result. Other columns are left as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.store import free_names, let, stored, text_or_empty

# The kinds in their order, and the base pattern of each. Repeats are possessive and begin at the
# first character that can begin them (or at the end of the last match), which finds the same spans in linear time.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
SPACE = r"[\x20\x09-\x0D]+"
CONTEXT_CHARS = 64
WEAK = 0.5
MIN_SEEDS = 5
MIN_CONFIDENCE = 0.8
SPAN = "array<struct<start:long,stop:long,match:string>>"


def matches(text: Column, pattern: str) -> Column:
    """All matches with their places, from left to right, without overlap."""

    def placed(found: Column) -> Column:
        between = F.transform(F.split(text, pattern, -1), lambda piece: F.char_length(piece).cast("long"))
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("spans"))

        def step(done: Column, item: Column) -> Column:
            first = done["at"] + item["skip"]
            last = first + F.char_length(item["match"])
            span = F.struct(first.alias("start"), last.alias("stop"), item["match"].alias("match"))
            return F.struct(last.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

        items = let(between, lambda skips: F.transform(
            found, lambda match, k: F.struct(F.get(skips, k).alias("skip"), match.alias("match"))))
        return F.when(F.size(found) > 0, F.aggregate(items, start, step, lambda done: done["spans"]))

    return F.coalesce(let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed), F.array().cast(SPAN))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check sum."""
    def doubled(d: Column) -> Column:
        return F.when(d > 4, 2 * d - 9).otherwise(2 * d)

    values = F.transform(F.reverse(F.split(digits, "")), lambda d: d.cast("int"))
    weighed = F.transform(values, lambda d, k: F.when(k % 2 == 1, doubled(d)).otherwise(d))
    return F.aggregate(weighed, F.lit(0), lambda total, d: total + d) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        return F.when(F.char_length(digits).between(12, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """``kind, start, stop, match`` of all base spans, by start, then kind in the order of ``KINDS``."""
    def of_kind(order: int, kind: str) -> Column:
        found = F.filter(matches(text, PATTERNS[kind]), lambda s: valid(kind, s["match"]))
        found = F.transform(found, lambda s: F.struct(
            s["start"].alias("start"), F.lit(order).alias("kind_no"), s["stop"].alias("stop"), s["match"].alias("match"),
            F.lit(kind).alias("kind")))
        hint = text.contains(HINTS[kind]) if HINTS[kind] else F.lit(True)
        return F.when(hint & text.rlike("[0-9@]"), found)

    kinds = "array<struct<start:long,kind_no:int,stop:long,match:string,kind:string>>"
    return F.sort_array(F.concat(*(F.coalesce(of_kind(k, kind), F.array().cast(kinds)) for k, kind in enumerate(KINDS))))


def candidates(text: Column, spans: Column) -> Column:
    """Tokens with a digit or an at sign, without marks at their ends, that overlap no base span."""
    def trimmed(token: Column) -> Column:
        core = F.regexp_replace(F.regexp_replace(token["match"], r"[.,;:!?)\]}\"'>]++$", ""), r"^[(\[{\"'<]++", "")
        lead = F.char_length(F.regexp_extract(token["match"], r"^[(\[{\"'<]*+", 0))
        first = token["start"] + lead
        return F.struct(first.alias("start"), (first + F.char_length(core)).alias("stop"), core.alias("match"))

    found = F.when(text.rlike("[0-9@]"), F.transform(matches(text, TOKEN), trimmed))
    free = lambda t: ~F.exists(spans, lambda s: (s["start"] < t["stop"]) & (s["stop"] > t["start"]))
    return F.coalesce(F.filter(found, lambda t: (t["stop"] > t["start"]) & free(t)), F.array().cast(SPAN))


def refuted(match: Column) -> Column:
    """The kinds that a candidate cannot be, as an array: those whose form and length it has while its check fails, and
    ``email`` for a number. Numbers of other lengths are left to their context."""
    digits = F.char_length(F.regexp_replace(match, "[^0-9]", ""))
    card = F.when(match.rlike(r"^[0-9](?:[\x20-]?[0-9])*+$") & digits.between(12, 19), ~valid("card", match))
    tests = {
        "email": match.rlike(r"^\+?[0-9][\x20().0-9-]*+$"),
        "ip": F.when(match.rlike(r"^[0-9]+(?:\.[0-9]+){3}$"), ~valid("ip", match)),
        "card": card,
        "phone": match.rlike(r"^\+[0-9][\x20().0-9-]+[0-9]$") & ~valid("phone", match),
    }
    return F.array_compact(F.array(*(F.when(tests[kind], F.lit(kind)) for kind in KINDS)))


def context(text: Column, span: Column) -> tuple[Column, Column]:
    """The word before and the word after a span, lower-cased, within ``CONTEXT_CHARS``; empty where there is none."""
    start, stop = span["start"].cast("int"), span["stop"].cast("int")
    begin = F.greatest(F.lit(0), start - CONTEXT_CHARS)
    before = F.split(F.rtrim(F.regexp_replace(F.substring(text, begin + 1, start - begin), SPACE, " ")), " ")
    after = F.split(F.ltrim(F.regexp_replace(F.substring(text, stop + 1, F.lit(CONTEXT_CHARS)), SPACE, " ")), " ")
    return F.lower(F.element_at(before, -1)), F.lower(F.element_at(after, 1))


def found_in(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, text_mark`` (a hash of the text), ``spans`` and ``others`` (candidates), each span with the
    patterns it occurs in."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    text = F.col("text")

    def with_patterns(span: Column) -> Column:
        left, right = context(text, span)
        patterns = F.array(left, F.concat_ws("\t", left, right))
        return F.struct(
            span["start"].alias("start"), span["stop"].alias("stop"), F.lower(span["match"]).alias("instance"),
            F.lit(None).cast("string").alias("kind"),
            F.when(left != "", patterns).otherwise(F.array().cast("array<string>")).alias("patterns"))

    def seeded(span: Column) -> Column:
        return with_patterns(span).withField("kind", span["kind"])

    both = let(base_spans(text), lambda spans: F.struct(
        F.transform(spans, seeded).alias("spans"), F.transform(candidates(text, spans), with_patterns).alias("others")))
    return rows.select("doc_id", F.xxhash64("text").alias("text_mark"), both.alias("both")).select("doc_id", "text_mark", "both.spans", "both.others")


def learn(found: DataFrame, min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """Scored patterns ``pattern, kind, confidence`` and instances ``instance, kind, score``, both above the limit.

    What is accepted only grows, as do the scores that follow from it, so the rounds end with the first one that adds
    nothing; a chain of contexts takes a round per link.
    """
    seen = found.select(F.explode(F.concat("spans", "others")).alias("s")).select(
        "s.kind", "s.instance", F.explode("s.patterns").alias("pattern"))
    n = found.agg(F.coalesce(F.sum(F.size("spans") + F.size("others")), F.lit(0))).first()[0]
    edges = stored(seen.groupBy("pattern", "instance").agg(F.max(F.col("kind").isNotNull()).alias("seed")), "edges", 2 * n)
    seeds = seen.where("kind is not null").select("instance", "kind").distinct().withColumn("score", F.lit(1.0))
    seeds = stored(seeds, "seeds", n)
    # a pattern of fewer instances can never have the support, whatever is accepted
    sizes = stored(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_seeds), "sizes", n)
    edges = edges.join(sizes, "pattern", "left_semi").withColumn("refuted", refuted(F.col("instance")))
    edges = stored(edges, "edges_in_use", 2 * n)
    accepted, known = seeds, seeds.count()
    while True:
        hits = edges.join(accepted.select("instance", "kind"), "instance").groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("hits"))
        patterns = hits.where(F.col("hits") >= min_seeds).join(sizes, "pattern")
        patterns = patterns.select("pattern", "kind", F.round(F.col("hits") / (F.col("n") + 1), 6).alias("confidence"))
        patterns = stored(patterns.where(F.col("confidence") >= WEAK), "patterns", n)
        wrong = F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999))))
        found_by = edges.where("not seed").join(patterns, "pattern").where("not array_contains(refuted, kind)")
        scores = found_by.groupBy("instance", "kind").agg(F.round(1 - F.exp(wrong), 6).alias("score"))
        accepted = stored(seeds.unionByName(scores.where(F.col("score") >= min_confidence)), "accepted", n)
        before, known = known, accepted.count()
        if known == before:
            return patterns.where(F.col("confidence") >= min_confidence), accepted


def spans_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_mark, base, added``; the last two are arrays of ``start, kind_no,
    stop, kind`` by start, then kind."""
    found = stored(found_in(docs, id_col, text_col), "found")
    patterns, instances = learn(found)
    others = found.where(F.size("others") > 0).select("doc_id", "text_mark", F.explode("others").alias("s"))
    others = others.select("doc_id", "text_mark", "s.start", "s.stop", "s.instance", F.explode("s.patterns").alias("pattern"))
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    added = others.join(patterns, "pattern").join(instances, ["instance", "kind"])
    added = added.groupBy("doc_id", "text_mark", "start", "stop").agg(F.max_by("kind", F.struct("confidence", "kind")).alias("kind"))
    added = added.groupBy(F.col("doc_id").alias("_id"), F.col("text_mark").alias("_mark")).agg(
        F.sort_array(F.collect_list(F.struct("start", order.alias("kind_no"), "stop", "kind"))).alias("added"))
    base = F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), (F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]) - 1).cast("int").alias("kind_no"),
        s["stop"].alias("stop"), s["kind"].alias("kind")))
    kind = "array<struct<start:long,kind_no:int,stop:long,kind:string>>"
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_mark") == F.col("_mark"))
    return found.join(added, same, "left").select("doc_id", "text_mark", base.cast(kind).alias("base"), F.coalesce("added", F.array().cast(kind)).cast(kind).alias("added"))


def listed(spans: Column) -> Column:
    """``kind:start:stop`` of sorted spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def all_spans(row_base: str = "base", row_added: str = "added") -> Column:
    return F.sort_array(F.concat(row_base, row_added))


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets; of overlapping spans the first, or of those that begin
    together the longest, gives the name for the stretch that they cover. Texts without spans stay as they are."""
    spans = spans_of(docs, id_col, text_col).where(F.size("base") + F.size("added") > 0).dropDuplicates(["doc_id", "text_mark"])
    ordered = F.sort_array(F.transform(all_spans(), lambda s: F.struct(
        s["start"].alias("start"), (-s["stop"]).alias("order"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    own_id, own_mark, found = free_names(docs, "_id", "_mark", "_spans")
    spans = spans.select(F.col("doc_id").alias(own_id), F.col("text_mark").alias(own_mark), ordered.alias(found))
    text = F.col(text_col)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("text"))

    def step(done: Column, s: Column) -> Column:
        between = F.substring(text, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        named = F.concat(done["text"], between, F.lit("["), F.upper(s["kind"]), F.lit("]"))
        inside = s["start"] < done["at"]
        return F.struct(F.greatest(done["at"], s["stop"]).alias("at"), F.when(inside, done["text"]).otherwise(named).alias("text"))

    rest = lambda done: F.concat(done["text"], F.substring(text, (done["at"] + 1).cast("int"), F.char_length(text)))
    masked = F.when(F.col(found).isNull(), text).otherwise(F.aggregate(found, start, step, rest))
    same = docs[id_col].eqNullSafe(F.col(own_id)) & (F.xxhash64(text_or_empty(text_col)) == F.col(own_mark))
    return docs.join(spans, same, "left").withColumn(text_col, masked).select(*docs.columns)
