import re

import pytest

from panelspark.llm import pii
from tests.llm.conftest import AWKWARD

SPEC = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HARD = [
    (1, "a@b.c%d@e.f x@y z@w.v. @a.b a@@b.c a@b..c"), (2, "1.2.3.4.5.6.7.8 256.1.1.1 0255.00.1.9 1.2.3 .1.2.3.4"),
    (3, "4111 1111-1111 1111, 4111111111111112 4111--1111 1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1"),
    (4, "+49 (30) 1234-567. +1 +12345678 +123456789( +(1)2 ++1 (988) 555-2485 +1234567890123456"),
    (5, "é\U0001f600 me@x.yz é 10.0.0.1"), (6, "9" * 30_000), (7, "a" * 30_000 + "@b.c"), (8, "1.2.3.4@5.6"), (9, "+" * 500 + "1" * 12),
]


def checksum(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def fits(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in match.split(".")),
        "card": lambda: 12 <= len(digits) <= 19 and checksum(digits), "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def brute(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(SPEC.items()) for m in re.finditer(p, text or "") if fits(kind, m.group())]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found)]


def listed(df):
    rows = df.select("doc_id", pii.listed(pii.F.col("base")).alias("base"), pii.listed(pii.all_spans()).alias("every")).collect()
    return sorted(((r["doc_id"], r["base"], r["every"]) for r in rows), key=repr)


@pytest.mark.parametrize("kind", ["documents", "awkward", "hard"])
def test_base_spans(frame, documents, kind):
    rows = {"documents": documents, "awkward": AWKWARD, "hard": HARD}[kind]
    want = sorted(((i, ",".join(brute(t))) for i, t in rows), key=repr)
    found = listed(pii.spans_of(frame(rows)))
    assert [(i, b) for i, b, _ in found] == want
    assert all(set(b.split(",")) <= set(e.split(",")) for _, b, e in found)


@pytest.fixture(scope="module")
def hinted():
    rows = [(k, f"some text and Mail: user{k}@host{k}.example.org then more") for k in range(30)]
    rows += [(100 + k, f"he said the {'4111111111111111' if k % 2 else 'room'} {k} thing") for k in range(30)]
    return rows + [(200, "write to mail: admin@localhost today"), (201, "mail: 2021 was a year"), (202, "mail: 1.2.3.999 is none"), (203, "see 42 or b2")]


def test_patterns_find_unseen_identifiers(frame, hinted):
    every = {i: (b, e) for i, b, e in listed(pii.spans_of(frame(hinted)))}
    assert every[200] == ("", "email:15:30")
    for k in (201, 202, 203):  # known negatives and other contexts
        assert every[k] == ("", "")
    assert all(b == e for k, (b, e) in every.items() if k != 200)


def test_numbers_are_found_by_their_context(frame):
    rows = [(k, f"please call +1 988 555 {2000 + k} today") for k in range(30)]
    rows += [(100 + k, f"pay by card 41111111111111{k:02d} now") for k in range(100)]
    unseen = {300: "555-0123", 301: "555-123-4567", 302: "1234567890", 303: "555.123.4567"}
    rows += [(i, f"please call {number} today") for i, number in unseen.items()]
    rows += [(400, "please call +1234567 today"), (401, "pay by card 4111111111111112 now"), (402, "see 555-0123 there")]
    every = {i: e for i, _, e in listed(pii.spans_of(frame(rows)))}
    for i, number in unseen.items():
        assert every[i] == f"phone:12:{12 + len(number)}"
    assert every[400] == every[401] == every[402] == ""


def test_refuted_kinds(spark):
    want = {
        "555-0123": ["email"], "1234567890": ["email"], "078-05-1120": ["email"], "4111111111111112": ["email", "card"],
        "4111111111111111": ["email"], "1.2.3.999": ["email", "ip"], "1.2.3.4": ["email"], "+1234567": ["email", "phone"],
        "admin@localhost": [], "b2": [], "2021": ["email"]}
    rows = spark.createDataFrame([(m,) for m in want], "m string").select("m", pii.refuted(pii.F.col("m"))).collect()
    assert {m: list(kinds) for m, kinds in rows} == want


def test_mixed_contexts_are_not_trusted(frame):
    rows = [(k, f"use x: user{k}@host.org now") for k in range(10)] + [(50 + k, f"use x: item{k}b now") for k in range(10)]
    assert all(b == e for _, b, e in listed(pii.spans_of(frame(rows))))


def test_mask(frame, hinted):
    docs = frame(hinted + [(300, "a@b.c%d@e.f and 1.2.3.4"), (301, None), (302, "")]).withColumnRenamed("lang", "base").withColumnRenamed("source", "spans")
    out = pii.mask(docs)
    assert out.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[0] == "some text and Mail: [EMAIL] then more" and texts[200] == "write to mail: [EMAIL] today"
    assert texts[300] == "[EMAIL][EMAIL] and [IP]" and texts[301] is None and texts[302] == "" and texts[203] == "see 42 or b2"


def test_overlapping_spans_are_masked_once(frame):
    (row,) = pii.mask(frame([(1, "x 1.2.3.4@5.6 +14111111111111 y")])).collect()
    assert "@" not in row["text"] and "1" not in row["text"] and row["text"].startswith("x [") and row["text"].endswith("] y")


def test_repeated_rows(frame):
    rows = [(1, "a@b.cd"), (1, "a@b.cd"), (None, "a@b.cd"), (1, "other")]
    assert sorted(r["text"] for r in pii.mask(frame(rows)).collect()) == ["[EMAIL]"] * 3 + ["other"]
    assert len(listed(pii.spans_of(frame(rows)))) == 4


def test_empty_table(frame):
    assert listed(pii.spans_of(frame([]))) == [] and pii.mask(frame([])).collect() == []


def test_no_python_on_the_executors(frame):
    plan = pii.found_in(frame(HARD))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def brute_graph(found):
    """The scores of the pattern graph in plain dictionaries, round by round until nothing is added."""
    patterns, seeds = {}, set()
    for row in found.collect():
        for s in [*row["spans"], *row["others"]]:
            for p in s["patterns"]:
                patterns.setdefault(p, set()).add(s["instance"])
                if s["kind"]:
                    seeds.add((s["instance"], s["kind"]))
    names = [r for r, _ in seeds]
    wrong = {i: set() for own in patterns.values() for i in own}
    for i, kinds in found.sparkSession.createDataFrame([(i,) for i in wrong], "i string").select("i", pii.refuted(pii.F.col("i"))).collect():
        wrong[i] = set(kinds)
    accepted, rounds = {s: 1.0 for s in seeds}, 0
    while True:
        rounds += 1
        trusted = {}
        for p, own in patterns.items():
            for kind in pii.KINDS:
                hits = sum((i, kind) in accepted for i in own)
                if hits >= pii.MIN_SEEDS and hits / (len(own) + 1) >= pii.WEAK:
                    trusted[p, kind] = hits / (len(own) + 1)
        left = {}
        for (p, kind), confidence in trusted.items():
            for i in patterns[p]:
                if i not in names and kind not in wrong[i]:
                    left[i, kind] = left.get((i, kind), 1.0) * (1 - confidence)
        now = {s: 1.0 for s in seeds} | {k: 1 - v for k, v in left.items() if 1 - v >= pii.MIN_CONFIDENCE}
        if len(now) == len(accepted):
            return {k: v for k, v in trusted.items() if v >= pii.MIN_CONFIDENCE}, now, rounds
        accepted = now


def chain():
    """Seeds tell the first context, its unseen addresses the second, and those found there the third."""
    rows = [(k, f"send mail: u{k}@h{k}.example.org soon") for k in range(170)]
    rows += [(200 + k, f"send mail: first{k}@local soon") for k in range(40)]
    rows += [(250 + k, f"then contact: first{k}@local twice") for k in range(40)] + [(300 + k, f"then contact: second{k}@local twice") for k in range(6)]
    rows += [(400 + k, f"or reach: first{k}@local again") for k in range(5)] + [(410 + k, f"or reach: second{k}@local again") for k in range(6)]
    rows += [(420, "or reach: third@local again")]
    return rows + [(500 + k, f"it cost: {k}x or so") for k in range(20)] + [(530, "it cost: first1@local or so")]


def test_what_is_found_finds_more(frame):
    found = pii.found_in(frame(chain()))
    want_patterns, want, rounds = brute_graph(found)
    patterns, instances = pii.learn(found)
    assert {(r["instance"], r["kind"]): r["score"] for r in instances.collect()} == pytest.approx(want, abs=1e-5)
    assert {(r["pattern"], r["kind"]): r["confidence"] for r in patterns.collect()} == pytest.approx(want_patterns, abs=1e-5)
    assert rounds == 4 and ("third@local", "email") in want and ("reach:", "email") in want_patterns
    every = {i: e for i, _, e in listed(pii.spans_of(frame(chain())))}
    assert every[300] == "email:14:27" and every[420] == "email:10:21"
    assert every[500] == every[530] == ""


def test_graph_of_documents(frame, documents):
    found = pii.found_in(frame(documents))
    want_patterns, want, _ = brute_graph(found)
    patterns, instances = pii.learn(found)
    assert {(r["instance"], r["kind"]): r["score"] for r in instances.collect()} == pytest.approx(want, abs=1e-5)
    assert {(r["pattern"], r["kind"]): r["confidence"] for r in patterns.collect()} == pytest.approx(want_patterns, abs=1e-5)
