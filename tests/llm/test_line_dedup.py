import hashlib
import random

import pyarrow as pa
import pytest

from panelspark.llm import line_dedup
from tests.llm.conftest import AWKWARD


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def mutated(draw, text, n, letters="abcdé\U0001f600"):
    text = list(text)
    for _ in range(n):
        k, what = draw.randrange(len(text) + 1), draw.random()
        if what < 0.34 and text:
            text.pop(min(k, len(text) - 1))
        elif what < 0.67:
            text.insert(k, draw.choice(letters))
        elif text:
            text[min(k, len(text) - 1)] = draw.choice(letters)
    return "".join(text)


@pytest.mark.parametrize("edits", [0, 1, 2, 3, 5])
def test_banded_distance(edits):
    draw = random.Random(edits)
    one = ["".join(draw.choices("abcé", k=draw.randint(1, 40))) for _ in range(1500)]
    two = [mutated(draw, x, draw.randint(0, edits + 3)) or "z" for x in one]
    assert line_dedup.within(one, two, edits).tolist() == [distance(a, b) <= edits for a, b in zip(one, two)]


@pytest.mark.parametrize("edits", [1, 2, 3, 4])
def test_near_lines_share_a_key(edits):
    draw = random.Random(edits)
    for _ in range(300):
        a = "".join(draw.choices("abc", k=draw.randint(edits + 1, 30)))
        b = mutated(draw, a, edits, "abc")
        if len(b) <= edits:
            continue
        keys, owner, index = line_dedup.keys_of([a, b], edits)
        of = lambda k: set(keys[owner == k].tolist())
        indexed = lambda k: set(keys[(owner == k) & index].tolist())
        assert (indexed(0) & of(1)) | (indexed(1) & of(0))


def is_near(a, b, edits, steps):
    if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
        return True
    x, y = a.split(), b.split()
    allowed = sum(min(len(x), len(y)) >= n for n in steps)
    return abs(len(x) - len(y)) <= allowed and 0 < allowed >= distance(x, y)


def brute(rows, edits, min_chars, steps=line_dedup.WORD_STEPS):
    """As it is defined: by document, then line."""
    lines = []
    for doc_id, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            line = line.strip(line_dedup.SPACE)
            if len(line) >= min_chars:
                lines.append(((doc_id is not None, doc_id or 0, k), line))
    first = {}
    for place, line in lines:
        first[line] = min(place, first.get(line, place))
    distinct = sorted(first, key=first.get)
    near = set()
    for j, y in enumerate(distinct):
        if any(is_near(x, y, edits, steps) for x in distinct[:j]):
            near.add(y)
    out = []
    for doc_id, text in rows:
        copies = nears = 0
        kept = []
        for k, line in enumerate((text or "").split("\n")):
            core, place = line.strip(line_dedup.SPACE), (doc_id is not None, doc_id or 0, k)
            if len(core) >= min_chars and first[core] != place:
                copies += 1
            elif len(core) >= min_chars and core in near:
                nears += 1
            else:
                kept.append(line)
        out.append((doc_id, None if text is None else hashlib.sha256("\n".join(kept).encode()).hexdigest(), copies, nears))
    return sorted(out, key=repr)


def result(df):
    sha = lambda t: None if t is None else hashlib.sha256(t.encode()).hexdigest()
    return sorted(((r["doc_id"], sha(r["text"]), r["n_copy_lines"], r["n_near_lines"]) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(21)
    bases = ["".join(draw.choices("abcdefgh é", k=draw.randint(8, 40))) for _ in range(25)]
    rows = []
    for k in range(60):
        lines = [mutated(draw, draw.choice(bases), draw.choice([0, 0, 1, 1, 2, 3])) for _ in range(draw.randint(0, 6))]
        rows.append((k, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_lines(frame, texts, edits):
    assert result(line_dedup.dedup_lines(frame(texts), edits, 8)) == brute(texts, edits, 8)


@pytest.fixture(scope="module")
def long_texts():
    """Lines of 3 to 16 words, with words and code points changed, added and lost, and spaces set and removed."""
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdeé", k=draw.randint(1, 5))) for _ in range(60)]
    bases = [draw.choices(words, k=draw.randint(3, 16)) for _ in range(14)]

    def changed(line):
        line = list(line)
        for _ in range(draw.choice([0, 0, 1, 1, 2, 3])):
            k = draw.randrange(len(line))
            line[k:k + draw.choice([0, 1, 1])] = draw.choice([[draw.choice(words)], [], [line[k][:1], line[k][1:] or "x"], [line[k] + "z"]])
            line = line or ["a"]
        return draw.choice([" ", " ", "  "]).join(line)

    return [(k, "\n".join(changed(draw.choice(bases)) for _ in range(draw.randint(1, 5)))) for k in range(90)]


@pytest.mark.parametrize("steps", [(5, 9, 13), (4,), (), (3, 6)])
def test_lines_of_many_words(frame, long_texts, steps):
    assert result(line_dedup.dedup_lines(frame(long_texts), 1, 8, steps=steps)) == brute(long_texts, 1, 8, steps)


def test_one_word_of_a_long_line(frame):
    line = "the committee has found that in most of the years since then no such case was brought before any of its members again"
    rows = [(1, line), (2, line.replace("committee", "assembly")), (3, line.replace("most", "some").replace("again", "")), (4, line[:80])]
    assert [r["n_near_lines"] for r in line_dedup.dedup_lines(frame(rows)).orderBy("doc_id").collect()] == [0, 1, 0, 0]


def test_steps_leave_room(frame):
    for steps in ((5, 4), (2,), (3, 4)):
        with pytest.raises(ValueError, match="have to rise"):
            line_dedup.dedup_lines(frame([]), steps=steps)


def test_blocks(frame, texts, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK", 3)
    monkeypatch.setattr(line_dedup, "PAIRS_AT_ONCE", 5)
    monkeypatch.setattr(line_dedup, "FEW_PAIRS", 10)
    monkeypatch.setattr(line_dedup, "CHARS_AT_ONCE", 100)
    assert result(line_dedup.dedup_lines(frame(texts), 1, 8)) == brute(texts, 1, 8)


def test_very_common_line(frame):
    common = "This line is in each of the documents."
    rows = [(k, f"{common}\nline number {k:05d} of the table\n{common}!") for k in range(300)]
    found = {r["doc_id"]: r for r in line_dedup.dedup_lines(frame(rows)).collect()}
    assert found[0]["text"] == rows[0][1].rsplit("\n", 1)[0]
    assert all(common not in found[k]["text"] for k in range(1, 300))
    assert result(line_dedup.dedup_lines(frame(rows))) == brute(rows, 1, 20)


def test_awkward_rows(frame):
    rows = [(i, t) for i, t in AWKWARD if i is not None] + [(None, "a single line of a row without id")]
    assert result(line_dedup.dedup_lines(frame(rows), 1, 3)) == brute(rows, 1, 3)


def test_rows_without_id_or_of_one_id_keep_their_own_lines(frame):
    line = lambda k: f"{k * 7919:06d} a line that is like no other {k * 104729:08d}"
    text = lambda *ks: "\n".join(map(line, ks))
    rows = [(None, text(1, 2)), (None, text(3, 4)), (5, text(5, 6)), (5, text(7, 8)), (6, text(9, 2, 10)), (6, text(11, 12, 13)), (7, text(14, 8, 3))]
    rows += [(None, text(20) + "\nshort"), (None, text(20) + "\nshort"), (8, text(21)), (8, text(21)), (8, text(21)), (9, text(22)), (9, None), (9, "")]
    out = sorted(((r["doc_id"], r["text"], r["n_copy_lines"], r["n_near_lines"]) for r in line_dedup.dedup_lines(frame(rows)).collect()), key=repr)
    want = [(None, text(1, 2), 0, 0), (None, text(3, 4), 0, 0), (5, text(5, 6), 0, 0), (5, text(7, 8), 0, 0), (6, text(9, 10), 1, 0)]
    want += [(6, text(11, 12, 13), 0, 0), (7, text(14), 2, 0), (None, text(20) + "\nshort", 0, 0), (None, "short", 1, 0)]
    want += [(8, text(21), 0, 0), (8, "", 1, 0), (8, "", 1, 0), (9, text(22), 0, 0), (9, None, 0, 0), (9, "", 0, 0)]
    assert out == sorted(want, key=repr)
    # a line at the same place of texts without id is a copy in all but one of them
    twice = line_dedup.dedup_lines(frame([(None, text(1, 2)), (None, text(1, 3))])).collect()
    assert sorted(r["n_copy_lines"] for r in twice) == [0, 1]


def test_columns_stay(frame, texts):
    docs = frame(texts).withColumnRenamed("lang", "near").withColumnRenamed("source", "n_copy_lines")
    out = line_dedup.dedup_lines(docs, 1, 8)
    assert out.columns == [c for c in docs.columns if c != "n_copy_lines"] + ["n_copy_lines", "n_near_lines"]
    assert out.count() == len(texts)
    assert line_dedup.dedup_lines(docs, 1, 8, counts=False).columns == docs.columns


def test_edits_are_bounded(frame):
    with pytest.raises(ValueError, match="below min_chars"):
        line_dedup.dedup_lines(frame([]), 8, 8)


def test_bitmap_keeps_what_is_wanted(spark):
    lows = [0, 5, -7, 2**62 + 3, -(2**63), 32768, 32767]
    bits = line_dedup.bits_of(spark.createDataFrame([(x,) for x in lows], "low long"))
    places = {x & (line_dedup.FILTER_BITS - 1) for x in lows}
    assert {8 * k + j for k, byte in enumerate(bits) if byte for j in range(8) if byte >> j & 1} == places


def test_empty_table(frame):
    assert line_dedup.dedup_lines(frame([])).collect() == []


def test_marked_lines_of_many_documents_go_out_together():
    class Docs:
        def mapInArrow(self, run, schema):
            return run

    texts = [f"line number {i} of the text\nshort\nthe same line everywhere" if i % 3 else "short" for i in range(300)] + [""]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array([i * 7 for i in range(len(texts))], pa.int64()), pa.array(texts)],
        ["doc_id", "text_mark", "text"])
    want = [(i, i * 7, k, line) for i, text in enumerate(texts) for k, line in line_dedup.lines_of(text, 10)]
    every = bytes([255]) * (line_dedup.FILTER_BITS // 8)
    found = list(line_dedup._lines_with(Docs(), every, 10)(iter([batch])))
    assert len(found) == 1  # a batch per document costs more than its lines
    got = [(r["doc_id"], r["text_mark"], r["line_no"], r["line"]) for b in found for r in b.to_pylist()]
    assert got == want and len(got) == 400
    hashes = line_dedup.line_ids([line for *_, line in want])
    assert [[r["high"], r["low"]] for r in found[0].to_pylist()] == hashes.tolist()
    bits = bytearray(line_dedup.FILTER_BITS // 8)
    place = int(hashes[0, 1]) & (line_dedup.FILTER_BITS - 1)
    bits[place >> 3] |= 1 << (place & 7)
    only = [r["doc_id"] for b in line_dedup._lines_with(Docs(), bytes(bits), 10)(iter([batch])) for r in b.to_pylist()]
    assert only == [1]
