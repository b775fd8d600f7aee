import random
import string

import pytest

from panelspark.llm import minhash
from panelspark.llm.components import components
from tests.llm.conftest import AWKWARD

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text, width):
    words = [w for w in (text or "").translate(LOWER).replace("\t", " ").replace("\n", " ").split(" ") if w]
    return set(zip(*(words[k:] for k in range(width)))) if len(words) > width else {tuple(words)} if words else set()


def brute(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            alike = sets[a] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common)
            same_id = rows[a][0] is not None and rows[a][0] == rows[b][0]
            # rows without id belong to the class of an equal set only
            if (alike and (None not in (rows[a][0], rows[b][0]) or sets[a] == sets[b])) or (same_id and rows[a] == rows[b]):
                parent[root(a)] = root(b)
    out = []
    for k, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(k) and rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((doc_id, len(sets[k]), component, doc_id == component))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def edited(draw, words, n):
    words = list(words)
    for _ in range(n):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return words


@pytest.fixture(scope="module")
def families():
    """Bases, their near copies at all degrees, chains, and texts that share a long passage."""
    draw = random.Random(11)
    vocabulary = [f"word{k}" for k in range(3000)]
    passage, rows = draw.choices(vocabulary, k=60), []
    for base in range(25):
        words = draw.choices(vocabulary, k=draw.randint(30, 200))
        rows.append(words)
        rows += [edited(draw, words, draw.randint(0, 9)) for _ in range(8)]
        for _ in range(4):  # a chain: the ends may be far apart
            words = edited(draw, words, 3)
            rows.append(words)
    rows += [passage + draw.choices(vocabulary, k=40) for _ in range(40)]
    rows += [draw.choices(vocabulary, k=k % 5) for k in range(10)]
    draw.shuffle(rows)
    return [(k, " ".join(w)) for k, w in enumerate(rows)]


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_families(frame, families, width, percent):
    assert result(minhash.near_duplicates(frame(families), width, percent)) == brute(families, width, percent)


def test_blocks_of_open_buckets(frame, families, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    monkeypatch.setattr(minhash, "PAIRS_PER_UNIT", 3)
    assert result(minhash.near_duplicates(frame(families), 3, 85)) == brute(families, 3, 85)


def test_documents(frame, documents):
    assert result(minhash.near_duplicates(frame(documents), 3, 85)) == brute(documents, 3, 85)


def test_awkward_rows(frame):
    assert result(minhash.near_duplicates(frame(AWKWARD), 3, 85)) == brute(AWKWARD, 3, 85)


def test_empty_tables(frame):
    assert result(minhash.near_duplicates(frame([]), 3, 85)) == []
    assert result(minhash.near_duplicates(frame([(1, None), (2, "")]), 3, 85)) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_one_of_each_group_stays(frame, families):
    docs = frame(families).withColumnRenamed("lang", "rep").withColumnRenamed("source", "component_id")
    out = minhash.drop_near_duplicates(docs, 3, 85)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(r[0] for r in brute(families, 3, 85) if r[3])


def test_rows_without_id_or_of_one_id_go_by_their_texts(frame):
    base = [" ".join(f"w{k}x{j}" for j in range(40)) for k in range(6)]
    rows = AWKWARD + [
        (20, base[0]), (None, base[0]), (None, base[1]), (None, base[1] + " more"),  # a copy, and texts that stand alone
        (21, base[2]), (30, base[2] + " end"), (30, base[3]), (31, base[3] + " end"), (30, base[4]), (None, base[4]), (5, base[5])]
    want = brute(rows, 3, 85)
    assert result(minhash.near_duplicates(frame(rows), 3, 85)) == want
    out = minhash.drop_near_duplicates(frame(rows), 3, 85)
    left = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    gone = [(None, "a"), (5, "A"), (None, base[0]), (30, base[2] + " end"), (31, base[3] + " end"), (None, base[4])]
    assert left == sorted((r for r in rows if r not in gone), key=repr)


def test_banding_follows_the_threshold():
    for percent in (60, 80, 85, 95):
        t, r = percent / 100, minhash.rows_per_band(percent)
        assert (1 - t**r) ** (minhash.HASHES // r) <= minhash.MISS
        assert minhash.least_matches(percent) < t * minhash.HASHES


@pytest.mark.parametrize("shape", ["path", "star", "random", "opposite"])
def test_components(spark, shape):
    draw = random.Random(6)
    if shape == "path":
        order = draw.sample(range(60), 60)
        edges = list(zip(order, order[1:]))
    elif shape == "star":
        edges = [(30, k) for k in range(60) if k != 30]
    elif shape == "opposite":
        edges = [(1, 2), (2, 1), (3, 3), (None, 4), (5, 2), (7, 8), (8, 7)]
    else:
        edges = [(draw.randrange(200), draw.randrange(200)) for _ in range(120)]
    parent = {}

    def root(k):
        while parent.setdefault(k, k) != k:
            k = parent[k]
        return k

    for a, b in edges:
        if None not in (a, b) and a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    found = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {k: root(k) for k in parent}
