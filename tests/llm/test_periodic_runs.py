import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.llm import periodic_runs, queries
from panelspark.llm.periodic_runs import SuffixTree, Extensions, all_runs, kept_words, runs_of
from tests.llm.conftest import AWKWARD, SCHEMA

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_runs(words, least, repeats):
    """Every stretch that agrees with itself one period on, for each period in turn; periods inside it come first."""
    found = []
    for period in range(1, len(words) // repeats + 1):
        i = 0
        while i + period < len(words):
            start = i
            while i + period < len(words) and words[i] == words[i + period]:
                i += 1
            length = i - start + period
            inner = any(s <= start and start + length <= s + n for s, n, p in found if period % p == 0)
            if i > start and length >= max(least, repeats * period) and not inner:
                found.append((start, length, period))
            i += i == start
    return sorted(found, key=lambda r: (r[0], r[2]))


def made(draw):
    n, letters = draw.randint(0, 70), draw.randint(1, 4)
    words = [draw.randrange(letters) for _ in range(n)]
    for _ in range(draw.randint(0, 2) if n > 4 else 0):
        period, start = draw.randint(1, 7), draw.randrange(n)
        for i in range(start + period, min(n, start + draw.randint(1, 50))):
            words[i] = words[i - period]
    return words


@pytest.mark.parametrize("least,repeats", [(6, 4), (2, 2), (1, 3)])
def test_runs_against_every_period(least, repeats):
    draw = random.Random(least)
    for _ in range(800):
        words = made(draw)
        assert [tuple(r) for r in runs_of(np.array(words, np.int64), least, repeats).tolist()] == slow_runs(words, least, repeats)


def test_extensions_of_a_tree():
    draw = random.Random(4)
    for n in (1, 2, 40, 500):
        letters = [draw.randint(1, 2) for _ in range(n)]
        depths, place, ranked = SuffixTree(letters).tour()
        text = [*letters, 0]
        assert ranked.tolist() == sorted(range(n + 1), key=lambda i: text[i:])
        a, b = np.array([(draw.randrange(n + 1), draw.randrange(n + 1)) for _ in range(300)]).T
        a, b = a[a != b], b[a != b]

        def agree(i, j):
            k = 0
            while max(i, j) + k <= n and text[i + k] == text[j + k]:
                k += 1
            return k

        assert Extensions(depths, place)(a, b).tolist() == [agree(i, j) for i, j in zip(a.tolist(), b.tolist())]


def test_one_long_run():
    words = np.tile(np.arange(13), 4000)[:50_001]
    assert runs_of(words).tolist() == [[0, 50_001, 13]]
    assert kept_words(len(words), runs_of(words)).sum() == 13
    assert all_runs([1]).tolist() == []


def test_rows(spark, frame):
    rows = frame([(1, "x a b a b a b a b y"), (2, "go go go go go go\nstop"), (3, "a b a b a b")])
    got = {r.doc_id: r for r in periodic_runs.periodic_runs(rows).collect()}
    assert [tuple(r) for r in got[1].runs] == [(1, 8, 2)] and got[1].collapsed == "x a b y"
    assert [tuple(r) for r in got[2].runs] == [(0, 6, 1)] and got[2].collapsed == "go stop"
    assert got[3].runs == [] and got[3].collapsed == "a b a b a b" and got[3].n_words == 6
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(rows, repeats=1)


def test_awkward_rows(spark, frame):
    docs = frame(AWKWARD).withColumns({"runs": F.lit(1), "collapsed": F.lit("c"), "n_words": F.lit("n")})
    got = sorted((r.doc_id or -1, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.periodic_runs(docs).collect())
    want = []
    for i, text in AWKWARD:
        words = WORD.findall(text or "")
        runs = slow_runs(words, 6, 4) if len(words) < 100 else [(0, 6300, 7)]
        gone = {k for s, n, p in runs for k in range(s + p, s + n)}
        want.append((i or -1, len(words), runs, " ".join(w for k, w in enumerate(words) if k not in gone)))
    assert got == sorted(want)
    assert periodic_runs.periodic_runs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark, sf, documents):
    """All columns of the registered query, recomputed."""
    got = {r.doc_id: r.asDict() for r in queries.op11(spark, sf).collect()}
    assert len(got) == len(documents)
    changed = 0
    for i, text in documents:
        words = WORD.findall(text or "")
        n, h = len(words), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            first = g % n
            period = 1 + (n - first) // (3 + g % 8)
            words = words[:first] + [words[first + (k - first) % period] for k in range(first, n)]
            changed += 1
        runs = slow_runs(words, 6, 4)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        gone = {k for s, size, p in runs for k in range(s + p, s + size)}
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        assert got[i] == {
            "doc_id": i, "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2],
            "exponent_milli": best[1] and 1000 * best[1] // best[2],
            "runs_sha256": hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(kept.encode()).hexdigest()}
    assert changed
