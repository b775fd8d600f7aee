import random

import numpy as np
import pytest

from panelspark.operators import calibration, isotonic


def plain(points):
    """Pool adjacent violators over sorted (score, weight, total)."""
    blocks = []
    for s, w, t in sorted(points):
        blocks.append([s, s, w, t])
        while len(blocks) > 1 and blocks[-2][3] / blocks[-2][2] >= blocks[-1][3] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0], last[1], blocks[-1][2] + last[2], blocks[-1][3] + last[3]]
    return blocks


def table(spark, points):
    return spark.createDataFrame(points, "score double, weight double, total double").repartition(4)


def fitted(spark, points, per_range, at_once):
    steps, edges = isotonic.fit_steps(table(spark, points), per_range, at_once)
    return steps, edges, sorted((r.low, r.high, r.weight, r.total) for r in steps.collect())


SHAPES = {
    "noise": lambda i, draw: float(draw.randint(0, 1)),
    "falling": lambda i, draw: float(100 - i),
    "rising": lambda i, draw: float(i),
    "saw": lambda i, draw: float(i % 37 + i / 50),
    "hill": lambda i, draw: float(min(i, 90)) if i < 100 else -float(i),
    "ties": lambda i, draw: float(i // 40),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_ranges_and_merges_change_nothing(spark, shape):
    draw = random.Random(shape)
    points = [(i * 0.5, float(draw.randint(1, 3)), SHAPES[shape](i, draw)) for i in range(150)]
    want = [tuple(b) for b in plain(points)]
    for per_range, at_once in ((1000, 1000), (20, 3)):
        steps, edges, found = fitted(spark, points, per_range, at_once)
        assert [f[:2] for f in found] == [w[:2] for w in want]
        assert [x for f in found for x in f[2:]] == pytest.approx([x for w in want for x in w[2:]])
    assert len(edges) > 3


def test_rising_points_stay_in_their_ranges(spark, monkeypatch):
    """Distinct rising scores pool nothing: no merge sees more than its blocks, and the fit is not sent anywhere."""
    seen = []
    plain_pool = isotonic.pooled
    monkeypatch.setattr(isotonic, "pooled", lambda *a: seen.append(len(a[0])) or plain_pool(*a))
    steps, edges, found = fitted(spark, [(float(i), 1.0, float(i)) for i in range(300)], 30, 4)
    assert len(found) == 300 and len(edges) == 9
    assert steps.groupBy("range").count().agg({"count": "max"}).first()[0] <= 60


def test_both_ways_of_reading(spark):
    draw = random.Random(3)
    points = [(round(draw.gauss(0, 1), 2), 1.0, float(draw.random() < 0.4)) for _ in range(400)]
    points = [(s, float(sum(x[0] == s for x in points)), sum(x[2] for x in points if x[0] == s)) for s in {p[0] for p in points}]
    steps, edges, found = fitted(spark, points, 25, 5)
    asked = spark.createDataFrame(
        [(float(x), "r") for x in np.linspace(-4, 4, 161)] + [(None, "n"), (0.25, "again"), (0.25, "again")], "score double, p string")
    xs, ys = [x for f in found for x in f[:2]], [f[3] / f[2] for f in found for _ in (0, 1)]
    for rows in (isotonic.read_by_shipping(asked, steps, "score", "p"), isotonic.read_by_ranges(asked, steps, edges, "score", "p")):
        got = rows.collect()
        assert len(got) == 164
        for r in got:
            assert r.p is None if r.score is None else r.p == pytest.approx(float(np.interp(r.score, xs, ys)))


def test_many_steps_are_not_shipped(spark, monkeypatch):
    df = spark.createDataFrame([(float(i), int(i > 3)) for i in range(8)] + [(None, 1), (2.0, None)], "score double, y int")
    none = calibration.fit_isotonic(df.limit(0), "score", "y")
    assert {r.p for r in none.apply(df, "score").collect()} == {None}
    few = calibration.fit_isotonic(df, "score", "y")
    monkeypatch.setattr(isotonic, "STEPS_SHIPPED", 0)
    want = sorted((r.score, r.p) for r in few.apply(df, "score").collect() if r.score is not None)
    monkeypatch.setattr(isotonic, "read_by_shipping", None)
    assert sorted((r.score, r.p) for r in few.apply(df, "score").collect() if r.score is not None) == want
