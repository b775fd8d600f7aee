import random

import numpy as np
import pytest

from panelspark.operators import synthetic


def frame(spark, n_pos=12, n_neg=200, gap=2.0, seed=0):
    rng = np.random.default_rng(seed)
    pos, neg = rng.normal(size=(n_pos, 2)) + gap, rng.normal(size=(n_neg, 2))
    rows = [(f"p{i}", 1, [float(a), float(b)]) for i, (a, b) in enumerate(pos)]
    rows += [(f"n{i}", 0, [float(a), float(b)]) for i, (a, b) in enumerate(neg)]
    return spark.createDataFrame(rows, "row_key string, label int, vec array<double>").persist(), pos, neg


def made(df):
    rows = df.collect()
    assert len({r.row_key for r in rows}) == len(rows)
    return [r for r in rows if r.synthetic]


def on_a_segment(x, ends):
    """Whether x lies between two of the points."""
    for i, a in enumerate(ends):
        for b in ends[i + 1:]:
            length = np.linalg.norm(b - a)
            if abs(np.linalg.norm(x - a) + np.linalg.norm(x - b) - length) < 1e-9 * (1 + length):
                return True
    return any(np.allclose(x, a) for a in ends)


def test_smote(spark):
    df, pos, _ = frame(spark)
    found = synthetic.smote(df, "label", "vec", ratio=0.5, k=4)
    new = made(found)
    assert len(new) == 88 and {r.label for r in new} == {1} and found.count() == 212 + 88
    assert all(on_a_segment(np.array(r.vec), pos) for r in new)
    per_seed = {}
    for r in new:
        per_seed[r.row_key.split("#")[0]] = per_seed.get(r.row_key.split("#")[0], 0) + 1
    assert len(per_seed) == 12 and set(per_seed.values()) == {7, 8}
    again = synthetic.smote(df.repartition(5), "label", "vec", ratio=0.5, k=4)
    assert {(r.row_key, tuple(r.vec)) for r in made(again)} == {(r.row_key, tuple(r.vec)) for r in new}


def test_smote_many_copies_per_seed(spark, monkeypatch):
    monkeypatch.setattr(synthetic, "COPIES_PER_BLOCK", 3)
    df, pos, _ = frame(spark, n_pos=5)
    new = made(synthetic.smote(df, "label", "vec", ratio=0.5, k=2))
    assert len(new) == 95 and all(on_a_segment(np.array(r.vec), pos) for r in new)


def test_nothing_to_add_and_errors(spark):
    df, _, _ = frame(spark)
    assert made(synthetic.smote(df, "label", "vec", ratio=0.06, k=4)) == []
    with pytest.raises(ValueError, match="cannot be reached"):
        synthetic.smote(df, "label", "vec", ratio=0.01)
    with pytest.raises(ValueError, match="neighbours need"):
        synthetic.smote(df, "label", "vec", ratio=0.5, k=12)
    with pytest.raises(ValueError, match="sampler"):
        synthetic.oversample(df, "Other", {}, "label", "vec", 0.5)


def majority_near(pos, neg, m):
    """Majority rows among the m nearest of every minority row, by looking at all of them."""
    found = {}
    for i, p in enumerate(pos):
        others = [(np.linalg.norm(p - q), 0) for j, q in enumerate(pos) if j != i] + [(np.linalg.norm(p - q), 1) for q in neg]
        found[f"p{i}"] = sum(flag for _, flag in sorted(others)[:m])
    return found


def test_borderline(spark):
    df, pos, neg = frame(spark, gap=1.5)
    near = majority_near(pos, neg, 6)
    danger = {k for k, n in near.items() if 3 <= n < 6}
    assert 0 < len(danger) < 12
    assert {r.row_key for r in synthetic.in_danger(df, "label", "vec", 6).collect()} == danger
    new = made(synthetic.borderline_smote(df, "label", "vec", ratio=0.5, k=4, m=6))
    assert len(new) == 88 and {r.row_key.split("#")[0] for r in new} == danger
    assert all(on_a_segment(np.array(r.vec), pos) for r in new)


def test_borderline_without_danger_adds_nothing(spark):
    df, _, _ = frame(spark, gap=100.0)
    assert made(synthetic.borderline_smote(df, "label", "vec", ratio=0.5, k=4, m=6)) == []


def test_adasyn(spark):
    df, pos, neg = frame(spark, gap=1.5)
    near = majority_near(pos, neg, 5)
    total = sum(near.values())
    wanted = {k: int(np.rint(n / total * 88)) for k, n in near.items()}
    new = made(synthetic.adasyn(df, "label", "vec", ratio=0.5, k=5))
    per_seed = dict.fromkeys(wanted, 0)
    for r in new:
        per_seed[r.row_key.split("#")[0]] += 1
    assert per_seed == wanted and all(on_a_segment(np.array(r.vec), pos) for r in new)
    with pytest.raises(ValueError, match="majority neighbour"):
        synthetic.adasyn(frame(spark, gap=100.0)[0], "label", "vec", ratio=0.5, k=5)


def test_search_names_of_settings(spark):
    df, _, _ = frame(spark)
    by_name = synthetic.oversample(df, "SMOTE", {"k_neighbors": "4.0"}, "label", "vec", 0.5)
    direct = synthetic.smote(df, "label", "vec", ratio=0.5, k=4)
    assert {r.row_key: tuple(r.vec) for r in made(by_name)} == {r.row_key: tuple(r.vec) for r in made(direct)}


@pytest.mark.parametrize("name, params", [
    ("SMOTE", {"k_neighbors": "3"}), ("BorderlineSMOTE", {"k_neighbors": "4", "m_neighbors": "6"}), ("ADASYN", {"n_neighbors": "5"}),
    ("SMOTE", {"k_neighbors": "8"})])
def test_stored_neighbours_change_nothing(spark, name, params):
    rng = random.Random(4)
    rows = [(f"r{i:03d}", int(i % 6 == 0), [rng.gauss(i % 6 == 0, 0.8), rng.gauss(0, 1)]) for i in range(120)]
    rows += [(f"c{i}", 1, [0.5, 0.5]) for i in range(12)]  # copies of one vector name the same few neighbours
    df = spark.createDataFrame(rows, "row_key string, label int, vec array<double>")
    near = synthetic.neighbourhoods(df, "label", "vec", 6)
    plain, shared = (sorted(map(str, synthetic.oversample(df, name, params, "label", "vec", 0.9, ready=r).collect())) for r in (None, near))
    assert plain == shared and len(plain) > len(rows)


def test_cuts_of_few_and_many_seeds(spark, monkeypatch):
    df, _, _ = frame(spark)
    few = {r.row_key for r in made(synthetic.smote(df, "label", "vec", ratio=0.5, k=4))}
    monkeypatch.setattr(synthetic, "FEW_SEEDS", 0)
    assert {r.row_key for r in made(synthetic.smote(df, "label", "vec", ratio=0.5, k=4))} == few
