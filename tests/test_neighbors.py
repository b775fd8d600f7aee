import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelspark.operators import neighbors
from panelspark.plans.queries import learning


def clustered(n=400, d=3, seed=0):
    """Clusters of different density, and a third of the rows copies of one point."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, d)) * 20
    x = centres[rng.integers(0, 8, n)] + rng.normal(size=(n, d)) * rng.choice([0.01, 1.0, 5.0], size=(n, 1))
    x[rng.random(n) < 0.34] = x[0]
    return x


def frame(spark, x, start=0):
    return spark.createDataFrame([(str(start + i), [float(v) for v in row]) for i, row in enumerate(x)], "id string, vec array<double>")


def brute(queries, points, k, exclude_self=True):
    """{(query, rank): neighbour} by looking at all pairs; ids are texts."""
    found = {}
    for qi, q in queries:
        order = sorted((float(((q - p) ** 2).sum()), pi) for pi, p in points if not (exclude_self and pi == qi))
        found |= {(qi, r + 1): pi for r, (_, pi) in enumerate(order[:k])}
    return found


def listed(x, start=0):
    return [(str(start + i), row) for i, row in enumerate(x)]


@pytest.mark.parametrize("n_cells", [None, 1, 7, 40])
@pytest.mark.parametrize("k", [1, 6])
def test_equals_all_pairs(spark, n_cells, k):
    x = clustered()
    df = frame(spark, x)
    found = neighbors.nearest(df, df, k, "id", "vec", n_cells=n_cells)
    assert {(r.query_id, r["rank"]): r.neighbor_id for r in found.collect()} == brute(listed(x), listed(x), k)


def test_two_tables_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "ROWS_PER_BLOCK", 7)
    monkeypatch.setattr(neighbors, "QUERIES_AT_ONCE", 3)
    monkeypatch.setattr(neighbors, "HOT_VECTOR_ROWS", 1)
    x, y = clustered(60, 2, 1), clustered(90, 2, 2)
    found = neighbors.nearest(frame(spark, x), frame(spark, y, 1000), 4, "id", "vec", exclude_self=False, n_cells=6)
    assert {(r.query_id, r["rank"]): r.neighbor_id for r in found.collect()} == brute(listed(x), listed(y, 1000), 4, False)


def test_far_cells_are_not_visited(spark, monkeypatch):
    seen = []
    plain = neighbors._search_cells
    monkeypatch.setattr(neighbors, "_search_cells", lambda q, p, k: seen.append(q.count()) or plain(q, p, k))
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 2)) + np.repeat(np.arange(10) * 1000, 30)[:, None]
    df = frame(spark, x)
    found = neighbors.nearest(df, df, 3, "id", "vec", n_cells=40).collect()
    assert len(found) == 900
    home, visited = seen
    assert home == 300 and visited < 300 * 40 / 4


def test_a_task_puts_out_each_query_once(spark, monkeypatch):
    """However many cells a query visits, its vector is not repeated in the memory of a task."""
    seen = []
    plain = neighbors._below_tops

    def counted(rows, *more):
        found = plain(rows, *more)
        seen.append((rows.count(), found.count()))
        return found

    monkeypatch.setattr(neighbors, "_below_tops", counted)
    x = np.random.default_rng(6).normal(size=(200, 12))
    df = frame(spark, x)
    found = neighbors.nearest(df, df, 5, "id", "vec", n_cells=49)
    assert {(r.query_id, r["rank"]): r.neighbor_id for r in found.collect()} == brute(listed(x), listed(x), 5)
    assert len(seen) == 3 and all(rows == put_out for rows, put_out in seen)


def test_blocks_of_longer_vectors_have_fewer_rows():
    assert [neighbors._block_rows(d) for d in (2, 64, 256, 100_000)] == [20_000, 10_000, 2_500, 1_000]


@pytest.mark.parametrize("equal", [False, True])
def test_memory_does_not_follow_the_points(equal):
    x = np.random.default_rng(7).normal(size=(200_000, 4))
    if equal:
        x[:] = x[0]
    ids = np.array([str(i) for i in range(len(x))])
    queries = x[:64].copy()
    tracemalloc.start()
    r, c, d2 = neighbors.best_in_block(queries, np.full(len(queries), np.inf), x, ids, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert r.tolist() == np.repeat(np.arange(64), 3).tolist()
    assert ids[c[:3]].tolist() == ["0", "1", "10"] if equal else c[::3].tolist() == list(range(64))
    assert peak < 150e6  # all distances alone would be 102 MB, and several such tables were made at once


def test_cells_follow_the_points(spark, monkeypatch):
    """Beyond what is shipped a tree is built whose cells are as many as the points ask for."""
    asked = []
    plain = neighbors._search_tree
    monkeypatch.setattr(neighbors, "_search_tree", lambda *a: asked.append(a[4]) or plain(*a))
    monkeypatch.setattr(neighbors, "SHIPPED_NUMBERS", 100)
    monkeypatch.setattr(neighbors, "POINTS_PER_CELL", 20)
    x, y = clustered(30, 2, 3), clustered(600, 2, 4)
    found = neighbors.nearest(frame(spark, x, 5000), frame(spark, y), 3, "id", "vec")
    assert {(r.query_id, r["rank"]): r.neighbor_id for r in found.collect()} == brute(listed(x, 5000), listed(y), 3)
    assert asked == [30]


def test_bounds_hold():
    """The bound from extents is never below the true distance, and no cell with a nearer point is ruled out."""
    rng = np.random.default_rng(8)
    points, pivots, queries = rng.normal(size=(200, 3)), rng.normal(size=(9, 3)), rng.normal(size=(50, 3)) * 2
    to_pivot = neighbors._pivot_distances(points, pivots)
    own = to_pivot.argmin(1)
    parts = [to_pivot[own == c, c] for c in range(9)]
    n = np.array(list(map(len, parts)))
    low, high = (np.array([f(p) if len(p) else e for p in parts]) for f, e in ((np.min, np.inf), (np.max, -np.inf)))
    distances = np.sqrt(((queries[:, None] - points[None]) ** 2).sum(2))
    kth = np.sort(distances, 1)[:, 4]
    to_query = neighbors._pivot_distances(queries, pivots)
    assert (neighbors._upper_bound(to_query, high, n, 5) >= kth - 1e-9).all()
    visit = neighbors._not_ruled_out(to_query, neighbors._pivot_distances(pivots, pivots), low, high, kth)
    needed = np.zeros_like(visit)
    q, p = np.nonzero(distances <= kth[:, None])
    needed[q, own[p]] = True
    assert (visit | ~needed).all() and not visit.all()


def test_queries_are_not_copied_where_cells_rule_out_nothing(spark, monkeypatch):
    """Every query would visit nearly every cell, and its copies would fill the disk."""
    copied = []
    plain = neighbors._search_cells
    monkeypatch.setattr(neighbors, "_search_cells", lambda q, p, k: copied.append(q.count()) or plain(q, p, k))
    monkeypatch.setattr(neighbors, "SHIPPED_NUMBERS", 100)
    monkeypatch.setattr(neighbors, "POINTS_PER_CELL", 10)
    x = np.random.default_rng(9).normal(size=(300, 12))
    df = frame(spark, x)
    found = neighbors.nearest(df, df, 5, "id", "vec")
    assert {(r.query_id, r["rank"]): r.neighbor_id for r in found.collect()} == brute(listed(x), listed(x), 5)
    assert sum(copied) <= 4 * 300


def test_far_clusters_are_worth_a_tree(spark):
    x = np.random.default_rng(10).normal(size=(300, 2)) + np.repeat(np.arange(10) * 1000, 30)[:, None]
    y = np.random.default_rng(11).normal(size=(300, 12))
    for rows, worth in ((x, True), (y, False)):
        blocks = neighbors._blocks(neighbors._keyed(frame(spark, rows), "id", "vec"), 4, 300, rows.shape[1])
        assert neighbors._tree_is_worth(blocks, blocks, 4, 30, rows.shape[1]) == worth


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("one_table", [True, False])
def test_pairs_of_blocks(spark, monkeypatch, kind, one_table):
    """Blocks of both sides, copies and equal distances within and between blocks, fewer than k in a block."""
    monkeypatch.setattr(neighbors, "SHIPPED_NUMBERS", 10)
    monkeypatch.setattr(neighbors, "_block_rows", lambda d: 40)
    monkeypatch.setattr(neighbors, "_tree_is_worth", lambda *a: False)
    rng = np.random.default_rng(12)
    x, y = rng.integers(0, 4, size=(250, 3)).astype(float), rng.integers(0, 5, size=(90, 3)).astype(float)
    x[:60] = x[0]
    points = frame(spark, x).withColumn("vec", F.col("vec").cast(f"array<{kind}>"))
    queries = points if one_table else frame(spark, y, 1000)
    found = neighbors.nearest(queries, points, 50, "id", "vec", exclude_self=one_table)
    expected = brute(listed(x) if one_table else listed(y, 1000), listed(x), 50, one_table)
    assert {(r.query_id, r["rank"]): r.neighbor_id for r in found.collect()} == expected
    assert neighbors.nearest(frame(spark, y).limit(0), points, 5, "id", "vec").count() == 0


@pytest.mark.parametrize("scale", [1e-30, 1e-5, 1.0, 1e5, 1e30])
@pytest.mark.parametrize("centre", [0.0, 1e4])
@pytest.mark.parametrize("grid", [False, True])
def test_rough_comparison_loses_nothing(scale, centre, grid):
    rng = np.random.default_rng(13)
    points, queries = (rng.integers(0, 3, size=(n, 5)) if grid else rng.normal(size=(n, 5)) for n in (4501, 300))
    points, queries = (points + centre) * scale, (queries + centre) * scale
    ids = np.array([str(i) for i in range(len(points))])
    d2 = ((queries[:, None] - points[None]) ** 2).sum(2)
    order = np.lexsort((np.broadcast_to(np.argsort(np.argsort(ids)), d2.shape), d2), axis=1)[:, :6]
    kth = np.sqrt(np.take_along_axis(d2, order[:, 5:], 1)[:, 0])
    for limits in (np.full(300, np.inf), kth * 1.0000001, np.where(np.arange(300) % 2, kth * 1.5, np.inf)):
        r, c, found = neighbors.best_in_block(queries, limits, points, ids, 6)
        assert r.tolist() == np.repeat(np.arange(300), 6).tolist()
        assert (c.reshape(300, 6) == order).all()
        assert (found.reshape(300, 6) == np.take_along_axis(d2, order, 1)).all()


def test_copies_are_dropped_before_the_shuffle():
    batch = pa.RecordBatch.from_pydict({"id": ["5", "1", "9", None, "3"], "vec_key": ["a", "a", "b", "a", "a"], "vec": [[1.0]] * 2 + [[2.0]] + [[1.0]] * 2})
    (kept,) = neighbors._fewer_copies(2)(iter([batch]))
    assert kept.column("id").to_pylist() == ["1", "9", None]


def test_vectors_of_unequal_length_are_refused():
    batch = pa.RecordBatch.from_pydict({"id": ["1", "2"], "vec_key": ["a", "b"], "vec": [[1.0], [1.0, 2.0]], "first": [True, True]})
    with pytest.raises(ValueError, match="one length"):
        neighbors._as_block([batch])


def test_fewer_points_than_k(spark):
    df = frame(spark, np.array([[0.0], [1.0]]))
    assert neighbors.nearest(df, df, 5, "id", "vec").count() == 2
    assert neighbors.nearest(df, df.limit(0), 5, "id", "vec").count() == 0


def test_vote(spark):
    x = np.array([[0.0], [0.1], [0.2], [9.0], [9.1], [9.2]])
    df = frame(spark, x).withColumn("y", (F.col("id") > "2").cast("int"))
    near = neighbors.nearest(df, df, 2, "id", "vec")
    found = {r.query_id: r.p for r in neighbors.vote(near, df, "id", "y", 2).collect()}
    assert found == {"0": 0.0, "1": 0.0, "2": 0.0, "3": 1.0, "4": 1.0, "5": 1.0}


def test_vote_query_copies_no_queries(spark, monkeypatch, tmp_path):
    copied = []
    plain = neighbors._search_cells
    monkeypatch.setattr(neighbors, "_search_cells", lambda q, p, k: copied.append(q.count()) or plain(q, p, k))
    monkeypatch.setattr(neighbors, "SHIPPED_NUMBERS", 100)
    monkeypatch.setattr(neighbors, "POINTS_PER_CELL", 10)
    rng = np.random.default_rng(14)
    x, label = rng.normal(size=(200, 12)).astype(np.float32), rng.integers(0, 5, 200)
    rows = [(i, [float(v) for v in x[i]], int(label[i])) for i in range(200)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    near = brute(listed(x.astype(float)), listed(x.astype(float)), 7)
    expected = {str(i): round(sum(label[int(near[str(i), r])] == 3 for r in range(1, 8)) / 7, 6) for i in range(200)}
    assert {r.query_id: r.p for r in learning.neighbor_vote(spark, str(tmp_path)).collect()} == expected
    assert sum(copied) <= 4 * 200
