"""Exact k-nearest-neighbour join of two vector tables.

Few points (a checked number) are sent to the tasks, which search them without any shuffle. Of more points it is first
measured for some queries how many cells their neighbours could be in. Where distances tell little, as among long vectors
without clusters, that is nearly every cell: then blocks of queries stay where they are and all blocks of points pass by
them, read from the checkpoint, so that nothing but the vectors and their best candidates is ever written.

Otherwise points go into a tree of
two levels: the nearest of about the square root of all cells as top pivots, and below each the nearest of its own pivots.
The number of cells follows the number of points; only the top pivots and their extents are known to the driver. How far
a query's k nearest can be is known from the extents alone, then better from its own cell. It visits only those tops
and then those cells that the triangle inequality cannot rule out: no point is nearer than its distance to the pivot
allows, or than the plane half way to a nearer pivot. A cell is searched in blocks of bounded size, and of two sides
only one that fits in a block is copied, unless both are larger; only the best candidates of a block leave it.

Copies of a vector need no search of their own beyond the few points: equal queries are searched once, and of equal points only the
k + 1 with the smallest ids can be among anybody's k nearest.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.functions.hashing import row_hash
from panelspark.operators import joins
from panelspark.session import checkpointed

SHIPPED_NUMBERS = 4_000_000
POINTS_PER_CELL = 5_000
ROWS_PER_BLOCK = 20_000
SALTS = 16
NUMBERS_PER_BLOCK = 640_000  # ROWS_PER_BLOCK is for short vectors; of longer ones a block has fewer
LEAST_BLOCK_ROWS = 1_000
QUERIES_AT_ONCE = 256
POINTS_AT_ONCE = 2_048  # distances of so many queries and points at once stay in a core's cache
NUMBERS_AT_ONCE = 1_000_000
SEVERAL = 16  # when more than one in so many points pass the rough comparison, it is made again in double precision
HOT_VECTOR_ROWS = 10_000
SAMPLE_ROWS = 256  # pivots, and queries, from which it is told whether a tree rules out cells
COPIES_WORTH = 2  # a tree may copy queries so many times as there are rows in both tables

FOUND = "vec_key string, neighbor string, d2 double"
RANKED = "query_id string, neighbor_id string, distance double, rank int"


def vector_key(vec: Column) -> Column:
    """A text that is equal for equal vectors only."""
    return F.md5(F.concat_ws(",", F.transform(vec, lambda x: x.cast("string"))))


def _matrix(series: pd.Series) -> np.ndarray:
    return np.stack(series.to_numpy()).astype(np.float64) if len(series) else np.empty((0, 0))


def _pivot_distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (vectors**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2.0 * vectors @ pivots.T
    return np.sqrt(np.maximum(squares, 0.0))


def _tolerance(*lengths: float) -> float:
    """Room for rounding, so that no candidate is ruled out by it."""
    return 1e-6 * (1.0 + max(lengths, default=0.0))


class _Rough:
    """Points of a block ready for a rough comparison with queries by one matrix product, in single precision where its
    rounding is bounded. What it returns holds every point whose distance, computed directly, is within the bound."""

    def __init__(self, points: np.ndarray):
        centre = points.mean(0)
        self.centre = centre if np.isfinite(centre).all() else np.zeros(points.shape[1])
        self.points = points - self.centre
        self.squares = (self.points**2).sum(1)
        self.longest = float(np.sqrt(np.fmax.reduce(self.squares)))
        self.wide: dict[type, np.ndarray] = {}

    def _columns(self, kind: type) -> np.ndarray:
        """The points as columns with their squares below; padded to eights by columns that are never near."""
        if kind not in self.wide:
            n, d = self.points.shape
            wide = np.zeros((d + 1, -(-n // 8) * 8), dtype=kind)
            wide[:d, :n], wide[d, :n], wide[d, n:] = self.points.T, self.squares, np.inf
            self.wide[kind] = wide
        return self.wide[kind]

    def near(self, queries: np.ndarray, bounds: np.ndarray, start: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(query row, point row) of points from ``start`` on that may be among the k nearest within the squared ``bounds``."""
        own = queries - self.centre
        squares = (own**2).sum(1)
        reach = (np.sqrt(squares) + self.longest) ** 2
        single = bool(((reach > 1e-24) & (reach < 1e30)).all())
        r, c = self._compared(np.float32 if single else np.float64, own, squares, reach, bounds, start, k)
        if single and len(r) * SEVERAL > len(own) * min(POINTS_AT_ONCE, len(self.points) - start):
            r, c = self._compared(np.float64, own, squares, reach, bounds, start, k)
        return r, c

    def _compared(self, kind: type, own: np.ndarray, squares: np.ndarray, reach: np.ndarray, bounds: np.ndarray,
                  start: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        n, d = self.points.shape
        slack = 4.0 * (d + 8) * (np.finfo(kind).eps / 2) * reach  # more than products and sums of d numbers can be off
        left = np.empty((len(own), d + 1), dtype=kind)
        left[:, :d], left[:, d] = -2.0 * own, 1.0
        part = left @ self._columns(kind)[:, start : start + POINTS_AT_ONCE]  # squared distance less the query's square
        limit = bounds - squares + slack
        open_ended = np.isinf(bounds)
        if open_ended.any() and min(POINTS_AT_ONCE, n - start) >= k:
            limit[open_ended] = np.partition(part[open_ended], k - 1, axis=1)[:, k - 1] + 2 * slack[open_ended]
        with np.errstate(over="ignore"):
            limit = np.nextafter(limit.astype(kind), kind(np.inf))
        eights = (part <= limit[:, None]).reshape(-1, 8)
        some = np.flatnonzero(eights.view(np.uint64))
        i, j = np.nonzero(eights[some])
        r, c = np.divmod(some[i] * 8 + j, part.shape[1])
        real = c < n - start
        return r[real], c[real] + start


def best_in_block(queries: np.ndarray, limits: np.ndarray, points: np.ndarray, ids: np.ndarray,
                  k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, point row, squared distance) of each query's k best points within its limit.

    Candidates come from matrix products; their distances are then computed directly, and equal ones are ordered by id.
    Parts of the points are compared with parts of the queries, and what is found narrows the search in later parts.
    """
    rows, cols, found = [], [], []
    rough = _Rough(points)
    id_place = np.empty(len(ids), dtype=np.int64)
    id_place[np.argsort(ids, kind="stable")] = np.arange(len(ids))
    step = max(1, NUMBERS_AT_ONCE // max(1, points.shape[1]))
    for start in range(0, len(queries), QUERIES_AT_ONCE):
        part = queries[start : start + QUERIES_AT_ONCE]
        bounds = limits[start : start + QUERIES_AT_ONCE] ** 2
        best = waiting = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0))
        for at in range(0, len(points), POINTS_AT_ONCE):
            r, c = rough.near(part, bounds, at, k)
            exact = np.empty(len(r))
            for i in range(0, len(r), step):  # with many equal distances these are many
                exact[i : i + step] = ((part[r[i : i + step]] - points[c[i : i + step]]) ** 2).sum(1)
            waiting = tuple(map(np.concatenate, zip(waiting, (r, c, exact))))
            if len(waiting[0]) > 2 * len(part) or at + POINTS_AT_ONCE >= len(points):
                r, c, exact = map(np.concatenate, zip(best, waiting))
                order = np.lexsort((id_place[c], exact, r))
                r, c, exact = r[order], c[order], exact[order]
                place = np.arange(len(r)) - np.searchsorted(r, r, side="left")
                last = place == k - 1
                bounds[r[last]] = np.minimum(bounds[r[last]], exact[last])
                best = tuple(x[place < k] for x in (r, c, exact))
                waiting = tuple(x[:0] for x in best)
        rows.append(best[0] + start)
        cols.append(best[1])
        found.append(best[2])
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(found)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best candidates per vector. Each task drops the rest before the shuffle."""
    order = Window.partitionBy("vec_key").orderBy("d2", "neighbor")
    return found.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= k).drop("_rn")


# -- few points ---------------------------------------------------------------------------------


def _search_shipped(asked: DataFrame, known: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    """The points, at most ``SHIPPED_NUMBERS`` numbers, go to every task."""
    table = known.select("id", "vec").toPandas()
    shipped = asked.sparkSession.sparkContext.broadcast((table["id"].to_numpy(dtype=str), _matrix(table["vec"])))
    wanted = k + 1 if exclude_self else k

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, points = shipped.value
        for rows in batches:
            if rows.empty:
                continue
            own = rows["id"].to_numpy(dtype=str)
            r, c, d2 = best_in_block(_matrix(rows["vec"]), np.full(len(own), np.inf), points, ids, wanted)
            if exclude_self:
                other = own[r] != ids[c]
                r, c, d2 = r[other], c[other], d2[other]
            rank = np.arange(len(r)) - np.searchsorted(r, r, side="left") + 1
            near = rank <= k
            yield pd.DataFrame({"query_id": own[r[near]], "neighbor_id": ids[c[near]], "distance": np.sqrt(d2[near]),
                                "rank": rank[near].astype(np.int32)})

    return asked.select("id", "vec").mapInPandas(search, RANKED)


# -- the tree -----------------------------------------------------------------------------------


def _upper_bound(distances: np.ndarray, high: np.ndarray, n: np.ndarray, wanted: int) -> np.ndarray:
    """How far the ``wanted`` nearest of each row can be, given how far the points of each cell are from its pivot."""
    reach = np.where(n > 0, distances + high, np.inf)
    order = np.argsort(reach, axis=1)
    enough = np.cumsum(n[order], axis=1) >= wanted
    first = enough.argmax(1)
    rows = np.arange(len(distances))
    return np.where(enough.any(1), reach[rows, order[rows, first]], np.inf)


def _not_ruled_out(distances: np.ndarray, between: np.ndarray, low: np.ndarray, high: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Which cells of one level may hold a point within ``reach`` of each row."""
    nearest_pivot, rows = distances.argmin(1), np.arange(len(distances))
    apart = np.where(between[nearest_pivot] > 0, between[nearest_pivot], np.inf)
    behind_plane = (distances**2 - (distances[rows, nearest_pivot] ** 2)[:, None]) / (2.0 * apart)
    least = np.maximum(np.maximum(distances - high, low - distances), behind_plane)
    slack = _tolerance(float(distances.max(initial=0.0)), float(between.max(initial=0.0)))
    return (least <= reach[:, None] + slack) & np.isfinite(high)[None, :]


class Tops:
    """The top pivots and the extents of their parts, as the driver knows them."""

    def __init__(self, pivots: np.ndarray):
        self.pivots, self.between = pivots, _pivot_distances(pivots, pivots)
        self.n, self.low, self.high = np.zeros(len(pivots), int), np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf)

    def measure(self, points: DataFrame) -> None:
        for row in points.groupBy("top").agg(F.count(F.lit(1)).alias("n"), F.min("dist").alias("low"), F.max("dist").alias("high")).collect():
            self.n[row["top"]], self.low[row["top"]], self.high[row["top"]] = row["n"], row["low"], row["high"]

    def assign(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the nearest top and the distance to it."""
        pivots = self.pivots

        @F.pandas_udf("struct<top int, dist double>")
        def to_top(vectors: pd.Series) -> pd.DataFrame:
            distances = _pivot_distances(_matrix(vectors), pivots)
            top = distances.argmin(1)
            return pd.DataFrame({"top": top.astype(np.int32), "dist": distances[np.arange(len(top)), top]})

        return rows.withColumn("_at", to_top("vec")).select(*rows.columns, "_at.top", "_at.dist")

    def routed(self, rows: DataFrame) -> DataFrame:
        """``rows`` once for each top that their bound ``ub`` cannot rule out."""
        pivots, between, low, high = self.pivots, self.between, self.low, self.high

        @F.pandas_udf("array<int>")
        def reached(vectors: pd.Series, bounds: pd.Series) -> pd.Series:
            visit = _not_ruled_out(_pivot_distances(_matrix(vectors), pivots), between, low, high, bounds.to_numpy())
            return pd.Series([np.nonzero(v)[0].astype(np.int32) for v in visit])

        return rows.withColumn("top", F.explode(reached("vec", "ub")))


def _block_rows(dimensions: int) -> int:
    """How many vectors make a block."""
    return min(ROWS_PER_BLOCK, max(LEAST_BLOCK_ROWS, NUMBERS_PER_BLOCK // max(1, dimensions)))


def _below_tops(rows: DataFrame, key: str, tree: DataFrame, tops: Tops, apply, schema: str) -> DataFrame:
    """``apply(rows, row of the tree)`` for blocks of bounded size of the rows of each top."""
    n_tops, block_rows = tops.pivots.shape[0], _block_rows(tops.pivots.shape[1])
    counts = {r["top"]: r["n"] for r in rows.groupBy("top").agg(F.count(F.lit(1)).alias("n")).collect()}  # n_tops rows at most
    listed = F.array(*[F.lit(max(1, -(-counts.get(t, 0) // block_rows))) for t in range(n_tops)])
    blocks = listed[F.col("top")].cast("long")
    cut = rows.withColumn("block", F.pmod(F.xxhash64(key), blocks))
    beside = tree.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))

    def work(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return apply(left, right.iloc[0]) if len(left) and len(right) else apply(left.iloc[:0], None)

    return cut.groupBy("top", "block").cogroup(beside.groupBy("top", "block")).applyInPandas(work, schema)


def _nothing(*names: str) -> pd.DataFrame:
    return pd.DataFrame({c: np.array([], dtype=object) for c in names})


def _pivots_of(row) -> np.ndarray:
    return np.stack([np.asarray(v, float) for v in row["pivots"]])


def _tree(points: DataFrame, tops: Tops, n_below: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(id, vec, cell) of all points, and per top its pivots with the number and extent of each one's points."""
    order = Window.partitionBy("top").orderBy(row_hash(["vec_key"], seed), "vec_key")
    chosen = points.filter("_rn = 1").withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= n_below)
    pivots = checkpointed(chosen.groupBy("top").agg(F.sort_array(F.collect_list(F.struct("_place", "vec"))).alias("_p")).select(
        "top", F.col("_p.vec").alias("pivots")))

    def assign(rows: pd.DataFrame, node) -> pd.DataFrame:
        if node is None:
            return _nothing("id", "vec", "cell", "dist")
        distances = _pivot_distances(_matrix(rows["vec"]), _pivots_of(node))
        own = distances.argmin(1)
        return pd.DataFrame({"id": rows["id"], "vec": rows["vec"], "cell": node["top"] * n_below + own,
                             "dist": distances[np.arange(len(own)), own]})

    placed = checkpointed(_below_tops(points.select("id", "vec", "top"), "id", pivots, tops, assign,
                                      "id string, vec array<double>, cell long, dist double"))
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("dist").alias("low"), F.max("dist").alias("high"))
    extents = cells.groupBy(F.floor(F.col("cell") / n_below).cast("int").alias("top")).agg(
        F.collect_list(F.struct((F.col("cell") % n_below).cast("int").alias("place"), "n", "low", "high")).alias("cells"))
    return placed.select("id", "vec", "cell"), checkpointed(pivots.join(extents, "top"))


def _extents(node, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, low, high = np.zeros(width, int), np.full(width, np.inf), np.full(width, -np.inf)
    for cell in node["cells"]:
        n[cell["place"]], low[cell["place"]], high[cell["place"]] = cell["n"], cell["low"], cell["high"]
    return n, low, high


def _at_home(queries: DataFrame, tops: Tops, tree: DataFrame, n_below: int, wanted: int) -> DataFrame:
    """(vec_key, vec, ub, cell): the cell of each query, and how far its nearest can be by the extents of all tops and of
    the cells of its own."""
    pivots, high, n = tops.pivots, tops.high, tops.n

    def assign(rows: pd.DataFrame, node) -> pd.DataFrame:
        if node is None:
            return _nothing("vec_key", "vec", "ub", "cell")
        vectors, below = _matrix(rows["vec"]), _pivots_of(node)
        distances = _pivot_distances(vectors, below)
        n_here, _, high_here = _extents(node, len(below))
        bound = np.minimum(_upper_bound(_pivot_distances(vectors, pivots), high, n, wanted),
                           _upper_bound(distances, high_here, n_here, wanted))
        return pd.DataFrame({"vec_key": rows["vec_key"], "vec": rows["vec"],
                             "ub": bound + _tolerance(float(distances.max(initial=0.0))),
                             "cell": node["top"] * n_below + distances.argmin(1)})

    rows = tops.assign(queries).drop("dist")
    return _below_tops(rows, "vec_key", tree, tops, assign, "vec_key string, vec array<double>, ub double, cell long")


def _visits(queries: DataFrame, tops: Tops, tree: DataFrame, n_below: int) -> DataFrame:
    """(vec_key, vec, ub, cell): every cell but its own that a query cannot rule out."""

    def cells(rows: pd.DataFrame, node) -> pd.DataFrame:
        if node is None:
            return _nothing("vec_key", "vec", "ub", "cells")
        below = _pivots_of(node)
        _, low, high = _extents(node, len(below))
        visit = _not_ruled_out(_pivot_distances(_matrix(rows["vec"]), below), _pivot_distances(below, below), low, high, rows["ub"].to_numpy())
        places = node["top"] * n_below + np.arange(len(below))
        visit &= places[None, :] != rows["cell"].to_numpy()[:, None]
        return rows[["vec_key", "vec", "ub"]].assign(cells=[places[v] for v in visit])

    # the vector is repeated per cell by Spark; in a task and in the checkpoint there is one of each row
    found = checkpointed(_below_tops(tops.routed(queries), "vec_key", tree, tops, cells,
                                     "vec_key string, vec array<double>, ub double, cells array<long>"))
    return found.select("vec_key", "vec", "ub", F.explode("cells").alias("cell"))


def _search_cells(queries: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """Candidates of (vec_key, vec, ub, cell) among the points (id, vec, cell) of the same cell."""
    block_rows = _block_rows(points.select(F.size("vec").alias("d")).first()["d"])
    sizes = points.groupBy("cell").agg(F.count(F.lit(1)).alias("np")).join(
        queries.groupBy("cell").agg(F.count(F.lit(1)).alias("nq")), "cell")
    sizes = sizes.select("cell", *[F.ceil(F.col(n) / block_rows).alias(b) for n, b in (("np", "pbs"), ("nq", "qbs"))])
    salted = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    def sized(rows: DataFrame, key: str) -> DataFrame:
        return rows.withColumn("salt", F.pmod(F.xxhash64(key, F.lit(1)), F.lit(SALTS))).join(salted, ["cell", "salt"])

    q = sized(queries, "vec_key").withColumn("qb", F.pmod(F.xxhash64("vec_key"), F.col("qbs"))).withColumn("pb", every("pbs"))
    p = sized(points, "id").withColumn("pb", F.pmod(F.xxhash64("id"), F.col("pbs"))).withColumn("qb", every("qbs"))
    keys = ["cell", "pb", "qb"]

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            none = np.array([], dtype=object)
            return pd.DataFrame({"vec_key": none, "neighbor": none, "d2": none.astype(float)})
        ids = right["id"].to_numpy(dtype=str)
        r, c, d2 = best_in_block(_matrix(left["vec"]), left["ub"].to_numpy(), _matrix(right["vec"]), ids, k)
        return pd.DataFrame({"vec_key": left["vec_key"].to_numpy()[r], "neighbor": ids[c], "d2": d2})

    left = q.select(*keys, "vec_key", "vec", "ub").groupBy(*keys)
    return left.cogroup(p.select(*keys, "id", "vec").groupBy(*keys)).applyInPandas(search, FOUND)


def _search_tree(asked: DataFrame, known: DataFrame, k: int, exclude_self: bool, n_cells: int, seed: int) -> DataFrame:
    wanted = k + 1 if exclude_self else k
    asked, known = (rows.withColumn("vec_key", vector_key(F.col("vec"))) for rows in (asked, known))
    copies = Window.partitionBy("vec_key").orderBy("id")
    known = checkpointed(known.withColumn("_rn", F.row_number().over(copies)).filter(F.col("_rn") <= wanted))
    distinct = checkpointed(asked.groupBy("vec_key").agg(F.any_value("vec").alias("vec")))
    n_tops = math.ceil(math.sqrt(n_cells))
    n_below = math.ceil(n_cells / n_tops)
    chosen = known.filter("_rn = 1").orderBy(row_hash(["vec_key"], seed + 1), "vec_key").limit(n_tops)
    tops = Tops(np.array([row["vec"] for row in chosen.select("vec").collect()], dtype=np.float64))
    points = checkpointed(tops.assign(known))
    tops.measure(points)
    while not tops.n.all():  # of nearly equal pivots, rounding may leave one without points
        tops = Tops(tops.pivots[tops.n > 0])
        points = checkpointed(tops.assign(known))
        tops.measure(points)
    placed, tree = _tree(points, tops, n_below, seed)
    home = checkpointed(_at_home(distinct, tops, tree, n_below, wanted))
    first = checkpointed(_best(_search_cells(home, placed, wanted), wanted))
    reached = first.groupBy("vec_key").agg(F.when(F.count(F.lit(1)) >= wanted, F.sqrt(F.max("d2"))).alias("reach"))
    bounded = home.join(reached, "vec_key", "left").withColumn("ub", F.least(F.coalesce("reach", "ub"), "ub")).drop("reach")
    visits = _visits(checkpointed(bounded), tops, tree, n_below)
    found = first.unionByName(_search_cells(visits, placed, wanted))
    lists = _best(found, wanted).groupBy("vec_key").agg(F.sort_array(F.collect_list(F.struct("d2", "neighbor"))).alias("near"))
    return _ranked(asked, lists, k, exclude_self)


def _ranked(asked: DataFrame, lists: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    """The neighbours of each query from the list of its vector."""
    back = joins.keyed_join(asked.select("id", "vec_key"), [(lists, "inner")], ["vec_key"],
                            joins.find_hot(asked, ["vec_key"], min_rows=HOT_VECTOR_ROWS))
    near = F.filter("near", lambda s: s["neighbor"] != F.col("id")) if exclude_self else F.col("near")
    ranked = back.select(F.col("id").alias("query_id"), F.posexplode(F.slice(near, 1, k)).alias("pos", "s"))
    return ranked.select(
        "query_id", F.col("s.neighbor").alias("neighbor_id"), F.sqrt("s.d2").alias("distance"),
        (F.col("pos") + 1).alias("rank"))


# -- all pairs ----------------------------------------------------------------------------------


def _fewer_copies(wanted: int):
    """Drops of each batch what cannot be among the ``wanted`` smallest ids of a vector, so that copies are not shuffled."""

    def fewer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pd.DataFrame({"vec_key": batch.column("vec_key").to_pandas(), "id": batch.column("id").to_pandas()})
            if rows["vec_key"].duplicated().any():
                place = rows.sort_values("id", kind="stable", na_position="first").groupby("vec_key", dropna=False).cumcount()
                batch = batch.take(pa.array(np.sort(place.index[place < wanted])))
            yield batch

    return fewer


def _as_block(batches: list[pa.RecordBatch]) -> bytes:
    rows = pa.Table.from_batches(batches).combine_chunks()
    rows = rows.set_column(0, "id", rows.column("id").fill_null("None")).sort_by("id")
    vectors = rows.column("vec").combine_chunks()
    lengths = np.unique(vectors.value_lengths().to_numpy(zero_copy_only=False))
    if vectors.null_count or len(lengths) > 1:
        raise ValueError(f"vectors must all have one length, found {lengths.tolist()}")
    numbers = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
    return pickle.dumps({"ids": np.array(rows.column("id").to_pylist(), dtype=object),
                         "keys": np.array(rows.column("vec_key").to_pylist(), dtype=object),
                         "first": rows.column("first").to_numpy(), "vecs": numbers}, protocol=5)


def _blocks(rows: DataFrame, wanted: int, n_rows: int, dimensions: int) -> DataFrame:
    """(block, data): the rows (id, vec_key, vec) but for needless copies, in packed blocks, about one a partition."""
    most = _block_rows(dimensions)
    n_blocks = max(-(-n_rows // most), min(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-n_rows // LEAST_BLOCK_ROWS)))
    kept = rows.mapInArrow(_fewer_copies(wanted), rows.schema).repartition(n_blocks, "vec_key").withColumn(
        "_rn", F.row_number().over(Window.partitionBy("vec_key").orderBy("id"))).filter(F.col("_rn") <= wanted)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, waiting = TaskContext.get().partitionId() << 32, []

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"block": pa.array([number], pa.int64()), "data": pa.array([_as_block(waiting)], pa.binary())})

        for batch in batches:
            # partitions differ a little, and what is over shall not make a block of a few rows
            if waiting and sum(map(len, waiting)) + len(batch) > 1.5 * most:
                yield packed()
                number, waiting = number + 1, []
            if len(batch):
                waiting.append(batch)
        if waiting:
            yield packed()

    return checkpointed(kept.select("id", "vec_key", "vec", (F.col("_rn") == 1).alias("first")).mapInArrow(pack, "block long, data binary"))


def _some_vectors(blocks: DataFrame, n: int) -> np.ndarray:
    """``n`` vectors if there are so many, about as many of each block, no two equal."""
    each = -(-n // max(1, blocks.count()))

    def some(row) -> np.ndarray:
        block = pickle.loads(row["data"])
        of = np.flatnonzero(block["first"])
        return block["vecs"][of[np.argsort(block["keys"][of], kind="stable")][:each]].astype(np.float64)

    return np.concatenate(blocks.rdd.map(some).collect())[:n]


def _tree_is_worth(asked: DataFrame, known: DataFrame, wanted: int, n_cells: int, dimensions: int) -> bool:
    """Whether cells rule out so much that copies of the queries for the cells left are few. This is told from the true
    neighbours of some queries and the extents of some cells; it decides how to search, never what is found."""
    few = max(1, min(SAMPLE_ROWS, NUMBERS_PER_BLOCK // max(1, dimensions)))
    pivots, sample = _some_vectors(known, min(few, n_cells)), _some_vectors(asked, few)

    def measured(row) -> tuple[np.ndarray, ...]:
        block = pickle.loads(row["data"])
        vectors = block["vecs"].astype(np.float64)
        distances = _pivot_distances(vectors, pivots)
        own = distances.argmin(1)
        n, low, high = np.bincount(own, minlength=len(pivots)), np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf)
        np.minimum.at(low, own, distances[np.arange(len(own)), own])
        np.maximum.at(high, own, distances[np.arange(len(own)), own])
        r, _, d2 = best_in_block(sample, np.full(len(sample), np.inf), vectors, block["ids"], wanted)
        best = np.full((len(sample), wanted), np.inf)
        best[r, np.arange(len(r)) - np.searchsorted(r, r, side="left")] = d2
        return n, low, high, best

    def together(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        return (a[0] + b[0], np.minimum(a[1], b[1]), np.maximum(a[2], b[2]),
                np.sort(np.concatenate([a[3], b[3]], axis=1), axis=1)[:, : a[3].shape[1]])

    n, low, high, best = known.rdd.map(measured).treeReduce(together)
    visited = _not_ruled_out(_pivot_distances(sample, pivots), _pivot_distances(pivots, pivots), low, high, np.sqrt(best[:, -1]))
    n_asked = asked.rdd.map(lambda row: int(pickle.loads(row["data"])["first"].sum())).sum()
    return (visited.sum(1) - 1).mean() * n_asked <= COPIES_WORTH * (n_asked + int(n.sum()))


def _merged(best: tuple[np.ndarray, ...], more: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    """The k best per row of two lists (row, squared distance, id); equal distances are ordered by id."""
    r, d2, ids = map(np.concatenate, zip(best, more))
    order = np.lexsort((d2, r))
    r, d2, ids = r[order], d2[order], ids[order]
    same = (r[1:] == r[:-1]) & (d2[1:] == d2[:-1])
    tied = np.flatnonzero(np.append(same, False) | np.append(False, same))
    place = np.zeros(len(r), dtype=np.int64)
    place[tied[np.argsort(ids[tied], kind="stable")]] = np.arange(len(tied))
    order = np.lexsort((place, d2, r))
    keep = order[np.arange(len(r)) - np.searchsorted(r, r, side="left") < k]
    return r[keep], d2[keep], ids[keep]


def _search_pairs(asked: DataFrame, known: DataFrame, k: int) -> DataFrame:
    """(vec_key, near) by comparing each block of queries with all blocks of points. A task holds one block of either
    side at a time and the best candidates so far; points are read from the checkpoint again for each block of queries,
    and are neither shuffled nor sent to the driver."""

    def search(pairs: Iterable) -> Iterator[tuple]:
        for _, group in groupby(pairs, key=lambda pair: pair[0]["block"]):
            keys = None
            for left, right in group:
                if keys is None:
                    block = pickle.loads(left["data"])
                    keys, queries = block["keys"][block["first"]], block["vecs"][block["first"]].astype(np.float64)
                    best = (np.empty(0, dtype=np.int64), np.empty(0), np.empty(0, dtype=object))
                if not len(keys):
                    continue
                block = pickle.loads(right["data"])
                limits = np.full(len(keys), np.inf)
                last = np.arange(len(best[0])) - np.searchsorted(best[0], best[0], side="left") == k - 1
                limits[best[0][last]] = np.sqrt(best[1][last])
                r, c, d2 = best_in_block(queries, limits, block["vecs"].astype(np.float64), block["ids"], k)
                best = _merged(best, (r, d2, block["ids"][c]), k)
            ends = np.searchsorted(best[0], np.arange(len(keys) + 1))
            for i, key in enumerate(keys):
                yield key, list(zip(best[1][ends[i] : ends[i + 1]].tolist(), best[2][ends[i] : ends[i + 1]]))

    pairs = asked.rdd.cartesian(known.rdd.coalesce(1))  # one partition of all points for each of queries: its task sees all
    return asked.sparkSession.createDataFrame(
        pairs.mapPartitions(search), "vec_key string, near array<struct<d2: double, neighbor: string>>", verifySchema=False)


def _keyed(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec_key, vec) with the numbers as they are if single, which take half the room."""
    kind = rows.schema[vec_col].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    kept = rows.select(F.col(id_col).cast("string").alias("id"), F.col(vec_col).cast("array<float>" if single else "array<double>").alias("vec"))
    return kept.select("id", vector_key(F.col("vec")).alias("vec_key"), "vec")


def nearest(queries: DataFrame, points: DataFrame, k: int, id_col: str, vec_col: str,
            exclude_self: bool = True, n_cells: int | None = None, seed: int = 42) -> DataFrame:
    """(query_id, neighbor_id, distance, rank): the k nearest points of every query.

    Ids are compared as text; equal distances go to the smaller id. With ``exclude_self`` a point
    with the query's own id is no neighbour. ``n_cells`` asks for a tree whatever the points are like.
    """
    vec = F.col(vec_col).cast("array<double>")
    asked, known = (rows.select(F.col(id_col).cast("string").alias("id"), vec.alias("vec")) for rows in (queries, points))
    size = known.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("vec")).alias("numbers")).first()
    if not size["n"]:
        return asked.sparkSession.createDataFrame([], RANKED)
    if n_cells is None and size["numbers"] <= SHIPPED_NUMBERS:
        return _search_shipped(asked, known, k, exclude_self)
    cells = n_cells or max(1, size["n"] // POINTS_PER_CELL)
    if n_cells is None:
        wanted, dimensions = k + 1 if exclude_self else k, size["numbers"] // size["n"]
        n_asked = size["n"] if queries is points else asked.count()
        if not n_asked:
            return asked.sparkSession.createDataFrame([], RANKED)
        stored = _blocks(_keyed(points, id_col, vec_col), wanted, size["n"], dimensions)
        sought = stored if queries is points else _blocks(_keyed(queries, id_col, vec_col), 1, n_asked, dimensions)
        if not _tree_is_worth(sought, stored, wanted, cells, dimensions):
            return _ranked(_keyed(queries, id_col, vec_col), _search_pairs(sought, stored, wanted), k, exclude_self)
    return _search_tree(asked, known, k, exclude_self, cells, seed)


def vote(neighbours: DataFrame, labels: DataFrame, id_col: str, label_col: str, k: int) -> DataFrame:
    """(query_id, p): share of label 1 among the neighbours."""
    known = labels.select(F.col(id_col).cast("string").alias("neighbor_id"), F.col(label_col).alias("_y"))
    joined = neighbours.filter(F.col("rank") <= k).join(known, "neighbor_id")
    return joined.groupBy("query_id").agg(F.avg(F.col("_y").cast("double")).alias("p"))
