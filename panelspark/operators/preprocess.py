"""Model matrix: median and mode imputation, scaling by population deviation, one-hot levels.

``PanelPreprocessor`` is fitted once on training rows and then is one projection of plain column
expressions, so applying it needs no pass of its own and no Python worker. Beyond ``LITERAL_LEVELS`` levels these
are a table instead, numbered per column by range-partitioned positions: rows look their level up in it by a join whose
hot levels are salted, and get sparse vectors.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.features import clean_level
from panelspark.operators import joins
from panelspark.operators.ranking import exact_medians
from panelspark.session import checkpointed

LITERAL_LEVELS = 1_000
HOT_LEVEL_SHARE = 0.01


def numeric_moments(df: DataFrame, cols: Sequence[str]) -> tuple[int, dict[str, tuple]]:
    """All rows, and {column: (known values, mean, population deviation)}, in one aggregate."""
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[
            expr
            for i, c in enumerate(cols)
            for expr in (
                F.count(c).alias(f"n{i}"), F.avg(F.col(c).cast("double")).alias(f"m{i}"),
                F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}"),
            )
        ],
    ).first()
    return row["n"], {c: (row[f"n{i}"], row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}


def filled_moments(n: int, mean: float, deviation: float, n_filled: int, value: float) -> tuple[float, float]:
    """Mean and population deviation after ``n_filled`` further values, all equal to ``value``."""
    total = n + n_filled
    centre = (n * mean + n_filled * value) / total
    spread = n * (deviation**2 + (mean - centre) ** 2) + n_filled * (value - centre) ** 2
    return centre, (spread / total) ** 0.5


def numeric_statistics(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, median, mean, std, n), one row per column; all values exact."""
    _, moments = numeric_moments(df, cols)
    medians = exact_medians(df, cols, {c: moments[c][0] for c in cols})
    rows = [(c, medians[c], moments[c][1], moments[c][2], moments[c][0]) for c in cols]
    schema = "column_name string, median double, mean double, std double, n long"
    return df.sparkSession.createDataFrame(rows, schema)


def level_counts(df: DataFrame, cols: Sequence[str], cleaned: bool = False) -> DataFrame:
    """(column_name, level, n) of the known levels."""
    def level(c: str) -> Column:
        return clean_level(F.col(c)) if cleaned else F.col(c).cast("string")

    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), level(c).alias("level")) for c in cols])
    spread = df.select(F.inline(pairs)).filter(F.col("level").isNotNull())
    return spread.groupBy("column_name", "level").agg(F.count(F.lit(1)).alias("n"))


def column_modes(df: DataFrame, cols: Sequence[str], cleaned: bool = False) -> DataFrame:
    """(column_name, level, n): the most frequent level, the smallest one on a tie."""
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("level"))).alias("best")
    found = level_counts(df, cols, cleaned).groupBy("column_name").agg(best)
    return found.select("column_name", F.col("best.level").alias("level"), (-F.col("best.less")).alias("n"))


def numbered_levels(counts: DataFrame) -> DataFrame:
    """(column_name, level, n, position): levels in order, numbered from 0 per column (stored).

    Ranges of levels are sorted by themselves; a table of one row per range and column gives each its offset.
    """
    ordered = counts.repartitionByRange("column_name", "level").sortWithinPartitions("column_name", "level")
    # the high bits of the id are the partition, the low ones the place in it
    placed = checkpointed(ordered.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    sizes = placed.groupBy("column_name", part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy("column_name").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("column_name", "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    found = placed.withColumn("_part", part).join(offsets, ["column_name", "_part"])
    return checkpointed(found.select("column_name", "level", "n", (F.col("_before") + F.col("_id") - F.col("_first")).alias("position")))


def _sparse_vectors(numbers: Sequence[Column], places: Sequence[Column], width: int) -> Column:
    """Vectors of ``width``: the numbers from place 0 on, and a 1 in each of ``places``, in rising order; NULL is no place.

    Only what is not 0 is stored, or all of a vector where that is shorter.
    """

    n_numbers = len(numbers)

    @F.arrow_udf(VectorUDT())
    def vectors(*columns: pa.Array) -> pa.Array:
        rows = len(columns[0])
        at = np.stack([np.full(rows, i) if i < n_numbers else c.fill_null(-1).to_numpy(zero_copy_only=False)
                       for i, c in enumerate(columns)], axis=1)
        values = np.stack([c.to_numpy(zero_copy_only=False) if i < n_numbers else c.is_valid().to_numpy(zero_copy_only=False)
                           for i, c in enumerate(columns)], axis=1).astype(np.float64)
        kept = values != 0
        stored = kept.sum(1)
        dense = 1.5 * (stored + 1.0) >= width
        ends = np.concatenate([[0], np.cumsum(np.where(dense, width, stored))])
        row, col = np.nonzero(kept)
        data = np.zeros(ends[-1])
        data[ends[row] + np.where(dense[row], at[row, col], kept.cumsum(1)[row, col] - 1)] = values[row, col]
        index_ends = np.concatenate([[0], np.cumsum(np.where(dense, 0, stored))])
        indices = at[row, col][~dense[row]].astype(np.int32)
        return pa.StructArray.from_arrays([
            pa.array(dense.astype(np.int8)),
            pa.array(np.full(rows, width, dtype=np.int32), mask=dense),
            pa.ListArray.from_arrays(pa.array(index_ends.astype(np.int32)), pa.array(indices), mask=pa.array(dense)),
            pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(data)),
        ], names=["type", "size", "indices", "values"])

    return vectors(*numbers, *places)


class _PreprocessorParams(Params):
    numeric = Param(Params._dummy(), "numeric", "numeric columns", TypeConverters.toListString)
    categorical = Param(Params._dummy(), "categorical", "text columns", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "name of the vector column", TypeConverters.toString)


class PanelPreprocessor(Estimator, _PreprocessorParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns medians, means, deviations, modes and levels of the training rows."""

    @keyword_only
    def __init__(self, *, numeric=None, categorical=None, outputCol="features"):
        super().__init__()
        self._setDefault(numeric=[], categorical=[], outputCol="features")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> PanelPreprocessorModel:
        numeric, categorical = self.getOrDefault("numeric"), self.getOrDefault("categorical")
        learned: dict = {"numeric": {}, "categorical": {}}
        if numeric:
            n_rows, moments = numeric_moments(df, numeric)
            empty = [c for c in numeric if not moments[c][0]]
            if empty:
                raise ValueError(f"columns {empty} have no values to learn from")
            medians = exact_medians(df, numeric, {c: moments[c][0] for c in numeric})
            for c in numeric:
                mean, std = filled_moments(*moments[c], n_rows - moments[c][0], medians[c])
                learned["numeric"][c] = {"median": medians[c], "mean": mean, "scale": std or 1.0}
        if categorical:
            counts = level_counts(df, categorical, cleaned=True)
            few = counts.limit(LITERAL_LEVELS + 1).collect()
            if len(few) > LITERAL_LEVELS:
                return self._with_table(learned, categorical, checkpointed(counts))
            found: dict[str, list] = {c: [] for c in categorical}
            for row in few:
                found[row["column_name"]].append((-row["n"], row["level"]))
            for c, levels in found.items():
                mode = min(levels)[1] if levels else None
                learned["categorical"][c] = {"mode": mode, "levels": sorted(level for _, level in levels)}
        return PanelPreprocessorModel(
            learned=json.dumps(learned), outputCol=self.getOrDefault("outputCol")
        )

    def _with_table(self, learned: dict, categorical: list[str], counts: DataFrame) -> PanelPreprocessorModel:
        totals = counts.groupBy("column_name").agg(
            F.count(F.lit(1)).alias("levels"), F.sum("n").alias("total"),
            F.min(F.struct((-F.col("n")).alias("less"), "level")).alias("best"))
        learned["sizes"] = {c: 0 for c in categorical}
        learned["categorical"] = {c: {"mode": None, "hot": []} for c in categorical}
        for row in totals.collect():  # one row a column
            learned["sizes"][row["column_name"]] = row["levels"]
            learned["categorical"][row["column_name"]]["mode"] = row["best"]["level"]
        share = F.col("n") >= HOT_LEVEL_SHARE * F.col("total")
        hot = counts.join(F.broadcast(totals), "column_name").filter(share)  # 1 / HOT_LEVEL_SHARE a column at most
        for row in hot.select("column_name", "level").collect():
            learned["categorical"][row["column_name"]]["hot"].append(row["level"])
        model = PanelPreprocessorModel(learned=json.dumps(learned), outputCol=self.getOrDefault("outputCol"))
        model.level_table = numbered_levels(counts)
        return model


class _ModelWriter(MLWriter):
    def __init__(self, model: PanelPreprocessorModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        if self.model.level_table is not None:
            self.model.level_table.write.parquet(f"{path}/levels")


class _ModelReader(MLReader):
    def load(self, path: str) -> PanelPreprocessorModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = PanelPreprocessorModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        if model.has_table:
            model.level_table = self.sparkSession.read.parquet(f"{path}/levels")
        return model


class PanelPreprocessorModel(Model, _PreprocessorParams, MLReadable, MLWritable):
    """The fitted projection, or with very many levels a join. Levels that training did not show become all zeros."""

    level_table: DataFrame | None = None

    learned = Param(Params._dummy(), "learned", "what was learned, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, learned=None, outputCol="features"):
        super().__init__()
        self._setDefault(learned='{"numeric": {}, "categorical": {}}', outputCol="features")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()

    def copy(self, extra=None) -> PanelPreprocessorModel:
        found = super().copy(extra)
        found.level_table = self.level_table
        return found

    @property
    def has_table(self) -> bool:
        return "sizes" in self.values

    @property
    def values(self) -> dict:
        return json.loads(self.getOrDefault("learned"))

    @property
    def input_columns(self) -> list[str]:
        return [*self.values["numeric"], *self.values["categorical"]]

    @property
    def feature_names(self) -> list[str]:
        listed = self.values
        dummies = [f"{c}_{level}" for c, v in listed["categorical"].items() for level in v["levels"]]
        return [*listed["numeric"], *dummies]

    def feature_table(self, spark) -> DataFrame:
        """(feature, position): the names of all features and their places in the vector."""
        listed = self.values
        if not self.has_table:
            return spark.createDataFrame([(c, i) for i, c in enumerate(self.feature_names)], "feature string, position long")
        numeric = spark.createDataFrame([(c, i) for i, c in enumerate(listed["numeric"])], "feature string, position long")
        return numeric.unionByName(self.level_table.select(
            F.concat_ws("_", "column_name", "level").alias("feature"),
            (self._offset(F.col("column_name")) + F.col("position")).alias("position")))

    def _offset(self, column: Column) -> Column:
        """Where the levels of a column begin in the vector."""
        listed, found = self.values, F.lit(None).cast("long")
        at = len(listed["numeric"])
        for c, n in listed["sizes"].items():
            found = F.when(column == c, F.lit(at).cast("long")).otherwise(found)
            at += n
        return found

    def numeric_columns(self) -> list[Column]:
        exprs = []
        for c, v in self.values["numeric"].items():
            known = F.coalesce(F.col(c).cast("double"), F.lit(v["median"]))
            exprs.append(((known - F.lit(v["mean"])) / F.lit(v["scale"])).alias(c))
        return exprs

    def feature_columns(self) -> list[Column]:
        if self.has_table:
            raise ValueError("the levels are a table here; use transform and feature_table")
        listed = self.values
        exprs = self.numeric_columns()
        for c, v in listed["categorical"].items():
            level = F.coalesce(clean_level(F.col(c)), F.lit(v["mode"]))
            exprs += [
                F.coalesce((level == F.lit(name)).cast("double"), F.lit(0.0)).alias(f"{c}_{name}")
                for name in v["levels"]
            ]
        return exprs

    def as_array(self) -> Column:
        return F.array(*self.feature_columns())

    def with_array(self, df: DataFrame, name: str) -> DataFrame:
        """The features as a dense array, for what works on arrays."""
        if not self.has_table:
            return df.withColumn(name, self.as_array())
        return self._looked_up(df).withColumn(name, vector_to_array(self.getOrDefault("outputCol")))

    def _looked_up(self, df: DataFrame) -> DataFrame:
        """Sparse vectors: the numeric columns, then one place per level of each column.

        They carry no attributes, of which there would be one per level on the driver; ``feature_table`` has the names.
        """
        listed, names, out = self.values, df.columns, self.getOrDefault("outputCol")
        places, used = [], {c: n for c, n in listed["sizes"].items() if n}
        for i, c in enumerate(used):
            level, place = f"_level{i}", f"_place{i}"
            v = listed["categorical"][c]
            table = self.level_table.filter(F.col("column_name") == c).select(
                F.col("level").alias(level), (self._offset(F.lit(c)) + F.col("position")).alias(place))
            df = df.withColumn(level, F.coalesce(clean_level(F.col(c)), F.lit(v["mode"])))
            df = joins.keyed_join(df, [(table, "left")], [level], [(x,) for x in v["hot"]]).drop(level)
            places.append(place)
        width = len(listed["numeric"]) + sum(used.values())
        df = df.withColumn("_features", _sparse_vectors(self.numeric_columns(), [F.col(p) for p in places], width))
        return df.select(*[c for c in names if c != out], F.col("_features").alias(out))

    def _transform(self, df: DataFrame) -> DataFrame:
        if self.has_table:
            return self._looked_up(df)
        return df.withColumn(self.getOrDefault("outputCol"), array_to_vector(self.as_array()))
