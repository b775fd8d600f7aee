"""A trained propensity model as one unit: preprocess, classify, calibrate; save, load, score."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.features import clean_level
from panelspark.operators import checks
from panelspark.operators.calibration import IsotonicCalibrator, SigmoidCalibrator
from panelspark.operators.classifiers import FittedClassifier, NeighbourVote
from panelspark.operators.preprocess import PanelPreprocessorModel
from panelspark.operators.ranking import key_text

PREDICTED = "predicted_probabilities"


def user_model_udf(predict: Callable[[pd.DataFrame], Sequence[float]]):
    """A vectorised UDF for a model of the user's own: struct of features to P(y = 1).

    ``predict`` gets a batch as a pandas frame with the feature names as columns.
    """
    @F.pandas_udf("double")
    def scored(features: pd.DataFrame) -> pd.Series:
        return pd.Series(predict(features), dtype="float64")

    def column(*feature_cols: str) -> Column:
        return scored(F.struct(*feature_cols))

    return column


class CleanLevels(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Cleaned text values as a pipeline stage; a pattern for row-wise stages of one's own."""

    inputCols = Param(Params._dummy(), "inputCols", "text columns", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._setDefault(inputCols=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: clean_level(F.col(c)) for c in self.getOrDefault("inputCols")})


@dataclass
class PropensityModel:
    preprocessor: PanelPreprocessorModel
    classifier: FittedClassifier | NeighbourVote
    calibrator: SigmoidCalibrator | IsotonicCalibrator | None
    signature: str
    keys: tuple[str, ...]

    def score(self, df: DataFrame, out_col: str = PREDICTED) -> DataFrame:
        """The rows with ``out_col``. Input types are checked against those of training."""
        rows = checks.enforce_signature(df, self.signature).withColumn("row_key", key_text(self.keys))
        scored = self.classifier.score(self.preprocessor.transform(rows))
        if self.calibrator is not None:
            scored = self.calibrator.apply(scored.drop("p"), "score", "p")
        return scored.select(*df.columns, F.col("p").alias(out_col))

    def save(self, spark: SparkSession, path: str) -> None:
        self.preprocessor.write().overwrite().save(f"{path}/preprocessor")
        meta = {"classifier": self.classifier.name, "signature": self.signature, "keys": list(self.keys)}
        if isinstance(self.classifier, NeighbourVote):
            meta |= {"k": self.classifier.k, "key": self.classifier.key, "label": self.classifier.label_col}
            self.classifier.train.write.mode("overwrite").parquet(f"{path}/classifier")
        else:
            meta["class"] = type(self.classifier.model).__name__
            self.classifier.model.write().overwrite().save(f"{path}/classifier")
        if isinstance(self.calibrator, SigmoidCalibrator):
            meta["sigmoid"] = [self.calibrator.slope, self.calibrator.intercept]
        elif isinstance(self.calibrator, IsotonicCalibrator):
            meta["isotonic"] = {"edges": self.calibrator.edges, "n_steps": self.calibrator.n_steps}
            self.calibrator.steps.write.mode("overwrite").parquet(f"{path}/calibrator")
        one_row = spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1)
        one_row.write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> PropensityModel:
        meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
        preprocessor = PanelPreprocessorModel.load(f"{path}/preprocessor")
        if "k" in meta:
            train = spark.read.parquet(f"{path}/classifier")
            classifier = NeighbourVote(train, meta["key"], meta["label"], meta["k"])
        else:
            model = DefaultParamsReader.loadParamsInstance(f"{path}/classifier", spark)
            classifier = FittedClassifier(meta["classifier"], model)
        calibrator = None
        if "sigmoid" in meta:
            calibrator = SigmoidCalibrator(*meta["sigmoid"])
        elif meta.get("isotonic"):
            calibrator = IsotonicCalibrator(spark.read.parquet(f"{path}/calibrator"), **meta["isotonic"])
        return cls(preprocessor, classifier, calibrator, meta["signature"], tuple(meta["keys"]))
