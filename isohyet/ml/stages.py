"""Small pipeline stages (DataFrame expressions only) that persist with the standard ML writers."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class PositiveProbability(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``outputCol = inputCol[1]``: the positive-class entry of a probability vector."""

    inputCol = Param(Params._dummy(), "inputCol", "probability vector column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "output double column", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCol: str = "probability", outputCol: str = "p"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOrDefault("outputCol"),
                             vector_to_array(F.col(self.getOrDefault("inputCol")))[1])


class LogisticProbability(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``outputCol = 1 / (1 + exp(-(weights . inputCol + intercept)))`` of a feature vector."""

    inputCol = Param(Params._dummy(), "inputCol", "feature vector column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "probability column", TypeConverters.toString)
    weights = Param(Params._dummy(), "weights", "coefficients", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "intercept", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, inputCol: str = "features", outputCol: str = "p", weights: list | None = None, intercept: float = 0.0):
        super().__init__()
        self._set(**self._input_kwargs)

    @property
    def coefficients(self) -> list[float]:
        return self.getOrDefault("weights")

    def _transform(self, df: DataFrame) -> DataFrame:
        w = F.array(*[F.lit(float(x)) for x in self.coefficients])
        dot = F.aggregate(F.zip_with(vector_to_array(F.col(self.getOrDefault("inputCol"))), w, lambda x, c: x * c),
                          F.lit(self.getOrDefault("intercept")), lambda s, v: s + v)
        return df.withColumn(self.getOrDefault("outputCol"), F.lit(1.0) / (F.lit(1.0) + F.exp(-dot)))


class PlattScaler(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``outputCol = 1 / (1 + exp(-(a * inputCol + b)))`` with fitted a, b."""

    inputCol = Param(Params._dummy(), "inputCol", "raw score column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "calibrated column", TypeConverters.toString)
    a = Param(Params._dummy(), "a", "slope", TypeConverters.toFloat)
    b = Param(Params._dummy(), "b", "intercept", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, inputCol: str = "p", outputCol: str = "p_cal", a: float = 1.0, b: float = 0.0):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        z = F.lit(self.getOrDefault("a")) * F.col(self.getOrDefault("inputCol")) + F.lit(self.getOrDefault("b"))
        return df.withColumn(self.getOrDefault("outputCol"), F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))


class MeanOfColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``outputCol`` = mean of ``inputCols``; the inputs are dropped."""

    inputCols = Param(Params._dummy(), "inputCols", "columns to average", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "output column", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols: list | None = None, outputCol: str = "prob"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = self.getOrDefault("inputCols")
        mean = sum((F.col(c) for c in cols), F.lit(0.0)) / F.lit(float(len(cols)))
        return df.withColumn(self.getOrDefault("outputCol"), mean).drop(*cols)


class DropColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    cols = Param(Params._dummy(), "cols", "columns to drop", TypeConverters.toListString)

    @keyword_only
    def __init__(self, cols: list | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.getOrDefault("cols"))
