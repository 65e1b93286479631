"""Steps of fitted classifiers that Spark ML lacks, as transformers that can be saved with the rest of a pipeline."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.numeric import safe_score, threshold


class Saved(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A transformer whose whole state is its parameters."""

    def __init__(self, **values):
        super().__init__()
        self._set(**values)

    def of(self, name: str):
        return self.getOrDefault(name)


def _param(name: str, doc: str, kind=TypeConverters.identity) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=kind)


def moments(rows: DataFrame, column: str = "features") -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, mean, population variance) of each feature; zeros of sparse vectors are counted, not stored."""
    made = Summarizer.metrics("count", "mean", "variance").summary(F.col(column)).alias("m")
    n, mean, variance = rows.select(made).select("m.count", "m.mean", "m.variance").first()
    return n, mean.toArray(), variance.toArray() * (n - 1) / max(n, 1)


def scaler(train: DataFrame) -> tuple[ElementwiseProduct, int]:
    """(division by the population deviation of training rows, number of features that vary).

    Features that do not vary become 0, so a fit leaves them out. Means are not taken off: vectors stay sparse, and a
    linear model with a free intercept, a distance and a kernel of distances are the same without.
    """
    _, _, variance = moments(train)
    varies = variance > 1e-24 * np.maximum(1.0, variance.max(initial=0.0))
    factors = np.where(varies, 1.0 / np.sqrt(np.where(varies, variance, 1.0)), 0.0)
    return ElementwiseProduct(scalingVec=Vectors.dense(factors), inputCol="features", outputCol="scaled"), int(varies.sum())


class Rename(Saved):
    """Column `source` in the place of `target`."""

    source = _param("source", "column that is renamed", TypeConverters.toString)
    target = _param("target", "its new name", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, source: str | None = None, target: str | None = None):
        super().__init__(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(self.of("target")).withColumnRenamed(self.of("source"), self.of("target"))


class RandomCuts(Saved):
    """Column `into`: each feature as the number of its random thresholds below it."""

    edges = _param("edges", "thresholds of each feature, rising, as JSON", TypeConverters.toString)
    into = _param("into", "column of the result", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, edges: str | None = None, into: str | None = None):
        super().__init__(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        edges = F.from_json(F.lit(self.of("edges")), "array<array<double>>")
        cut = F.zip_with(vector_to_array("features"), edges, lambda v, e: F.size(F.filter(e, lambda t: t < v)).cast("double"))
        return df.withColumn(self.of("into"), array_to_vector(cut))


class FourierMap(Saved):
    """sqrt(2 / size) cos(W x + b) with W and b drawn by the seed, so every task has the same."""

    width = _param("width", "features", TypeConverters.toInt)
    size = _param("size", "functions", TypeConverters.toInt)
    gamma = _param("gamma", "of the kernel exp(-gamma d^2)", TypeConverters.toFloat)
    seed = _param("seed", "of the draws", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, width: int | None = None, size: int | None = None, gamma: float | None = None, seed: int | None = None):
        super().__init__(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        width, size = self.of("width"), self.of("size")
        rng = np.random.RandomState(self.of("seed"))
        w = rng.normal(scale=math.sqrt(2.0 * self.of("gamma")), size=(width, size))
        b = rng.uniform(0.0, 2.0 * math.pi, size=size)
        root = math.sqrt(2.0 / size)

        @F.pandas_udf("array<double>")
        def project(rows: pd.Series) -> pd.Series:
            if not len(rows):
                return pd.Series([], dtype=object)
            return pd.Series(list(root * np.cos(np.stack(rows.to_numpy()) @ w + b)))

        return df.withColumn("features", array_to_vector(project(vector_to_array("features"))))


def scored(df: DataFrame, score: Column, prediction: Column | None = None) -> DataFrame:
    """Adds the score made safe, and the class it says."""
    out = df.withColumn("score", safe_score(score))
    return out.withColumn("prediction", (threshold(F.col("score")) if prediction is None else prediction).cast("int"))


class Margin(Saved):
    """Mean of sigmoids of the margins of some linear models, each calibrated by slope and offset."""

    columns = _param("columns", "raw predictions", TypeConverters.toListString)
    slopes = _param("slopes", "of the sigmoids", TypeConverters.toListFloat)
    offsets = _param("offsets", "of the sigmoids", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, columns: list | None = None, slopes: list | None = None, offsets: list | None = None):
        super().__init__(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        total = F.lit(0.0)
        for column, a, b in zip(self.of("columns"), self.of("slopes"), self.of("offsets"), strict=True):
            total = total + 1.0 / (1.0 + F.exp(-(vector_to_array(column)[1] * a + b)))
        return scored(df, total / len(self.of("columns")))


class Probability(Saved):
    """The probability of class 1 of the model before, and the class that it predicts."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return scored(df, vector_to_array("probability")[1], F.col("prediction"))


class MeanProbability(Saved):
    """The mean of probabilities of several models."""

    columns = _param("columns", "probabilities", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns: list | None = None):
        super().__init__(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        total = F.lit(0.0)
        for column in self.of("columns"):
            total = total + vector_to_array(column)[1]
        out = scored(df, total / len(self.of("columns")))
        return out.withColumn("prediction", (F.col("score") > 0.5).cast("int"))


class GaussianBayes(Saved):
    """Log-odds of two Gaussian classes with independent features: those of a row of zeros, and what its cells change.

    For class means m and variances v a cell x changes them by a x^2 + b x, with a = 1 / 2 v0 - 1 / 2 v1 and
    b = m1 / v1 - m0 / v0. Column `odds` has them whole, so the surest rows are still ranked where the score is 0 or 1.
    """

    base = _param("base", "log-odds of a row of zeros", TypeConverters.toFloat)
    squares = _param("squares", "a of each feature", TypeConverters.toListFloat)
    lines = _param("lines", "b of each feature", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, base: float | None = None, squares: list | None = None, lines: list | None = None):
        super().__init__(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        base, a, b = self.of("base"), np.array(self.of("squares")), np.array(self.of("lines"))

        @F.udf("double")
        def odds(row) -> float:
            at, x = (row.indices, row.values) if hasattr(row, "indices") else (slice(None), row.toArray())
            return float(base + (a[at] * x * x + b[at] * x).sum())

        out = df.withColumn("odds", odds("features"))
        # exp of a large number is infinite, which gives 0; nothing is cut off.
        return scored(out, 1.0 / (1.0 + F.exp(-F.col("odds"))))


class _TableWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.sparkSession.read.parquet(self.instance.of("table")).write.parquet(f"{path}/table")


class _TableReader(DefaultParamsReader):
    def load(self, path: str):
        return super().load(path)._set(table=f"{path}/table")


class Neighbours(Saved):
    """The k nearest of the training rows, which lie in a table of (row_id, target, values) and are saved with it."""

    table = _param("table", "folder of the training rows", TypeConverters.toString)
    k = _param("k", "neighbours", TypeConverters.toInt)
    seed = _param("seed", "of the cells' centres", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, table: str | None = None, k: int | None = None, seed: int | None = None):
        super().__init__(**self._input_kwargs)

    def write(self) -> _TableWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> _TableReader:
        return _TableReader(cls)

    def _transform(self, df: DataFrame) -> DataFrame:
        from scoreloom.operators import neighbors

        train = df.sparkSession.read.parquet(self.of("table"))
        rows = df.select("row_id", "target", vector_to_array("features").alias("values"))
        found = neighbors.knn_classify(train, rows, self.of("k"), seed=self.of("seed"))
        return df.drop("score", "prediction").join(found.select("row_id", "score", "prediction"), "row_id")
