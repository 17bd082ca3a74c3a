"""Random Fourier features: an explicit map whose inner products approximate the Gaussian kernel."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 256


def directions(inputs: int, size: int, gamma: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies (``size`` x ``inputs``) and phases: normal with variance 2 gamma, and uniform on the circle."""
    rng = np.random.default_rng(seed)
    return rng.normal(scale=math.sqrt(2 * gamma), size=(size, inputs)), rng.uniform(0, 2 * math.pi, size)


class RandomFourierFeatures(Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """``sqrt(2 / size) * cos(W x + b)`` of a vector column. The product of two images is exp(-gamma |x - y|^2) up to an
    error that falls with the root of ``size``. W and b follow from the seed, so a saved stage holds four numbers."""

    size = Param(Params._dummy(), "size", "number of features", typeConverter=TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "factor of the squared distance", typeConverter=TypeConverters.toFloat)
    inputs = Param(Params._dummy(), "inputs", "length of the input vectors", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="kernel_features", inputs=1, gamma=1.0, size=SIZE, seed=42):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="kernel_features", size=SIZE, gamma=1.0, inputs=1, seed=42)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shape = [self.getOrDefault(p) for p in (self.inputs, self.size, self.gamma, self.seed)]

        @F.pandas_udf("array<double>")
        def mapped(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            w, b = directions(*shape)
            for batch in batches:
                x = np.stack(batch.to_numpy()) if len(batch) else np.zeros((0, shape[0]))
                yield pd.Series(list(np.sqrt(2 / shape[1]) * np.cos(x @ w.T + b)))

        return dataset.withColumn(self.getOutputCol(), array_to_vector(mapped(vector_to_array(self.getInputCol()))))


def scaled_gamma(df: DataFrame, column: str = "features") -> tuple[float, int]:
    """One over length times variance of all entries of the vectors, and the length; one pass, one row to the driver."""
    x = vector_to_array(column)
    total = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v)
    squares = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v * v)
    row = df.agg(F.count("*").alias("n"), F.max(F.size(x)).alias("size"), F.sum(total).alias("t"), F.sum(squares).alias("s")).first()
    size = row["size"] or 1
    cells = max(1, row["n"] * size)
    variance = (row["s"] or 0.0) / cells - ((row["t"] or 0.0) / cells) ** 2
    return 1 / (size * variance) if variance > 0 else 1.0, size
