"""A map under which inner products approach a radial kernel, so that a linear machine draws curved borders."""

from __future__ import annotations

import math

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F


class FourierMap(Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Random Fourier features of the kernel ``exp(-gamma |x - y|^2)``.

    Feature i of x is ``sqrt(2 / n) cos(w_i x + b_i)`` with normal w of variance 2 gamma and uniform b, drawn from ``seed``. The inner
    product of two rows has the kernel's value as its mean and at most 1 / sqrt(n) as its deviation. The draws follow from the
    parameters, so a stored pipeline maps as before. Built-in expressions only.
    """

    width = Param(Params._dummy(), "width", "length of the input vectors", TypeConverters.toInt)
    features = Param(Params._dummy(), "features", "number of features", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "inverse squared length of the kernel", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, width=None, features=256, gamma=1.0, seed=42):
        super().__init__()
        self._setDefault(features=256, gamma=1.0, seed=42)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def draws(self) -> tuple[np.ndarray, np.ndarray]:
        """w (features x width) and b."""
        n, width, gamma = (self.getOrDefault(p) for p in ("features", "width", "gamma"))
        random = np.random.default_rng(self.getSeed())
        return random.normal(0, math.sqrt(2 * gamma), (n, width)), random.uniform(0, 2 * math.pi, n)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        w, b = self.draws()
        turns = F.lit([[*map(float, row), float(last)] for row, last in zip(w, b)])
        x = F.concat(vector_to_array(self.getInputCol()), F.array(F.lit(1.0)))
        scale = math.sqrt(2 / len(b))
        one = lambda t, x: F.cos(F.aggregate(F.zip_with(t, x, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)) * scale
        # the row becomes a variable, so that it is unpacked once, not for every feature
        return dataset.withColumn(self.getOutputCol(), array_to_vector(F.transform(F.array(x), lambda x: F.transform(turns, lambda t: one(t, x)))[0]))
