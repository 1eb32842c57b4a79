"""Feature stages for Spark ML, with parameters that can be saved and loaded."""

from __future__ import annotations

from itertools import combinations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from tabkit.columns import ref
from tabkit.functions.numbers import product, square


class PairwiseProduct(Transformer, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Products of all pairs of the input columns, by default named ``<a>_<b>``."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols, outputCols=outputCols or [f"{a}_{b}" for a, b in combinations(inputCols, 2)])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        pairs = combinations(self.getInputCols(), 2)
        return dataset.select("*", *[product(ref(a), ref(b)).alias(out) for (a, b), out in zip(pairs, self.getOutputCols(), strict=True)])


class Square(Transformer, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Squares of the input columns, by default named ``<a>_square``."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols, outputCols=outputCols or [f"{a}_square" for a in inputCols])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.select("*", *[square(ref(a)).alias(out) for a, out in zip(self.getInputCols(), self.getOutputCols(), strict=True)])
