"""Encoders that are fitted on training rows and applied to others, as stages of a Spark ML pipeline.

What a category indexer learns is a table of values with their indexes. It stays a table: counted and numbered on the executors, stored
in the shared folder, and applied by a join, so the number of values is not bounded by the driver. Fitted models
are saved with their table and can be loaded in another session.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.columns import NUMERIC_TYPES, ref, replace_columns
from tabkit.operators.features import _numbered
from tabkit.operators.missing import means, modes
from tabkit.runtime import settle

KNOWN = "tabkit_known"  # metadata of an index column: how many values were known, which is also the index of unknown ones
ORDERS = ("frequency", "value")


def known_values(df: DataFrame, col: str) -> int:
    """Number of values that the indexer of a column knew."""
    metadata = df.schema[col].metadata
    if KNOWN not in metadata:
        raise ValueError(f"{col} was not written by CategoryIndexer; name its sentinel")
    return metadata[KNOWN]


class _IndexerParams(HasInputCols, HasOutputCols):
    order = Param(Params._dummy(), "order", "frequency (falling, ties by value) or value (ascending)", TypeConverters.toString)
    unknown = Param(Params._dummy(), "unknown", "keep: unknown values and NULL get the number of known values; null: they stay NULL", TypeConverters.toString)


class CategoryIndexer(Estimator, _IndexerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Index (double) of every value of the input columns, by default named ``<column>Index``, as learnt from the rows at hand.

    All columns are counted in one pass, one row per column and value.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, order="frequency", unknown="keep"):
        super().__init__()
        if order not in ORDERS or unknown not in ("keep", "null"):
            raise ValueError(f"order is one of {ORDERS}, unknown is keep or null")
        self._set(order=order, unknown=unknown)
        if inputCols is not None:
            self._set(inputCols=inputCols, outputCols=outputCols or [f"{c}Index" for c in inputCols])

    def _fit(self, dataset: DataFrame) -> CategoryIndexerModel:
        cols = self.getInputCols()
        numeric = {f.name for f in dataset.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)}
        cells = dataset.select(F.inline(F.array(*[F.struct(
            F.lit(i).alias("_column"), (ref(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("_number"), ref(c).cast("string").alias("_value"))
            for i, c in enumerate(cols)])))
        counts = cells.where("_value IS NOT NULL").groupBy("_column", "_number", "_value").agg((-F.count(F.lit(1))).alias("_often"))
        order = ["_column", "_often", "_value"] if self.getOrDefault("order") == "frequency" else ["_column", "_number", "_value"]
        codes = settle(_numbered(counts, order).select("_column", "_value", "_code"), "codes")
        found = {row["_column"]: (row["first"], row["n"]) for row in
                 codes.groupBy("_column").agg(F.min("_code").alias("first"), F.count(F.lit(1)).alias("n")).collect()}  # one row per column
        starts = F.array(*[F.lit(found.get(i, (0, 0))[0]).cast("bigint") for i in range(len(cols))])
        table = codes.select("_column", "_value", (F.col("_code") - F.get(starts, F.col("_column"))).cast("double").alias("_index"))
        return self._copyValues(CategoryIndexerModel(table, [found.get(i, (0, 0))[1] for i in range(len(cols))]))


class CategoryIndexerModel(Model, _IndexerParams, MLReadable, MLWritable):
    """Indexes of known values; ``table`` holds _column (its place among the input columns), _value and _index, ``sizes`` the known values per column."""

    def __init__(self, table: DataFrame | None = None, sizes: Sequence[int] = ()):
        super().__init__()
        self.table, self.sizes = table, list(sizes)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        value, index, keep = f"_{self.uid}_value", f"_{self.uid}_index", self.getOrDefault("unknown") == "keep"
        for i, (c, out) in enumerate(zip(self.getInputCols(), self.getOutputCols(), strict=True)):
            codes = self.table.where(F.col("_column") == i).select(F.col("_value").alias(value), F.col("_index").alias(index))
            joined = dataset.join(codes, ref(c).cast("string") == F.col(value), "left")
            found = F.coalesce(index, F.lit(float(self.sizes[i]))) if keep else F.col(index)
            kept = [ref(x) for x in dataset.columns if x != out]
            dataset = joined.select(*kept, found.alias(out, metadata={KNOWN: self.sizes[i]}))
        return dataset

    def write(self) -> MLWriter:
        return _IndexerWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _IndexerReader(cls)


class _IndexerWriter(MLWriter):
    def __init__(self, instance: CategoryIndexerModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata={"sizes": self.instance.sizes})
        self.instance.table.write.parquet(f"{path}/table")


class _IndexerReader(MLReader):
    def __init__(self, kind: type[CategoryIndexerModel]):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> CategoryIndexerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.kind(self.sparkSession.read.schema("_column int, _value string, _index double").parquet(f"{path}/table"), metadata["sizes"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class _ImputerParams(HasInputCols, HasOutputCols):
    sentinels = Param(Params._dummy(), "sentinels", "value of each column that stands for a missing one", TypeConverters.toListFloat)


class SentinelImputer(Estimator, _ImputerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fill NULL and a sentinel with the mode or mean of the other values, as ``Imputed<column>``.

    Without ``sentinels`` the input columns are those of a ``CategoryIndexer`` and the sentinel is its index of unknown
    values, which is not known before the indexer is fitted. A column with no other value keeps its own.
    """

    strategy = Param(Params._dummy(), "strategy", "mode (the smallest on ties) or mean", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, sentinels=None, strategy="mode"):
        super().__init__()
        if strategy not in ("mode", "mean"):
            raise ValueError("strategy is mode or mean")
        self._set(strategy=strategy)
        if inputCols is not None:
            self._set(inputCols=inputCols, outputCols=outputCols or [f"Imputed{c}" for c in inputCols])
        if sentinels is not None:
            self._set(sentinels=sentinels)

    def _fit(self, dataset: DataFrame) -> SentinelImputerModel:
        cols = self.getInputCols()
        sentinels = self.getOrDefault("sentinels") if self.isDefined("sentinels") else [float(known_values(dataset, c)) for c in cols]
        seen = replace_columns(dataset, {c: F.when(ref(c).cast("double") != s, ref(c).cast("double")) for c, s in zip(cols, sentinels, strict=True)})
        fills = modes(seen, cols) if self.getOrDefault("strategy") == "mode" else means(seen, {c: ref(c) for c in cols})
        model = SentinelImputerModel()
        model._set(inputCols=cols, outputCols=self.getOutputCols(), sentinels=sentinels,
                   fills=[s if fills[c] is None else float(fills[c]) for c, s in zip(cols, sentinels)])
        return self._copyValues(model)


class SentinelImputerModel(Model, _ImputerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Values learnt for every column."""

    fills = Param(Params._dummy(), "fills", "value that replaces the sentinel and NULL in each column", TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        filled = {}
        for c, out, sentinel, fill in zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault("sentinels"), self.getOrDefault("fills"), strict=True):
            filled[out] = F.when(ref(c).cast("double") != sentinel, ref(c).cast("double")).otherwise(F.lit(fill))
        return replace_columns(dataset, filled)
