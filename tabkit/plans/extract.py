"""Price lists in three formats: extract, round, keep one row per model, store, read back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.columns import ref, replace_columns
from tabkit.operators.validity import dedup_first
from tabkit.runtime import scratch_path
from tabkit.sources.readers import read_mixed, read_parquet
from tabkit.sources.writers import write_parquet


def run(spark: SparkSession, paths: dict[str, str], schema: T.StructType, model: str, price: str, order: Sequence[str],
        digits: int = 2, row_tag: str = "row") -> DataFrame:
    """The stored list: prices rounded, of each model the first row in order of the sources as named, then of ``order``."""
    rows = read_mixed(spark, paths, schema, row_tag)
    rounded = replace_columns(rows, {price: F.round(ref(price), digits)})
    kept = dedup_first(rounded, [model], ["source_rank", *order])
    return read_parquet(spark, write_parquet(kept, scratch_path(spark, "extract")))
