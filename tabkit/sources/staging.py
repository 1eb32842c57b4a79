"""One step of a staged flow: tables in, tables out, metrics back to the caller."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.columns import long_form
from tabkit.runtime import table_path
from tabkit.sources.readers import read_table
from tabkit.sources.writers import write_parquet

Step = Callable[[dict[str, DataFrame]], tuple[dict[str, DataFrame], dict]]


def run_step(spark: SparkSession, fn: Step, inputs: Sequence[str], outputs: Sequence[str],
             drop: Sequence[str] = ()) -> dict:
    """Load the input tables, call ``fn``, write its result tables, drop ``drop``, return its metrics.

    Each output goes to a fresh folder and the name is switched to it afterwards, so a step may replace
    a table it reads, and a failed step leaves the old table whole.
    """
    results, metrics = fn({name: read_table(spark, name) for name in inputs})
    if set(results) != set(outputs):
        raise ValueError(f"step returned {sorted(results)}, expected {sorted(outputs)}")
    _switch(spark, {name: write_parquet(df, table_path(spark, name)) for name, df in results.items()})
    for name in set(drop) - set(outputs):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return metrics


def _switch(spark: SparkSession, written: dict[str, str]) -> None:
    """Let table names point to folders that are written in full. A table with the same columns is moved, so its name never goes;
    tables that must change together belong into a ``Publication``."""
    for name, path in written.items():
        if spark.catalog.tableExists(name) and spark.table(name).schema == spark.read.parquet(path).schema:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            spark.catalog.refreshTable(name)
            continue
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=path, source="parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder, let the name point to it, and read it back; a failed write leaves the old table."""
    _switch(df.sparkSession, {name: write_parquet(df, table_path(df.sparkSession, name))})
    return read_table(df.sparkSession, name)


def table_shape(df: DataFrame) -> DataFrame:
    """Row count, position, name and type of every column."""
    fields = [{"position": F.lit(i), "column_name": F.lit(f.name), "data_type": F.lit(f.dataType.simpleString()),
               "row_count": F.col("row_count")} for i, f in enumerate(df.schema.fields)]
    return long_form(df.agg(F.count(F.lit(1)).alias("row_count")), fields)

