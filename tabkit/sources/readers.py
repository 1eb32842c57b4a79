"""Readers. Missing values are NULL only: readers of text turn NaN and the word "nan" into NULL, writers write no NaN.

Columnar sources are read as they are, so filters reach the files; ``nan=True`` converts tables that others wrote."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tabkit.operators.missing import nan_to_null

Schema = T.StructType | str


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: Schema | None = None,
             header: bool = True, **options) -> DataFrame:
    """CSV files. Give a schema for large inputs: inference reads the files one more time."""
    reader = spark.read.options(header=header, **options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return nan_to_null(reader.csv(path), text=True)


def read_jsonl(spark: SparkSession, path: str | Sequence[str], schema: Schema | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return nan_to_null(reader.json(path), text=True)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: Schema | None = None) -> DataFrame:
    reader = spark.read.format("xml").option("rowTag", row_tag)
    reader = reader.schema(schema) if schema is not None else reader
    return nan_to_null(reader.load(path), text=True)


def read_parquet(spark: SparkSession, path: str | Sequence[str], nan: bool = False) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.parquet(*paths)
    return nan_to_null(df) if nan else df


def read_text(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def read_table(spark: SparkSession, name: str, nan: bool = False) -> DataFrame:
    return nan_to_null(spark.table(name)) if nan else spark.table(name)


def read_jdbc(spark: SparkSession, url: str, table: str, partition: tuple[str, int, int, int] | None = None,
              nan: bool = False, **options) -> DataFrame:
    """Database table. ``partition`` = (column, lower, upper, parts) splits the read over executors."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition is not None:
        column, lower, upper, parts = partition
        reader = reader.options(partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts)
    df = reader.load()
    return nan_to_null(df) if nan else df


def read_mixed(spark: SparkSession, paths: dict[str, str], schema: T.StructType, row_tag: str = "row") -> DataFrame:
    """CSV, JSON-lines and XML folders appended; ``source_rank`` keeps the order in which they were named."""
    readers = {
        "csv": lambda p: read_csv(spark, p, schema),
        "json": lambda p: read_jsonl(spark, p, schema),
        "xml": lambda p: read_xml(spark, p, row_tag, schema),
    }
    parts = [readers[fmt](path).withColumn("source_rank", F.lit(rank))
             for rank, (fmt, path) in enumerate(paths.items())]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def inline(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """Small literal table, for example published rates. Handed over as Arrow data, so that its size is known to
    the planner."""
    wanted = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [()] * len(wanted)
    arrays = [pa.array(list(values), to_arrow_type(field.dataType)) for values, field in zip(columns, wanted.fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=wanted.names), wanted)
