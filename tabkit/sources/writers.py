"""Writers. Every one writes a folder of part files in parallel; columnar ones write NULL for NaN."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from tabkit.columns import ref
from tabkit.operators.missing import nan_to_null


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    nan_to_null(df).write.mode(mode).parquet(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", header).csv(path)
    return path


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path


def write_xml(df: DataFrame, path: str, row_tag: str = "row", mode: str = "overwrite") -> str:
    df.write.mode(mode).format("xml").options(rootTag="root", rowTag=row_tag).save(path)
    return path


def write_text(df: DataFrame, line: Column, path: str, mode: str = "overwrite") -> str:
    """One formatted line per row."""
    df.select(line.alias("value")).write.mode(mode).text(path)
    return path


def write_table(df: DataFrame, name: str, path: str) -> str:
    """Replace a catalog table whose files live at ``path``."""
    nan_to_null(df).write.mode("overwrite").option("path", path).saveAsTable(name)
    return name


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int, sort: bool = True) -> str:
    """Replace a catalog table by one whose rows lie in ``buckets`` files by a hash of the keys, each sorted by them.

    Tables with equal keys and as many buckets are joined, and grouped by these keys, without moving a row. Choose the number by the size of
    the largest table, some hundred MB a bucket: it is fixed with the files. A key with very many rows makes its bucket as large.
    """
    if buckets < 1:
        raise ValueError("there is at least one bucket")
    dealt = nan_to_null(df).repartition(buckets, *[ref(k) for k in keys])  # the same hash, so each task writes one file
    writer = dealt.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *keys)
    (writer.sortBy(*keys) if sort else writer).saveAsTable(name)
    return name


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", **options) -> str:
    nan_to_null(df).write.mode(mode).format("jdbc").options(url=url, dbtable=table, **options).save()
    return table
