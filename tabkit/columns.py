"""Column references and column roles derived from a schema."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
FLOAT_TYPES = (T.FloatType, T.DoubleType)


def ref(name: str) -> Column:
    """Column by its exact name, also when it holds dots or brackets."""
    return F.col("`" + name.replace("`", "``") + "`")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once. Spark computes what a lambda names from outside anew for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def columns_of(df: DataFrame, kinds, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in skip]


def numeric_cols(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    return columns_of(df, NUMERIC_TYPES, exclude)


def float_cols(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    return columns_of(df, FLOAT_TYPES, exclude)


def string_cols(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    return columns_of(df, T.StringType, exclude)


def replace_columns(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    """Replace or add columns in one projection, keeping the column order."""
    return df.withColumns(changes) if changes else df


def long_form(df: DataFrame, rows: list[dict[str, Column]]) -> DataFrame:
    """Turn a one-row frame into several rows; every dict is one row of named expressions."""
    structs = [F.struct(*[e.alias(n) for n, e in row.items()]) for row in rows]
    return df.select(F.inline(F.array(*structs)))
