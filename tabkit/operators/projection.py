"""Projections, casts, simple filters, row limits and unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.columns import ref, replace_columns, string_cols


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[ref(c) for c in cols])


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep every column that is not named; names are taken literally, brackets and dots included."""
    gone = set(cols)
    return project(df, [c for c in df.columns if c not in gone])


def cast_all(df: DataFrame, cols: Sequence[str], to: str) -> DataFrame:
    """Cast many columns in one projection; what cannot be cast becomes NULL."""
    return replace_columns(df, {c: ref(c).try_cast(to) for c in cols})


def trim_strings(df: DataFrame) -> DataFrame:
    return replace_columns(df, {c: F.trim(ref(c)) for c in string_cols(df)})


def filter_between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    return df.filter(ref(col).between(lo, hi))


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(ref(col) == F.lit(value))


def case_replace(df: DataFrame, col: str, rules: Sequence[tuple[Column, object]]) -> DataFrame:
    """First rule whose condition holds gives the new value, other rows keep theirs."""
    new = None
    for condition, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        new = F.when(condition, value) if new is None else new.when(condition, value)
    return df.withColumn(col, new.otherwise(ref(col)))


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def union_all(*frames: DataFrame) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def spread(df: DataFrame, parts: int, *keys: str) -> DataFrame:
    """Spread rows over a number of partitions, by key when keys are given."""
    return df.repartition(parts, *keys)
