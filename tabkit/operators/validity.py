"""Which rows and columns are fit for use."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.columns import ref
from tabkit.operators.projection import project

# An unsigned number with at most one dot.
PLAIN_NUMBER = r"^([0-9]+\.?[0-9]*|\.[0-9]+)\z"

# Any text that reads as a number: padding, sign, exponent, digit groups, infinity and nan.
DIGITS = r"[0-9]++(?:_[0-9]++)*+"
READABLE_NUMBER = (
    r"^\s*+[+-]?(?:(?:" + DIGITS + r"(?:\.(?:" + DIGITS + r")?)?|\." + DIGITS + r")(?:[eE][+-]?" + DIGITS + r")?"
    r"|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*+\z"
)


def _all_text_matches(df: DataFrame, cols: Sequence[str], pattern: str) -> DataFrame:
    text = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
    if not text:
        return df
    return df.filter(reduce(Column.__and__, [ref(c).isNull() | ref(c).rlike(pattern) for c in text]))


def valid_rows_pattern(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Strict form: every text cell is digits with at most one dot, or NULL. Negatives and exponents fail."""
    return _all_text_matches(df, cols or df.columns, PLAIN_NUMBER)


def valid_rows_parse(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Lenient form: every text cell reads as a number, or is NULL."""
    return _all_text_matches(df, cols or df.columns, READABLE_NUMBER)


def drop_null_rows(df: DataFrame) -> DataFrame:
    return drop_null_subset(df, df.columns)


def drop_null_subset(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.filter(reduce(Column.__and__, [ref(c).isNotNull() for c in cols]))


def drop_rows_thresh(df: DataFrame, min_non_null: float, cols: Sequence[str] | None = None) -> DataFrame:
    """Keep rows with at least this many non-NULL cells; a fractional bound is rounded up.

    ``settle`` a frame first when many of these columns were just computed: the optimizer restates a condition over
    n columns for every combination of them with their new definitions.
    """
    cols = cols or df.columns
    present = reduce(Column.__add__, [ref(c).isNotNull().cast("int") for c in cols])
    return df.filter(present >= math.ceil(min_non_null))


def _present_counts(df: DataFrame) -> tuple[int, dict[str, int]]:
    row = df.agg(F.count(F.lit(1)), *[F.count(ref(c)) for c in df.columns]).first()
    return row[0], dict(zip(df.columns, row[1:]))


def drop_sparse_columns(df: DataFrame, min_fraction: float = 0.9) -> DataFrame:
    """Keep columns whose share of non-NULL cells reaches the bound; one pass over the data."""
    total, present = _present_counts(df)
    return project(df, [c for c in df.columns if present[c] >= total * min_fraction])


def drop_empty_columns(df: DataFrame) -> DataFrame:
    _, present = _present_counts(df)
    return project(df, [c for c in df.columns if present[c] > 0])


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in the stated order.

    Spark keeps the first row per key of every task before it shuffles, so a key that holds most of the rows
    costs no more than any other.
    """
    place = F.row_number().over(W.partitionBy(*[ref(k) for k in keys]).orderBy(*[ref(c) for c in order]))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")
