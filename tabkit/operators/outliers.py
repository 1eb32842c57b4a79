"""Outlier removal. A row with NULL in a tested column is removed with the outliers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.columns import ref


def _limits(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and sample deviation of all columns in one pass."""
    row = df.agg(*[f(ref(c).cast("double")) for c in cols for f in (F.avg, F.stddev_samp)]).first()
    return {c: (row[2 * i], row[2 * i + 1]) for i, c in enumerate(cols)}


def _within(col: str, mean: float | None, std: float | None, width: float, strict: bool = False) -> Column | None:
    """Range test, written as bounds on the plain column so that it reaches the file scan.

    A column without spread has no outliers and gives no test.
    """
    if not std:
        return None
    lo, hi = mean - width * std, mean + width * std
    return (ref(col) > lo) & (ref(col) < hi) if strict else ref(col).between(lo, hi)


def _sequential(df: DataFrame, cols: Sequence[str], width: float, strict: bool) -> DataFrame:
    for c in cols:
        mean, std = _limits(df, [c])[c]
        test = _within(c, mean, std, width, strict)
        df = df if test is None else df.filter(test)
    return df


def outliers_sequential(df: DataFrame, cols: Sequence[str], k: float = 3.0) -> DataFrame:
    """Column after column: keep rows within k deviations of the mean of the rows still there.

    One pass per column by definition. Each pass adds one plain range test with known bounds, so no
    intermediate result is kept; persist or stage ``df`` first when it is costly to compute.
    """
    return _sequential(df, cols, k, strict=False)


def outliers_zscore(df: DataFrame, cols: Sequence[str], k: float = 3.0, tol: float = 0.01) -> DataFrame:
    """The same with the bound abs(z) - k < tol."""
    return _sequential(df, cols, k + tol, strict=True)


def without_spread(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """The columns whose values are all alike, so that no value is an outlier; the filters leave these columns out."""
    return [c for c, (_, std) in _limits(df, cols).items() if not std]


def outliers_onepass(df: DataFrame, cols: Sequence[str], k: float = 3.0) -> DataFrame:
    """All bounds from the untouched data: one aggregate and one filter."""
    tests = [_within(c, *limits, k) for c, limits in _limits(df, cols).items()]
    tests = [t for t in tests if t is not None]
    return df.filter(reduce(Column.__and__, tests)) if tests else df
