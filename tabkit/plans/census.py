"""Exploration of a census-like table: gaps, products, group means, outer join, and statistics of an age range."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from tabkit.columns import numeric_cols
from tabkit.operators import joins as J
from tabkit.operators import missing as M
from tabkit.operators import projection as P
from tabkit.operators import stats as S
from tabkit.operators import validity as V
from tabkit.operators.features import pairwise


def explore(raw: DataFrame, group: str, measure: str, rates: DataFrame, rate_key: str, between: tuple[str, float, float],
            exclude: Sequence[str] = ()) -> dict[str, Callable[[], DataFrame]]:
    """Makers of frames by name: ``missing``, ``averages``, ``joined`` and ``described``. Each runs only what it needs."""
    df = P.trim_strings(raw)
    complete = V.drop_null_rows(df)
    numbers = numeric_cols(complete, exclude)
    return {
        "missing": lambda: M.missing_counts(df),
        "averages": lambda: S.group_agg(complete, [group], [measure]),
        "joined": lambda: J.join_full_outer(pairwise(complete, numbers, with_self=True), rates, group, rate_key),
        "described": lambda: S.describe(P.filter_between(complete, *between), numbers),
    }
