"""Exact quantiles of whole columns without bringing a column into one task."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from itertools import islice

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabkit.columns import ref

ACCURACY = 10_000  # a sketch quantile is at most 1/ACCURACY of the rows away from the exact one
SORTED_AT_ONCE = 2_000_000  # rows of a bracket that are counted value by value


Target = tuple[str, float]  # column and probability


def _brackets(df: DataFrame, ranks: dict[Target, tuple[int, int]], counts: dict[str, int]) -> dict[Target, tuple[float, float, int]]:
    """For every target a range [lo, hi] that holds both of its ranks, and the number of values below it.

    Sketches with a bounded error narrow the ranges until one can be sorted at once; each round is one pass for
    the sketches and one to count, and shrinks a range about ACCURACY / 4 times.
    """
    found = {t: (-math.inf, math.inf, 0) for t in ranks}
    inside = {t: counts[t[0]] for t in ranks}
    while wide := [t for t in ranks if inside[t] > SORTED_AT_ONCE and found[t][0] < found[t][1]]:
        probs: dict[tuple, list[float]] = {}
        for t in wide:
            lo, hi, below = found[t]
            low, high = ((r - below) / inside[t] for r in ranks[t])
            probs.setdefault((t[0], lo, hi), []).extend([max(low - 2 / ACCURACY, 0.0), min(high + 2 / ACCURACY, 1.0)])
        sketches = df.agg(*[F.percentile_approx(_inside(_value(c), lo, hi), ps, ACCURACY) for (c, lo, hi), ps in probs.items()]).first()
        ends = {source: iter(values) for source, values in zip(probs, sketches)}
        narrowed = {t: tuple(islice(ends[t[0], *found[t][:2]], 2)) for t in wide}
        sizes = df.agg(*[f for t, (lo, hi) in narrowed.items()
                         for f in (F.count_if(_value(t[0]) < lo), F.count_if(_value(t[0]).between(lo, hi)))]).first()
        stuck = True
        for i, (t, (lo, hi)) in enumerate(narrowed.items()):
            stuck &= sizes[2 * i + 1] == inside[t]
            found[t], inside[t] = (lo, hi, sizes[2 * i]), sizes[2 * i + 1]
        if stuck:  # what is left are copies of few values
            break
    return found


def _order_statistics(df: DataFrame, ranks: dict[Target, tuple[int, int]], counts: dict[str, int]) -> dict[Target, tuple[float, float]]:
    """Values at the two 0-based ranks of every target: the rows inside the brackets are counted by value."""
    brackets = _brackets(df, ranks, counts)
    distinct = sorted({(t[0], *bracket) for t, bracket in brackets.items()})
    cells = F.array(*[F.struct(F.lit(i).alias("i"), _inside(_value(c), lo, hi).alias("v"))
                      for i, (c, lo, hi, _) in enumerate(distinct)])
    by_value = (df.select(F.inline(cells)).filter(F.col("v").isNotNull())
                .groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")))
    upto = by_value.withColumn("upto", F.sum("n").over(W.partitionBy("i").orderBy("v")))
    number = {t: distinct.index((t[0], *bracket)) for t, bracket in brackets.items()}
    places = {(number[t], r - brackets[t][2]) for t, pair in ranks.items() for r in pair}
    tests = [(F.col("i") == i) & (F.col("upto") > at) & (F.col("upto") - F.col("n") <= at) for i, at in places]
    rows = upto.filter(reduce(Column.__or__, tests)).collect()

    def value(t, r):
        at = r - brackets[t][2]
        return next(row["v"] for row in rows if row["i"] == number[t] and row["upto"] - row["n"] <= at < row["upto"])

    return {t: (value(t, r0), value(t, r1)) for t, (r0, r1) in ranks.items()}


def _value(c: str) -> Column:
    return ref(c).cast("double")


def _inside(x: Column, lo: float, hi: float) -> Column:
    return x if math.isinf(lo) and math.isinf(hi) else F.when(x.between(lo, hi), x)


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Quantiles of the non-NULL values of each column, linear between neighbours."""
    row = df.agg(*[F.count(ref(c)) for c in cols]).first()
    counts = {c: n for c, n in zip(cols, row) if n}
    at = {(c, p): p * (n - 1) for c, n in counts.items() for p in probs}
    values = _order_statistics(df, {t: (math.floor(h), math.ceil(h)) for t, h in at.items()}, counts) if at else {}

    def quantile(t):
        if t not in values:
            return None
        lo, hi = values[t]
        return lo + (hi - lo) * (at[t] - math.floor(at[t]))

    return {c: [quantile((c, p)) for p in probs] for c in cols}
