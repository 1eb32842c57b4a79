"""Descriptive statistics, group aggregates and the numbers behind plots."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.columns import long_form, ref
from tabkit.functions.text import WORD_STRIP_CHARS, str_strip
from tabkit.operators.missing import modes
from tabkit.operators.quantiles import exact_quantiles

MEAN, SUM = F.avg, F.sum


def group_agg(df: DataFrame, keys: Sequence[str], cols: Sequence[str], fn=MEAN, prefix: str = "") -> DataFrame:
    """One aggregate of every named column per group."""
    return df.groupBy(*[ref(k) for k in keys]).agg(*[fn(ref(c)).alias(prefix + c) for c in cols])


def frequency(df: DataFrame, col: str) -> DataFrame:
    """Values with their counts, most frequent first, smaller value first on ties."""
    return df.groupBy(ref(col)).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), ref(col))


def word_count(df: DataFrame, text_col: str, strip_chars: str = WORD_STRIP_CHARS, min_count: int = 3) -> DataFrame:
    """Words with at least ``min_count`` occurrences. Lines are split on single spaces, punctuation is stripped
    at both ends, case is kept and the empty word counts like any other."""
    words = df.select(F.explode(F.split(ref(text_col), " ")).alias("word"))
    counts = words.select(str_strip(F.col("word"), strip_chars).alias("word")).groupBy("word")
    return counts.agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") >= min_count)


def count_distinct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    totals = df.agg(*[F.count_distinct(ref(c)).alias(f"d{i}") for i, c in enumerate(cols)])
    return long_form(totals, [{"column_name": F.lit(c), "distinct_values": F.col(f"d{i}")} for i, c in enumerate(cols)])


def _summary(df: DataFrame, cols: Sequence[str], fns: dict) -> DataFrame:
    """One row of f<i>_<name> totals."""
    return df.agg(*[fn(ref(c).cast("double")).alias(f"f{i}_{name}") for i, c in enumerate(cols) for name, fn in fns.items()])


def column_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean, median, sample deviation, mode, sample variance, largest and smallest value per column."""
    fns = {"mean": F.avg, "std_dev": F.stddev_samp, "variance": F.var_samp, "max": F.max, "min": F.min}
    medians, most = exact_quantiles(df, cols, [0.5]), modes(df, cols)
    rows = [{"column_name": F.lit(c), "median": F.lit(medians[c][0]).cast("double"),
             "mode": F.lit(most[c]).cast("double"), **{n: F.col(f"f{i}_{n}") for n in fns}} for i, c in enumerate(cols)]
    return long_form(_summary(df, cols, fns), rows)


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, smallest, quartiles, largest per column."""
    fns = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    rows = [{"column_name": F.lit(c), **{n: F.col(f"f{i}_{n}") for n in fns},
             **{n: F.lit(q).cast("double") for n, q in zip(("p25", "p50", "p75"), quartiles[c])}}
            for i, c in enumerate(cols)]
    return long_form(_summary(df, cols, fns), rows)


def skew_kurtosis(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Bias-corrected skewness and excess kurtosis."""
    fns = {"n": F.count, "skew": F.skewness, "kurt": F.kurtosis}
    rows = []
    for i, c in enumerate(cols):
        n, g1, g2 = (F.col(f"f{i}_{name}").cast("double") for name in fns)
        rows.append({
            "column_name": F.lit(c),
            "skewness": F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2)),
            "kurtosis": F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)),
        })
    return long_form(_summary(df, cols, fns), rows)


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair over the rows where both are present; one pass, half the pairs."""
    pairs = list(combinations(range(len(cols)), 2))

    def value(i: int) -> Column:
        return ref(cols[i]).cast("double")

    totals = df.agg(*[F.corr(value(i), value(j)).alias(f"r{i}_{j}") for i, j in pairs],
                    *[F.var_samp(value(i)).alias(f"v{i}") for i in range(len(cols))])
    rows = [{"column_x": F.lit(c), "column_y": F.lit(c), "corr": F.when(F.col(f"v{i}") > 0, F.lit(1.0))}
            for i, c in enumerate(cols)]
    for i, j in pairs:
        for a, b in ((i, j), (j, i)):
            rows.append({"column_x": F.lit(cols[a]), "column_y": F.lit(cols[b]), "corr": F.col(f"r{i}_{j}")})
    return long_form(totals, rows)


def boxplot_stats(df: DataFrame, cols: Sequence[str], reach: float = 1.5) -> DataFrame:
    """Quartiles, ends of the whiskers (last values within ``reach`` quartile ranges) and number of values beyond."""
    totals, rows = [], []
    for i, (c, (q1, q2, q3)) in enumerate(exact_quantiles(df, cols, [0.25, 0.5, 0.75]).items()):
        x = ref(c).cast("double")
        inside = F.lit(False) if q1 is None else x.between(q1 - reach * (q3 - q1), q3 + reach * (q3 - q1))
        totals += [F.min(F.when(inside, x)).alias(f"lo{i}"), F.max(F.when(inside, x)).alias(f"hi{i}"),
                   F.count_if(~inside).alias(f"out{i}")]
        quartiles = {n: F.lit(q).cast("double") for n, q in (("q1", q1), ("median", q2), ("q3", q3))}
        rows.append({"column_name": F.lit(c), **quartiles, "whisker_low": F.col(f"lo{i}"),
                     "whisker_high": F.col(f"hi{i}"), "outliers": F.col(f"out{i}")})
    return long_form(df.agg(*totals), rows)


def pair_bins(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """Counts on a bins x bins grid for every pair of columns, equal widths, the top edge in the last bin."""
    edges = df.agg(*[f(ref(c).cast("double")) for c in cols for f in (F.min, F.max)]).first()
    number = {}
    for i, c in enumerate(cols):
        lo, hi = edges[2 * i], edges[2 * i + 1]
        width = (hi - lo) / bins if lo is not None and hi > lo else 1.0
        number[c] = F.least(F.floor((ref(c).cast("double") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    cells = df.select(F.inline(F.array(*[
        F.struct(F.lit(x).alias("column_x"), F.lit(y).alias("column_y"), number[x].alias("bin_x"), number[y].alias("bin_y"))
        for x, y in combinations(cols, 2)])))
    present = cells.filter(F.col("bin_x").isNotNull() & F.col("bin_y").isNotNull())
    return present.groupBy("column_x", "column_y", "bin_x", "bin_y").agg(F.count(F.lit(1)).alias("count"))
