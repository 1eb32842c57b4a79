"""Missing values: counting and filling. Inside the engine missing means NULL and nothing else."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Imputer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.columns import float_cols, long_form, ref, replace_columns, string_cols
from tabkit.functions.draws import bernoulli_by_key
from tabkit.operators.features import string_index_frequency
from tabkit.operators.frequent import most_frequent
from tabkit.operators.joins import bands_overlap, join_band


def nan_to_null(df: DataFrame, text: bool = False) -> DataFrame:
    """Float NaN becomes NULL; with ``text`` also the word "nan" in text columns."""
    changes = {c: F.when(~F.isnan(ref(c)), ref(c)) for c in float_cols(df)}
    if text:
        changes |= {c: F.when(F.lower(F.trim(ref(c))) != "nan", ref(c)) for c in string_cols(df)}
    return replace_columns(df, changes)


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN where the type has one."""
    c = ref(name)
    floating = isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))
    return (c.isNull() | F.isnan(c)) if floating else c.isNull()


def missing_counts(df: DataFrame) -> DataFrame:
    """One row per column with its number of missing cells, in a single pass."""
    totals = df.agg(*[F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)])
    return long_form(totals, [{"column_name": F.lit(c), "missing": F.col(f"m{i}")} for i, c in enumerate(df.columns)])


def null_review(df: DataFrame) -> DataFrame:
    """Names of the columns with missing cells, and the number of rows that hold any."""
    flags = {c: is_missing(df, c) for c in df.columns}
    totals = df.agg(F.count_if(reduce(Column.__or__, flags.values())).alias("rows_with_null"),
                    *[F.count_if(flag).alias(f"m{i}") for i, flag in enumerate(flags.values())])
    names = F.array_compact(F.array(*[F.when(F.col(f"m{i}") > 0, F.lit(c)) for i, c in enumerate(df.columns)]))
    return totals.select(F.array_join(names, ",").alias("columns_with_null"), "rows_with_null")


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, object]:
    """Most frequent non-NULL value of each column, the smallest on ties."""
    return {c: None for c in cols} | {c: value for c, (value, _) in most_frequent(df, cols).items()}


def means(df: DataFrame, exprs: dict[str, Column]) -> dict[str, float | None]:
    """Mean of several expressions in one pass."""
    row = df.agg(*[F.avg(e) for e in exprs.values()]).first()
    return dict(zip(exprs, row))


def impute_constant(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Fill NULL with a given value; the column becomes as wide as needed to hold it."""
    return replace_columns(df, {c: F.coalesce(ref(c), F.lit(v)) for c, v in values.items() if v is not None})


def impute_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return impute_constant(df, modes(df, cols))


def impute_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return impute_constant(df, means(df, {c: ref(c) for c in cols}))


def clamp_flag(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Flags: values above 1 and NULL become 0."""
    return replace_columns(df, {c: F.when(ref(c) > 1, F.lit(0)).otherwise(F.coalesce(ref(c), F.lit(0))) for c in cols})


def replace_out_of_range(df: DataFrame, col: str, outside: Column, with_: str | float) -> DataFrame:
    """Replace values for which ``outside`` holds, then fill NULL.

    ``with_`` is a constant, "mode" or "mean". The replacement is the statistic of the untouched column, the
    fill that of the changed one. With a constant, NULL is filled with the mean of the changed column.
    """
    if with_ == "mode":
        changed = df.withColumn(col, F.when(outside, F.lit(modes(df, [col])[col])).otherwise(ref(col)))
        return impute_mode(changed, [col])
    value = means(df, {col: ref(col)})[col] if with_ == "mean" else with_
    changed = df.withColumn(col, F.when(outside, F.lit(value)).otherwise(ref(col)))
    return impute_mean(changed, [col])


def ml_imputer(cols: Sequence[str], strategy: str = "mean", prefix: str = "Imputed") -> Imputer:
    """Estimator stage writing ``<prefix><column>``."""
    return Imputer(inputCols=list(cols), outputCols=[prefix + c for c in cols], strategy=strategy)


def impute_category(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Index text columns by falling frequency, as ``<column>Index``, and fill the index of unknown values with the most
    frequent one, as ``Imputed<column>Index``."""
    out = string_index_frequency(df, cols)
    return out.select("*", *[F.when(ref(c).isNull(), F.lit(0.0)).otherwise(ref(f"{c}Index")).alias(f"Imputed{c}Index") for c in cols])


def impute_by_rate(df: DataFrame, target: str, key: str, value: str, group: str,
                   bands: DataFrame, group_bands: DataFrame) -> DataFrame:
    """Fill a NULL flag by two independent draws against published rates; 1 if either draw says so.

    ``bands`` (lo, hi, prob) is looked up by ``value``; ``group_bands`` (grp, lo, hi, prob) by ``group`` and
    ``value``. Bands that overlap are refused, since a row would come back twice. Rows outside all bands stay, with
    probability 0. Columns of the input are kept, whatever their names.
    """
    if bands_overlap(bands) or bands_overlap(group_bands, "grp"):
        raise ValueError("rates overlap")
    first = bands.select(F.col("lo").alias("_lo1"), F.col("hi").alias("_hi1"), F.col("prob").alias("_p1"))
    second = group_bands.select(F.col("grp").alias("_grp2"), F.col("lo").alias("_lo2"), F.col("hi").alias("_hi2"), F.col("prob").alias("_p2"))
    joined = join_band(df, first, value, lo="_lo1", hi="_hi1").drop("_lo1", "_hi1")
    joined = join_band(joined, second, value, eq=(group, "_grp2"), lo="_lo2", hi="_hi2").drop("_lo2", "_hi2", "_grp2")
    drawn = F.greatest(bernoulli_by_key(ref(key), F.col("_p1"), "first"),
                       bernoulli_by_key(ref(key), F.col("_p2"), "second"))
    return joined.withColumn(target, F.coalesce(ref(target), drawn)).drop("_p1", "_p2")
