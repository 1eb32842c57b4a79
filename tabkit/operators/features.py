"""Encodings, scaling and pairwise features."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, combinations_with_replacement

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabkit.columns import long_form, ref, replace_columns
from tabkit.functions.numbers import product, row_max, square
from tabkit.runtime import settle

MOST_DUMMIES = 10_000  # one column per value; for more values use one_hot_sparse or raise ``most``


def one_hot(df: DataFrame, col: str, values: Sequence | None = None, most: int = MOST_DUMMIES) -> DataFrame:
    """0/1 column ``<col>_<value>`` per value, source column dropped, NULL gives all 0. More than ``most`` values are refused."""
    if values is None:
        found = df.select(ref(col)).where(ref(col).isNotNull()).distinct().limit(most + 1).collect()
        if len(found) > most:
            raise ValueError(f"{col} has more than {most} values; use one_hot_sparse")
        values = sorted(row[0] for row in found)
    dummies = [F.coalesce((ref(col) == v).cast("int"), F.lit(0)).alias(f"{col}_{v}") for v in values]
    return df.select(*[ref(c) for c in df.columns if c != col], *dummies)


def one_hot_sparse(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """One sparse vector column, by default ``<col>_vector``, with a 1 at the code of the value in sorted order, for any
    number of values; NULL gives all 0."""
    code, position = f"{col}_position", f"_{col}_position"
    coded = label_encode(df, [col], "_position")
    size = coded.agg(F.max(ref(code))).first()[0]
    size = 0 if size is None else int(size) + 1
    # NULL gets one code beyond the last, which is the one that the encoder leaves out
    filled = coded.withColumn(position, F.coalesce(ref(code).cast("double"), F.lit(float(size)))).drop(code)
    fitted = df.sparkSession.range(size + 1).select(F.col("id").cast("double").alias(position))
    encoder = OneHotEncoder(inputCol=position, outputCol=out or f"{col}_vector", dropLast=True).fit(fitted.agg(F.max(position).alias(position)))
    return encoder.transform(filled).drop(position)


def _numbered(values: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows with ``_code``, their position in the given order, from 0.

    Rows are range-partitioned and numbered inside each range; the ranges are numbered by their sizes. They are
    stored in between, because a range computed anew could begin elsewhere.
    """
    keys = [ref(c) for c in order]
    ranged = settle(values.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.withColumn("_start", F.sum("_n").over(W.orderBy("_range")) - F.col("_n")).drop("_n")
    inside = F.row_number().over(W.partitionBy("_range").orderBy(*keys)) - 1
    return ranged.withColumn("_inside", inside).join(starts, "_range").withColumn("_code", F.col("_start") + F.col("_inside")).drop("_range", "_inside", "_start")


def label_encode(df: DataFrame, cols: Sequence[str], suffix: str = "_encoded") -> DataFrame:
    """Code 0..k-1 (bigint) of every value in sorted order, as a new column; NULL stays NULL."""
    for c in cols:
        codes = _numbered(df.select(ref(c).alias("_value")).where(ref(c).isNotNull()).distinct(), ["_value"])
        df = df.join(codes.withColumnRenamed("_code", c + suffix), ref(c) == F.col("_value"), "left").drop("_value")
    return df


def string_index_frequency(df: DataFrame, cols: Sequence[str], suffix: str = "Index") -> DataFrame:
    """Index (double) by falling frequency, ties in alphabetical order, as a new column; NULL gets the index after the last."""
    for c in cols:
        counts = df.select(ref(c).cast("string").alias("_value")).where("_value IS NOT NULL").groupBy("_value").agg((-F.count(F.lit(1))).alias("_often"))
        codes = settle(_numbered(counts, ["_often", "_value"]).select("_value", F.col("_code").cast("double").alias(c + suffix)))
        beyond = float(codes.count())
        joined = df.join(codes, ref(c).cast("string") == F.col("_value"), "left").drop("_value")
        df = replace_columns(joined, {c + suffix: F.coalesce(ref(c + suffix), F.lit(beyond))})
    return df


def fit_minmax(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Scaling parameters, one row per column: name, min, max, scale. A constant column has scale 1."""
    totals = df.agg(*[f(ref(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(cols)
                      for n, f in (("lo", F.min), ("hi", F.max))])
    rows = []
    for i, c in enumerate(cols):
        lo, hi = F.col(f"lo{i}") + F.lit(0.0), F.col(f"hi{i}") + F.lit(0.0)
        rows.append({"name": F.lit(c), "min": lo, "max": hi, "scale": F.when(hi > lo, F.lit(1.0) / (hi - lo)).otherwise(1.0)})
    return long_form(totals, rows)


def apply_minmax(df: DataFrame, params: DataFrame) -> DataFrame:
    """Scale every column named in the parameter table, on training and test data alike."""
    fitted = {row["name"]: row for row in params.collect()}
    return replace_columns(df, {c: (ref(c).cast("double") - F.lit(p["min"])) * F.lit(p["scale"]) for c, p in fitted.items()})


def pairwise(df: DataFrame, cols: Sequence[str], op: str = "product", with_self: bool = False,
             name: str = "{a}_x_{b}") -> DataFrame:
    """Product or larger value of every pair of columns, as new columns in one projection."""
    pairs = combinations_with_replacement(cols, 2) if with_self else combinations(cols, 2)
    fn = {"product": product, "max": row_max}[op]
    return df.select("*", *[fn(ref(a), ref(b)).alias(name.format(a=a, b=b)) for a, b in pairs])


def squares(df: DataFrame, cols: Sequence[str], name: str = "{a}_square") -> DataFrame:
    return df.select("*", *[square(ref(a)).alias(name.format(a=a)) for a in cols])


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Feature vector of columns that hold no NULL."""
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


