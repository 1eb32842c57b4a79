"""Train/test splits, folds and samples that depend on a row key only."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabkit.columns import ref
from tabkit.functions.draws import uniform_by_key
from tabkit.runtime import settle


def split_by_key(df: DataFrame, key: str, ratio: float, salt: int | str = "split") -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts that together are the whole, the first with about ``ratio`` of the rows.

    Rows that share a key stay together, so all rows without a key are in one part.
    """
    draw = uniform_by_key(ref(key), salt)
    return df.filter(draw < ratio), df.filter(draw >= ratio)


def sample_by_key(df: DataFrame, key: str, fraction: float, salt: int | str = "sample") -> DataFrame:
    return df.filter(uniform_by_key(ref(key), salt) < fraction)


def slices_for(rows: int) -> int:
    return max(1, isqrt(rows))


def split_stratified(df: DataFrame, key: str, label: str, ratio: float,
                     salt: int | str = "split") -> tuple[DataFrame, DataFrame]:
    """Exactly round(ratio * n) rows of every label in the first part: those with the smallest draws.

    That holds for a key without NULL (refused) and without repeats; rows that share a key stay together, so a key
    that repeats moves the number by its repeats at most. Draws are uniform, so equal slices of [0, 1) hold about equally
    many rows. The slices grow with the square root of the rows, in number and size. Slice counts tell in which slice the last chosen row of a label
    lies, and only that slice is sorted.
    """
    drawn = df.withColumn("_u", uniform_by_key(ref(key), salt))
    per_label = drawn.groupBy(ref(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"), F.count_if(ref(key).isNull()).alias("_without"))
    most, without = per_label.agg(F.coalesce(F.max("_n"), F.lit(0)), F.coalesce(F.sum("_without"), F.lit(0))).first()
    if without:
        raise ValueError(f"{without} rows have no {key}")
    slices = slices_for(most)
    in_slice = drawn.select(ref(label).alias("_label"), F.floor(F.col("_u") * slices).alias("_slice"), "_u", ref(key).alias("_key"))
    counts = in_slice.groupBy("_label", "_slice").agg(F.count(F.lit(1)).alias("_in"))
    by_label = W.partitionBy("_label")
    upto = counts.withColumn("_upto", F.sum("_in").over(by_label.orderBy("_slice")))
    upto = upto.withColumn("_take", F.floor(F.sum("_in").over(by_label) * ratio + 0.5))
    edge = upto.filter((F.col("_take") > F.col("_upto") - F.col("_in")) & (F.col("_take") <= F.col("_upto")))
    edge = edge.select(F.col("_label").alias("_edge_label"), F.col("_slice").alias("_edge_slice"), (F.col("_take") - F.col("_upto") + F.col("_in")).alias("_rank"))
    in_order = F.row_number().over(W.partitionBy("_label").orderBy("_u", "_key"))
    at_edge = F.col("_label").eqNullSafe(F.col("_edge_label")) & (F.col("_slice") == F.col("_edge_slice"))
    last = (in_slice.join(edge, at_edge).withColumn("_row", in_order)
            .filter(F.col("_row") == F.col("_rank"))
            .select("_label", F.struct("_u", "_key").alias("_last")))
    last = settle(last, "split")  # both parts are read again and again
    joined = drawn.join(last, ref(label).eqNullSafe(F.col("_label")), "left")
    chosen = F.coalesce(F.struct(F.col("_u"), ref(key).alias("_key")) <= F.col("_last"), F.lit(False))
    flagged = joined.withColumn("_chosen", chosen).drop("_u", "_label", "_last")
    return (flagged.filter("_chosen").drop("_chosen"), flagged.filter(~F.col("_chosen")).drop("_chosen"))


def stratified_folds(df: DataFrame, key: str, label: str, folds: int, out: str, salt: int | str = "fold") -> DataFrame:
    """Add a fold number to every row: each label's rows in the order of their draws, cut into ``folds`` parts that differ by one row.

    As in ``split_stratified`` that holds for a key without NULL (refused) and without repeats, slices tell where a rank lies, and
    only slices with a cut are sorted. All cuts of all labels are found together; a row gets ``folds - 1`` of them by its label.
    """
    drawn = df.withColumn("_u", uniform_by_key(ref(key), salt))
    per_label = drawn.groupBy(ref(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"), F.count_if(ref(key).isNull()).alias("_without"))
    most, without = per_label.agg(F.coalesce(F.max("_n"), F.lit(0)), F.coalesce(F.sum("_without"), F.lit(0))).first()
    if without:
        raise ValueError(f"{without} rows have no {key}")
    slices = slices_for(most)
    in_slice = drawn.select(ref(label).alias("_label"), F.floor(F.col("_u") * slices).alias("_slice"), "_u", ref(key).alias("_key"))
    counts = in_slice.groupBy("_label", "_slice").agg(F.count(F.lit(1)).alias("_in"))
    by_label = W.partitionBy("_label")
    upto = counts.select("*", F.sum("_in").over(by_label.orderBy("_slice")).alias("_upto"), F.sum("_in").over(by_label).alias("_all"))
    # rank of the last row of each part but the last: n * part / folds, rounded
    ends = F.transform(F.sequence(F.lit(1), F.lit(folds - 1)), lambda j: F.floor((2 * F.col("_all") * j + folds) / (2 * folds))) if folds > 1 else F.array().cast("array<bigint>")
    here = F.filter(ends, lambda r: (r > F.col("_upto") - F.col("_in")) & (r <= F.col("_upto")))
    edge = upto.select(F.col("_label").alias("_edge_label"), F.col("_slice").alias("_edge_slice"),
                       F.transform(here, lambda r: r - F.col("_upto") + F.col("_in")).alias("_ranks")).where(F.size("_ranks") > 0)
    at_edge = F.col("_label").eqNullSafe(F.col("_edge_label")) & (F.col("_slice") == F.col("_edge_slice"))
    in_order = F.row_number().over(W.partitionBy("_label", "_slice").orderBy("_u", "_key"))
    cuts = (in_slice.join(edge, at_edge).withColumn("_row", in_order).where(F.array_contains("_ranks", F.col("_row").cast("bigint")))
            .groupBy(F.col("_label").alias("_cut_label")).agg(F.collect_set(F.struct("_u", "_key")).alias("_cuts")))  # folds - 1 at most
    joined = drawn.join(settle(cuts, "folds"), ref(label).eqNullSafe(F.col("_cut_label")), "left")
    place = F.struct(F.col("_u"), ref(key).alias("_key"))
    number = F.size(F.filter(F.coalesce("_cuts", F.array()), lambda c: c < place))
    return joined.withColumn(out, number).drop("_u", "_cut_label", "_cuts")
