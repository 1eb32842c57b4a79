"""Scores of predictions and comparison of models."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabkit.columns import long_form, ref
from tabkit.runtime import settle

SCORES_PER_SLICE = 1_000_000


def accuracy(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.agg(F.avg((ref(y) == ref(p)).cast("double")).alias("accuracy"))


def _grid(df: DataFrame, y: str, p: str, labels: Sequence) -> DataFrame:
    """One row with the count of every (actual, predicted) cell, empty cells included."""
    return df.agg(*[F.count_if((ref(y) == a) & (ref(p) == b)).alias(f"n{i}_{j}")
                    for (i, a), (j, b) in product(enumerate(labels), repeat=2)])


def confusion_matrix(df: DataFrame, y: str, p: str, labels: Sequence = (0, 1)) -> DataFrame:
    """Count and percentage of every (actual, predicted) pair."""
    cells = [(i, j) for i in range(len(labels)) for j in range(len(labels))]
    total = reduce(Column.__add__, [F.col(f"n{i}_{j}") for i, j in cells])
    rows = [{"actual": F.lit(labels[i]), "predicted": F.lit(labels[j]), "count": F.col(f"n{i}_{j}"),
             "percent": F.try_divide(F.col(f"n{i}_{j}") * 100.0, total)} for i, j in cells]
    return long_form(_grid(df, y, p, labels), rows)


def classification_report(df: DataFrame, y: str, p: str, labels: Sequence = (0, 1)) -> DataFrame:
    """Precision, recall, F1 and support per class, their plain and support-weighted means, and the accuracy."""
    k = range(len(labels))

    def total(cells):
        return reduce(Column.__add__, [F.col(f"n{i}_{j}") for i, j in cells]).cast("double")

    def ratio(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    per_class = []
    for c in k:
        hit, support = F.col(f"n{c}_{c}").cast("double"), total((c, j) for j in k)
        precision, recall = ratio(hit, total((i, c) for i in k)), ratio(hit, support)
        f1 = ratio(2.0 * precision * recall, precision + recall)
        per_class.append({"precision": precision, "recall": recall, "f1": f1, "support": support})
    everything = total((i, j) for i in k for j in k)

    def mean(name, weights=None):
        parts = [row[name] * (row[weights] if weights else 1.0) for row in per_class]
        return ratio(reduce(Column.__add__, parts), everything if weights else F.lit(float(len(labels))))

    right = ratio(total((c, c) for c in k), everything)
    rows = [{"label": F.lit(str(labels[c])), **per_class[c]} for c in k]
    rows.append({"label": F.lit("accuracy"), "precision": right, "recall": right, "f1": right, "support": everything})
    for name, weights in (("macro avg", None), ("weighted avg", "support")):
        rows.append({"label": F.lit(name), **{m: mean(m, weights) for m in ("precision", "recall", "f1")},
                     "support": everything})
    for row in rows:
        row["support"] = row["support"].cast("bigint")
    return long_form(_grid(df, y, p, labels), rows)


def auc_roc(df: DataFrame, y: str, score: str) -> DataFrame:
    """Exact area under the ROC curve: share of (positive, negative) pairs in the right order, ties count half.

    NULL scores and labels are left out; NaN counts as the highest score. Rows are reduced to one per distinct score. The
    scores are cut into as many ranges as they need, ranked inside each, and only the range totals are ranked globally. Ranges
    are stored, because a range computed anew could begin elsewhere.
    """
    s = ref(score).cast("double") + F.lit(0.0)
    rows = df.filter(s.isNotNull() & ref(y).isNotNull()).select(s.alias("s"), (ref(y) == 1).cast("bigint").alias("pos"))
    by_score = rows.groupBy("s").agg(F.sum("pos").alias("pos"), F.sum(F.lit(1) - F.col("pos")).alias("neg"))
    slices = rows.count() // SCORES_PER_SLICE + 1
    if slices == 1:
        sliced = by_score.withColumn("slice", F.lit(0))
    else:
        sliced = settle(by_score.repartitionByRange(slices, "s").withColumn("slice", F.spark_partition_id()), "scores")
    lower = W.partitionBy("slice").orderBy("s").rowsBetween(W.unboundedPreceding, -1)
    inside = sliced.withColumn("below", F.coalesce(F.sum("neg").over(lower), F.lit(0)))
    totals = inside.groupBy("slice").agg(
        F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2.0)).alias("ordered"),
        F.sum("pos").cast("double").alias("pos"), F.sum("neg").cast("double").alias("neg"))
    earlier = W.orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    ranked = totals.withColumn("earlier", F.coalesce(F.sum("neg").over(earlier), F.lit(0.0)))
    return ranked.agg(F.try_divide(F.sum(F.col("ordered") + F.col("pos") * F.col("earlier")),
                                   F.sum("pos") * F.sum("neg")).alias("auc"))


def score_interval(df: DataFrame, col: str, level: float = 0.95) -> DataFrame:
    """Mean of repeated scores, its standard error (population deviation) and the normal interval."""
    z = NormalDist().inv_cdf(0.5 + level / 2.0)
    stats = df.agg(F.avg(ref(col)).alias("mean"),
                   (F.stddev_pop(ref(col)) / F.sqrt(F.count(ref(col)))).alias("std_error"))
    half = F.lit(z) * F.col("std_error")
    return stats.select("mean", "std_error", (F.col("mean") - half).alias("low"), (F.col("mean") + half).alias("high"))


def select_best(leaderboard: DataFrame, metric: str, order: str) -> DataFrame:
    """The row with the highest value of one metric, the first listed on ties."""
    same = leaderboard.filter(F.col("metric") == metric)
    return same.orderBy(F.desc("value"), F.asc(ref(order))).limit(1)


def promote_decision(leaderboard: DataFrame, champion: str, challengers: Sequence[str], metric: str = "accuracy",
                     tolerance: float = 0.01) -> DataFrame:
    """"do_nothing" when the best challenger falls behind the champion by more than the tolerance, else the best
    challenger; the last listed on ties."""
    names = [champion, *challengers]
    scores = leaderboard.filter(F.col("metric") == metric).agg(
        *[F.max(F.when(F.col("model") == m, F.col("value"))).alias(f"s{i}") for i, m in enumerate(names)])
    best = F.greatest(*[F.col(f"s{i}") for i in range(1, len(names))])
    choice = F.when(best - F.col("s0") < -tolerance, F.lit("do_nothing"))
    for i in range(len(names) - 1, 0, -1):
        choice = choice.when(F.col(f"s{i}") == best, F.lit(names[i]))
    return scores.select(choice.alias("decision"), F.col("s0").alias("champion"), best.alias("best_challenger"))
