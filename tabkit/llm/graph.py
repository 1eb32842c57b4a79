"""Connected components of an edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.llm.stored import discard, store


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node ties its larger neighbours to the least node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # stored, so that the join shuffles both sides itself and Spark may split a node with very many neighbours
    least = store(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m")), "least")
    return both.where("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node ties its smaller neighbours, and itself, to the least of them. Edges point to the smaller node."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
    tied = edges.join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every node of the edges (u, v), bigint; root is the least node of its component.

    A node with many neighbours is counted before the shuffle and joined by a join that Spark splits. Every round is
    written to the shared folder and the one before it deleted; rounds end when the edges stay as they are, after a logarithmic number of rounds.
    """
    pairs = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = store(pairs, "edges")
    mark = None
    while True:
        before, now = now, store(_small_star(_large_star(now)), "edges")
        discard(before)
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark is not None and tuple(seen) == mark:
            break
        mark = tuple(seen)
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots.select(F.col("v").alias("id"), F.col("v").alias("root")))
