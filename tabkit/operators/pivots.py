"""Exact k-nearest neighbours with a pivot index: blocks of base vectors that cannot hold a neighbour are not visited.

Base vectors are assigned to the nearest of a bounded number of pivots, and each pivot's vectors are cut into shells of about
``BLOCK_ROWS`` by their distance to it. For a block the least and largest of these distances are known; with the triangle
inequality, which Minkowski distances obey for p >= 1, they bound the distance of a query to every vector in it from below. A query is first compared with one
block, its own shell. Its k-th distance there is an upper bound, and of the other blocks it visits those whose lower bound does not exceed it.

The driver holds the pivots, and one row per block: a few numbers for a thousand vectors. On vectors without any structure nearly all blocks
are visited, as by ``neighbours.nearest``; on clustered ones few are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabkit.columns import ref
from tabkit.operators.neighbours import block_search, distance_function, nearest
from tabkit.runtime import settle

BLOCK_ROWS = 1_000
PIVOTS = 64
DRAWN = 8  # vectors drawn per pivot, of which the pivots are those that lie farthest apart
CELLS = 1_000_000  # queries x blocks that a task looks at together
SENT = 2**20  # numbers of vectors that a task hands over together


def far_apart(vectors: np.ndarray, number: int, p: float) -> np.ndarray:
    """One vector after the other, each the one farthest from those before."""
    distances = distance_function(p)
    chosen, gap = [0], distances(vectors, vectors[:1])[:, 0]
    while len(chosen) < min(number, len(vectors)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, distances(vectors, vectors[chosen[-1:]])[:, 0])
    return vectors[chosen]


def _cells(rows: DataFrame, pivots: np.ndarray, p: float) -> DataFrame:
    """The rows (first column an id, second ``vec``) with ``cell``, the nearest pivot, and ``r``, its distance; a vector without a finite
    distance is in the cell behind the last."""
    distances = distance_function(p)

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                far = distances(np.stack(batch["vec"]).astype("float64"), pivots)
                lost = ~np.isfinite(far).all(1)
                cell = np.where(lost, len(pivots), np.where(np.isfinite(far), far, np.inf).argmin(1))
                yield batch.assign(cell=cell.astype("int32"), r=np.where(lost, 0.0, np.take_along_axis(far, np.minimum(cell, len(pivots) - 1)[:, None], 1)[:, 0]))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInPandas(task, f"{fields}, cell int, r double")


def _shells(rows: DataFrame, cuts: dict[int, np.ndarray], first: dict[int, int]) -> DataFrame:
    """Add ``block``: the number of the shell of the row's cell in which its distance lies."""
    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            block = np.full(len(batch), -1, np.int64)
            cell, r = batch["cell"].to_numpy(), batch["r"].to_numpy()
            for c in np.unique(cell):
                if c in first:
                    own = cell == c
                    block[own] = first[c] + np.searchsorted(cuts[c], r[own])
            yield batch.assign(block=block)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInPandas(task, f"{fields}, block bigint")


def _searched(queries: DataFrame, base: DataFrame, k: int, p: float, same: bool) -> DataFrame:
    """id, base_id, label, distance: the k nearest of each query in its block; queries of a block are dealt to tasks of bounded size."""
    counts = queries.groupBy(F.col("block").alias("k_block")).agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_ROWS)).cast("int").alias("parts"))
    left = queries.join(counts, F.col("block") == F.col("k_block")).select(
        "block", F.pmod(F.xxhash64("q_id"), "parts").cast("int").alias("part"), "q_id", F.col("vec").alias("q_vec"))
    right = base.join(counts, F.col("block") == F.col("k_block")).select(
        "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "b_id", F.col("vec").alias("b_vec"), "b_label")
    kinds = [left.schema["q_id"], right.schema["b_id"], right.schema["b_label"]]
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(("id", "base_id", "label"), kinds)) + ", distance double"
    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(block_search(k, p, same), schema)


def visits(queries: DataFrame, blocks: pd.DataFrame, pivots: np.ndarray, p: float) -> DataFrame:
    """q_id, vec, block for every block that a query (q_id, vec, block, bound) has to visit besides its own."""
    distances = distance_function(p)
    number, cell, low, high = (blocks[c].to_numpy() for c in ("block", "cell", "low", "high"))
    cells, sent = CELLS, SENT  # travel by value

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            step = max(1, cells // max(1, len(number)))
            for begin in range(0, len(whole), step):
                batch = whole.iloc[begin:begin + step]
                # a column of zeros for the cell behind the last: nothing is known of it, so it is always visited
                far = np.concatenate([distances(np.stack(batch["vec"]).astype("float64"), pivots), np.zeros((len(batch), 1))], 1)[:, cell]
                bound = batch["bound"].to_numpy()[:, None]
                least = np.maximum(far - high, low - far)
                near = ~(least > bound * (1 + 1e-9) + 1e-300)  # also where nothing is known
                near |= cell == len(pivots)
                near &= number != batch["block"].to_numpy()[:, None]
                q, b = np.nonzero(near)
                # a vector is written once per block, so a batch of queries can be many times its size
                ids, vectors, piece = batch["q_id"].to_numpy(), batch["vec"].to_numpy(), max(1, sent // pivots.shape[1])
                for at in range(0, len(q), piece):
                    some = q[at:at + piece]
                    yield pd.DataFrame({"q_id": ids[some], "vec": vectors[some], "block": number[b[at:at + piece]]})

    kinds = {f.name: f.dataType.simpleString() for f in queries.schema.fields}
    return queries.mapInPandas(task, f"q_id {kinds['q_id']}, vec {kinds['vec']}, block bigint")


def _index(base: DataFrame, p: float, pivots: int) -> tuple[np.ndarray, DataFrame, dict[int, np.ndarray], dict[int, int], pd.DataFrame]:
    """Pivots, base vectors with their blocks (stored), the cuts and the first block of each cell, and one row per block."""
    drawn = base.select("b_id", "vec").orderBy(F.xxhash64(F.lit("pivot"), "b_id")).limit(DRAWN * pivots).collect()
    vectors = np.array([r["vec"] for r in drawn], float)
    finite = vectors[np.isfinite(vectors).all(1)]
    chosen = far_apart(finite, pivots, p) if len(finite) else np.zeros((1, vectors.shape[1]))
    assigned = settle(_cells(base, chosen, p), "cells")
    counts = {r["cell"]: r["n"] for r in assigned.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per pivot
    cuts, first = {}, {}
    for cell, n in sorted(counts.items()):
        first[cell], cuts[cell] = sum(len(c) + 1 for c in cuts.values()), np.zeros(0)
        shells = math.ceil(n / BLOCK_ROWS)
        if shells > 1:
            at = [i / shells for i in range(1, shells)]
            found = assigned.where(F.col("cell") == cell).agg(F.percentile_approx("r", at, max(10_000, 20 * shells))).first()[0]
            cuts[cell] = np.unique(found)
    indexed = settle(_shells(assigned, cuts, first), "indexed")
    blocks = indexed.groupBy("block", "cell").agg(F.min("r").alias("low"), F.max("r").alias("high")).toPandas()
    return chosen, indexed, cuts, first, blocks


def nearest_by_pivots(base: DataFrame, queries: DataFrame, k: int, p: float = 2, id_col: str = "id", vec_col: str = "vec",
                      label_col: str = "label", same: bool = False, pivots: int = PIVOTS) -> DataFrame:
    """The same rows as ``neighbours.nearest``, and ``visited``, the share of the base's blocks that the query was compared with.

    Equal vectors beyond a block's size share a shell and make it larger. A query with fewer than k finite distances in its first block
    visits all blocks.
    """
    if not p >= 1:
        raise ValueError("p must be 1 or more")
    source = base.select(ref(id_col).alias("b_id"), ref(vec_col).alias("vec"), ref(label_col).alias("b_label"))
    if source.isEmpty():
        return nearest(base, queries, k, p, id_col, vec_col, label_col, same).withColumn("visited", F.lit(1.0))
    chosen, indexed, cuts, first, blocks = _index(source, p, pivots)
    placed = settle(_shells(_cells(queries.select(ref(id_col).alias("q_id"), ref(vec_col).alias("vec")), chosen, p), cuts, first), "queries")
    own = settle(_searched(placed, indexed, k, p, same), "own")
    bounds = own.groupBy(F.col("id").alias("k_id")).agg(F.count("distance").alias("n"), F.max("distance").alias("far"))
    if same:  # a block's rows are k and the vector itself at most, so the k-th is found by rank
        ranked = own.withColumn("rank", F.row_number().over(W.partitionBy("id").orderBy(F.col("distance").asc_nulls_last(), "base_id"))).where(F.col("rank") <= k)
        bounds = ranked.groupBy(F.col("id").alias("k_id")).agg(F.count("distance").alias("n"), F.max("distance").alias("far"))
    known = F.when((F.col("n") >= k) & ~F.isnan("far"), F.col("far")).otherwise(F.lit(float("inf")))
    bounded = placed.join(bounds, F.col("q_id") == F.col("k_id"), "left").select("q_id", "vec", "block", known.alias("bound"))
    others = settle(visits(bounded, blocks, chosen, p), "visits")
    found = own.unionByName(_searched(others, indexed, k, p, same))
    rank = F.row_number().over(W.partitionBy("id").orderBy(F.col("distance").asc_nulls_last(), "base_id"))
    best = found.withColumn("rank", rank).filter(F.col("rank") <= k).select("id", "rank", "label", "distance")
    share = others.groupBy(F.col("q_id").alias("v_id")).agg(((F.count(F.lit(1)) + 1) / F.lit(max(1, len(blocks)))).alias("share"))
    return best.join(share, F.col("id") == F.col("v_id"), "left").select(
        "id", "rank", "label", "distance", F.coalesce("share", F.lit(1.0 / max(1, len(blocks)))).alias("visited"))
