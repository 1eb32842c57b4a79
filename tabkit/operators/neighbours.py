"""Exact k-nearest-neighbour classification of many vectors against many vectors."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabkit.columns import ref
from tabkit.functions.draws import fold_by_key

BLOCK_ROWS = 1_000  # up to SPREAD blocks have about so many rows each
SPREAD = 8
BASE_VALUES, QUERY_VALUES = 2**22, 2**21  # numbers in a block: 65,536 and 32,768 vectors of 64 dimensions
MOST_MEASURED = 2**21  # pairs that a task measures exactly at once


def distance_function(p: float) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function that travels to the tasks by value, which need numpy and pandas but not this package."""
    def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Every row of a to every row of b, summed dimension by dimension."""
        total = np.zeros((len(a), len(b)))
        for x, y in zip(a.T, b.T):
            gap = x[:, None] - y[None, :]
            total += np.abs(gap) if p == 1 else gap * gap if p == 2 else np.abs(gap) ** p
        return total if p == 1 else np.sqrt(total) if p == 2 else total ** (1 / p)

    return distances


def block_search(k: int, p: float, same: bool) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """The k nearest rows of a block of base vectors for every row of a block of queries, likewise by value.

    All pairs get a rough distance with a known bound of its error: a matrix product of floats for p = 2, sums of 16-bit integers for p = 1, of
    floats else. Only the pairs that may be among the nearest by it are measured exactly, so the rows are those of an exact search. They are
    looked at in tiles of bounded size. Where rough distances tell too little apart, a tile is measured exactly as a whole.
    """
    distances = distance_function(p)
    wanted, most = k + same, MOST_MEASURED
    tile_rows, tile_columns = (256, max(2048, 4 * wanted)) if p == 2 else (32, max(4096, 4 * wanted))

    def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Every row of a to the same row of b, in the same steps as all rows to all."""
        total = np.zeros(len(a))
        for x, y in zip(a.T, b.T):
            gap = x - y
            total += np.abs(gap) if p == 1 else gap * gap if p == 2 else np.abs(gap) ** p
        return total if p == 1 else np.sqrt(total) if p == 2 else total ** (1 / p)

    def places(mask: np.ndarray) -> np.ndarray:
        """Places of the few that are true, looked for eight at a time."""
        flat = mask.ravel()
        even = len(flat) // 8 * 8
        eights = (np.flatnonzero(flat[:even].view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
        return np.concatenate([eights[flat[eights]], even + np.flatnonzero(flat[even:])])

    def rough(q: np.ndarray, b: np.ndarray) -> tuple[Callable, Callable]:
        """Rough sums of a tile of rows and columns, and the rough sum up to which one may be as near as another, by the other's."""
        q, b = q - b.mean(0), b - b.mean(0)  # exact enough: the error is small against the differences
        size = max(np.abs(q).max(), np.abs(b).max()) or 1.0
        q, b, dims = q / size, b / size, q.shape[1]
        if p == 1:
            step = ((np.abs(q).sum(1).max() + np.abs(b).sum(1).max()) or 1.0) / max(32_000 - dims, 1_000)
            x16, y16 = np.rint(q / step).astype(np.int16), np.ascontiguousarray(np.rint(b / step).astype(np.int16).T)
            return (lambda rows, columns: added(x16[rows].T, y16[:, columns], np.int16),
                    lambda t, rows: np.minimum(t.astype(np.int64) + 2 * dims + 2, 32_767).astype(np.int16))
        tiny = 2.0 ** -23
        x32, y32 = q.astype(np.float32), b.astype(np.float32)
        if p == 2:
            error = (2 * (dims + 16) * tiny * (np.sqrt((q * q).sum(1)) + np.sqrt((b * b).sum(1).max())) ** 2 + 1e-30)
            double, lengths = x32 * -2, (b * b).sum(1).astype(np.float32)
            return lambda rows, columns: double[rows] @ y32[columns].T + lengths[columns], lambda t, rows: (t + error[rows]).astype(np.float32)
        long = lambda v: (np.abs(v) ** p).sum(1) ** (1 / p)
        error, across = 2 * (dims + 4 * p + 16) * tiny * (long(q) + long(b).max()), np.ascontiguousarray(y32.T)
        return (lambda rows, columns: added(x32[rows].T, across[:, columns], np.float32),
                lambda t, rows: ((t.astype(float) ** (1 / p) + error[rows]) ** p * (1 + 1e-6) + 1e-36).astype(np.float32))

    def added(x: np.ndarray, y: np.ndarray, kind: type) -> np.ndarray:
        total = np.zeros((x.shape[1], y.shape[1]), kind)
        gap, own = np.empty_like(total), np.empty_like(total)
        for one, other in zip(x, y):
            np.abs(np.subtract(one[:, None], other[None, :], out=gap), out=gap)
            if p == 3:
                np.multiply(np.multiply(gap, gap, out=own), gap, out=gap)
            elif p != 1:
                np.power(gap, kind(p), out=gap)
            np.add(total, gap, out=total)
        return total

    def may_be_near(tile: Callable, limit: Callable, rows: slice, number: int, columns: int) -> tuple[np.ndarray, np.ndarray] | None:
        """(row in the tile, column) of all that may be among the nearest; None if those are too many."""
        r, c, t, bound = np.zeros(0, np.int64), np.zeros(0, np.int64), None, None
        for begin in range(0, columns, tile_columns):
            sums = tile(rows, slice(begin, min(begin + tile_columns, columns)))
            if bound is None:
                bound, t = limit(np.partition(sums, wanted - 1, axis=1)[:, wanted - 1], rows), np.zeros(0, sums.dtype)
            hit = places(sums <= bound[:, None])
            if len(hit) + len(r) > most:
                return None
            r, c, t = np.concatenate([r, hit // sums.shape[1]]), np.concatenate([c, begin + hit % sums.shape[1]]), np.concatenate([t, sums.ravel()[hit]])
            order = np.lexsort((t, r))
            r, c, t = r[order], c[order], t[order]
            bound = np.minimum(bound, limit(t[np.searchsorted(r, np.arange(number)) + wanted - 1], rows))
            kept = t <= bound[r]
            r, c, t = r[kept], c[kept], t[kept]
        return r, c

    def block_nearest(q: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if q.empty or b.empty:
            return pd.DataFrame({"id": q["q_id"].iloc[:0], "base_id": b["b_id"].iloc[:0], "label": b["b_label"].iloc[:0],
                                 "distance": np.zeros(0)})
        b = b.sort_values("b_id", ignore_index=True)
        # of equal vectors no more than the first can be among the nearest
        copies = pd.DataFrame({"v": [v.tobytes() for v in b["b_vec"]]}).groupby("v").cumcount()
        b = b[copies < wanted].reset_index(drop=True)
        q_vec, b_vec = np.stack(q["q_vec"]).astype("float64"), np.stack(b["b_vec"]).astype("float64")
        fit = lambda v: (np.abs(v) < 1e150).all(1)  # noqa: E731 not so for NaN
        q_in, b_in, b_out = np.flatnonzero(fit(q_vec)), np.flatnonzero(fit(b_vec)), np.flatnonzero(~fit(b_vec))
        found = []

        def measured(at_q: np.ndarray, at_b: np.ndarray) -> None:
            """Of pairs, those of each query that are nearest, equal distances in the order of the base, NaN last."""
            far = paired(q_vec[at_q], b_vec[at_b])
            order = np.lexsort((at_b, far, at_q))
            at_q, at_b, far = at_q[order], at_b[order], far[order]
            first = np.arange(len(at_q)) - np.searchsorted(at_q, at_q) < wanted
            found.append((at_q[first], at_b[first], far[first]))

        def wholly(at_q: np.ndarray) -> None:
            for begin in range(0, len(at_q), step := max(1, most // len(b_vec))):
                some = at_q[begin:begin + step]
                far = distances(q_vec[some], b_vec)
                first = np.argsort(far, axis=1, kind="stable")[:, :wanted]
                found.append((np.repeat(some, first.shape[1]), first.ravel(), np.take_along_axis(far, first, axis=1).ravel()))

        rough_too = len(q_in) > 0 and len(b_in) > wanted and len(b_out) < len(b_in)
        tile, limit = rough(q_vec[q_in], b_vec[b_in]) if rough_too else (None, None)
        for begin in range(0, len(q_in), tile_rows):
            rows = q_in[begin:begin + tile_rows]
            near = may_be_near(tile, limit, slice(begin, begin + len(rows)), len(rows), len(b_in)) if rough_too else None
            if near is None:
                wholly(rows)
            else:  # of vectors that have no rough distance, all are measured
                measured(np.concatenate([rows[near[0]], np.repeat(rows, len(b_out))]), np.concatenate([b_in[near[1]], np.tile(b_out, len(rows))]))
        wholly(np.setdiff1d(np.arange(len(q)), q_in))
        at_q, at_b, far = (np.concatenate(x) for x in zip(*found))
        found = pd.DataFrame({"id": q["q_id"].to_numpy()[at_q], "base_id": b["b_id"].to_numpy()[at_b], "label": b["b_label"].to_numpy()[at_b], "distance": far})
        return found[found["id"] != found["base_id"]] if same else found

    return block_nearest


def nearest(base: DataFrame, queries: DataFrame, k: int, p: float = 2, id_col: str = "id", vec_col: str = "vec",
            label_col: str = "label", same: bool = False) -> DataFrame:
    """The k nearest base vectors of each query: ``id``, ``rank``, ``label``, ``distance``; equal distances in
    the order of the base ids. ``p`` is the exponent of the Minkowski distance, 1 or more. With ``same``, base and queries are
    one table and a vector is not its own neighbour. Distances that are infinite come last, after them those that are NaN, as NULL.

    Base and queries are dealt into blocks of bounded size by hashing their ids, every query block meets every
    base block in one task, which returns at most k rows per query. So neither side has to fit
    into one task, no pair leaves its task, and equal vectors spread over all blocks. A vector is sent once per block of the other side,
    so blocks are as large as a task's memory allows.
    """
    if not p >= 1:
        raise ValueError("p must be 1 or more")
    def blocks_of(df, values):
        rows, dims = df.agg(F.count(F.lit(1)), F.max(F.size(ref(vec_col)))).first()
        return max(1, min(SPREAD, math.ceil(rows / BLOCK_ROWS)), math.ceil(rows * max(dims or 1, 1) / values))

    base_blocks, query_blocks = blocks_of(base, BASE_VALUES), blocks_of(queries, QUERY_VALUES)

    def dealt(df, key, blocks, own, other, others):
        rows = df.withColumn(own, fold_by_key(F.col(key), blocks, "block"))
        return rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    # every column is renamed on both sides: base and queries may be the same frame
    left = dealt(queries.select(ref(id_col).alias("q_id"), ref(vec_col).alias("q_vec")), "q_id", query_blocks, "qb", "bb", base_blocks)
    right = dealt(base.select(ref(id_col).alias("b_id"), ref(vec_col).alias("b_vec"), ref(label_col).alias("b_label")),
                  "b_id", base_blocks, "bb", "qb", query_blocks)

    block_nearest = block_search(k, p, same)
    kinds = [left.schema["q_id"], right.schema["b_id"], right.schema["b_label"]]
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(("id", "base_id", "label"), kinds)) + ", distance double"
    # as many partitions as pairs of blocks: the work is in the pairs, not in the bytes by which Spark would gather small partitions
    left, right = (x.repartition(base_blocks * query_blocks, "qb", "bb") for x in (left, right))
    blocks = left.groupBy("qb", "bb").cogroup(right.groupBy("qb", "bb"))
    found = blocks.applyInPandas(block_nearest, schema)
    rank = F.row_number().over(W.partitionBy("id").orderBy(F.col("distance").asc_nulls_last(), "base_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("id", "rank", "label", "distance")


def knn_classify(base: DataFrame, queries: DataFrame, k: int = 5, p: float = 2, weights: str = "uniform",
                 id_col: str = "id", vec_col: str = "vec", label_col: str = "label", same: bool = False,
                 search: Callable[..., DataFrame] = nearest) -> DataFrame:
    """Label with the largest vote among the k nearest; the smaller label on ties.

    ``weights`` is "uniform" or "distance" (1/distance; exact matches outvote everything else). ``search`` is ``nearest``, or
    ``pivots.nearest_by_pivots`` where vectors lie in clusters.
    """
    near = search(base, queries, k, p, id_col, vec_col, label_col, same)
    if weights == "distance":
        exact = F.max((F.col("distance") == 0).cast("int")).over(W.partitionBy("id"))
        weight = F.when(exact == 1, (F.col("distance") == 0).cast("double")).otherwise(F.try_divide(F.lit(1.0), F.col("distance")))
    else:
        weight = F.lit(1.0)
    votes = near.withColumn("w", weight).groupBy("id", "label").agg(F.sum("w").alias("votes"))
    # rounded so that equal votes summed in another order still tie
    winner = F.min_by("label", F.struct(-F.round("votes", 9), F.col("label")))
    return votes.groupBy("id").agg(winner.alias("prediction"))
