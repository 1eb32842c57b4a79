"""Correlations of very many columns by blocks of a Gram matrix.

``stats.corr_matrix`` writes an aggregate for every pair, so its plan grows with the square of the columns. Here a row is one array, and
tasks multiply blocks of rows: for all pairs at once they sum values, squares, products and presence over the rows where both are
present. The values are centred first, so that sums of squares do not swallow small spreads. The plan has one expression per column.

A task keeps sums for ``STATE_CELLS`` numbers at most; beyond that the columns are taken in groups, one pass over the data each. It returns
one record per column and block of ``BLOCK`` other columns. These are added up in two steps, the first on many tasks per block, so no task
sees more than a share of what all tasks return.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.columns import ref

BLOCK = 256
STATE_CELLS = 20_000_000
SUMS = 6  # rows, both sums, both sums of squares, products
SALTS = 32
FLAT = 1e-10  # share of its squares below which a spread is rounding


def _sums(rows: DataFrame, centre: np.ndarray, first: int, end: int, block: int) -> DataFrame:
    """a, b (block), part, sums of the columns ``first`` to ``end`` with all columns."""
    columns = len(centre)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((SUMS, end - first, columns))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, columns) - centre
            there = (~np.isnan(x)).astype(float)
            x = np.where(there > 0, x, 0.0)
            own, here = x[:, first:end], there[:, first:end]
            for i, (left, right) in enumerate(((here, there), (own, there), (here, x), (own * own, there), (here, x * x), (own, x))):
                total[i] += left.T @ right
        part = TaskContext.get().partitionId() % SALTS  # the same in a task that runs again
        for begin in range(0, columns, block):
            cut = np.ascontiguousarray(total[:, :, begin:begin + block].transpose(1, 0, 2)).reshape(end - first, -1)
            n, width = cut.shape
            yield pa.record_batch([pa.array(np.arange(first, end, dtype=np.int32)), pa.array(np.full(n, begin // block, np.int32)), pa.array(np.full(n, part, np.int32)),
                                   pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width, dtype=np.int32)), pa.array(cut.ravel()))], ["a", "b", "part", "sums"])

    return rows.mapInArrow(task, "a int, b int, part int, sums array<double>")


def _added(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One record per key: the sums of all that have it. Records come sorted, and one of a key is held at a time."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, None
        for batch in batches:
            labels = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            ends = batch.column(3).offsets.to_numpy()
            values = batch.column(3).values.to_numpy()
            for i, label in enumerate(labels):
                own = values[ends[i]:ends[i + 1]]
                if held is not None and label[:len(keys)] == held[:len(keys)]:
                    total = total + own
                    continue
                if held is not None:
                    yield pa.record_batch([pa.array([x], pa.int32()) for x in held] + [pa.array([total], pa.list_(pa.float64()))], ["a", "b", "part", "sums"])
                held, total = label, own
        if held is not None:
            yield pa.record_batch([pa.array([x], pa.int32()) for x in held] + [pa.array([total], pa.list_(pa.float64()))], ["a", "b", "part", "sums"])

    dealt = sums.select("a", "b", "part", "sums").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(task, "a int, b int, part int, sums array<double>")


def corr_matrix_wide(df: DataFrame, cols: Sequence[str], block: int = BLOCK) -> DataFrame:
    """column_x, column_y, corr: Pearson correlation of every ordered pair over the rows where both are present (neither NULL nor NaN); NULL
    where that leaves a column without spread."""
    if not cols:
        raise ValueError("there are no columns")
    value = [ref(c).cast("double") for c in cols]
    value = [F.when(~F.isnan(v), v) for v in value]
    means = df.agg(*[F.avg(v) for v in value]).first()
    centre = np.array([0.0 if m is None or not math.isfinite(m) else m for m in means])
    rows = df.select(F.array(*value).alias("x"))
    each = max(1, STATE_CELLS // (SUMS * len(cols)))
    passes = [_sums(rows, centre, a, min(a + each, len(cols)), block) for a in range(0, len(cols), each)]
    sums = _added(_added(reduce(DataFrame.unionByName, passes), ["a", "b", "part"]), ["a", "b"])

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)):
                n, x, y, xx, yy, xy = s.values.to_numpy().reshape(SUMS, -1)
                with np.errstate(all="ignore"):
                    spread_x, spread_y = xx - x * x / n, yy - y * y / n
                    corr = (xy - x * y / n) / np.sqrt(spread_x * spread_y)
                other = b * block + np.arange(len(n))
                good = (n > 0) & (spread_x > FLAT * xx) & (spread_y > FLAT * yy) & np.isfinite(corr)
                corr = np.where(other == a, 1.0, np.clip(np.where(good, corr, 0.0), -1.0, 1.0))
                yield pa.record_batch([pa.array(np.full(len(n), a, np.int32)), pa.array(other.astype(np.int32)), pa.array(corr, mask=~good)], ["a", "b", "corr"])

    names = F.array(*map(F.lit, cols))
    pairs = sums.mapInArrow(finished, "a int, b int, corr double")
    return pairs.select(F.get(names, F.col("a")).alias("column_x"), F.get(names, F.col("b")).alias("column_y"), "corr")
