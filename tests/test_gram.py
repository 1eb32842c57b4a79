"""Correlations of many columns against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabkit.operators import gram


@pytest.mark.parametrize("columns, block, cells", [(3, 256, 20_000_000), (60, 16, 20_000_000), (60, 7, 6 * 60 * 9)])
def test_same_as_pandas(spark, monkeypatch, columns, block, cells):
    monkeypatch.setattr(gram, "STATE_CELLS", cells)
    draw = np.random.default_rng(columns)
    x = draw.normal(size=(300, columns)) @ draw.normal(size=(columns, columns)) + 1e6 * draw.normal(size=columns)
    x[draw.random(x.shape) < 0.2] = np.nan
    x[:, 0] = 12345.678  # no spread
    x[5:, 1] = np.nan
    frame = pd.DataFrame(x, columns=[f"c.{i}" for i in range(columns)])
    df = spark.createDataFrame([tuple(None if np.isnan(v) and i % 2 else float(v) for v in row) for i, row in enumerate(x)],
                               ", ".join(f"`c.{i}` double" for i in range(columns))).repartition(5)
    got = {(r.column_x, r.column_y): r["corr"] for r in gram.corr_matrix_wide(df, frame.columns.tolist(), block).collect()}
    want = frame.corr(min_periods=1)
    assert len(got) == columns * columns
    for a in frame.columns:
        for b in frame.columns:
            both = frame[[a, b]].dropna()
            if len(both) < 2 or "c.0" in (a, b):
                assert got[a, b] is None
            else:
                assert got[a, b] == pytest.approx(want.loc[a, b], abs=1e-6)


def test_cases(spark):
    empty = spark.createDataFrame([], "a double, b int")
    assert [r["corr"] for r in gram.corr_matrix_wide(empty, ["a", "b"]).collect()] in ([None] * 4, [])
    with pytest.raises(ValueError):
        gram.corr_matrix_wide(empty, [])


def test_plan_does_not_grow_with_the_pairs(spark):
    def size(columns):
        df = spark.range(3).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(columns)])
        return len(gram.corr_matrix_wide(df, df.columns)._jdf.queryExecution().optimizedPlan().toString())

    assert size(160) < 3 * size(80)
