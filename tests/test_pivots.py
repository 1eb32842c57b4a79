"""The pivot index against all distances."""

import numpy as np
import pytest

from tabkit.operators import neighbours as N
from tabkit.operators import pivots as P


def frame(spark, vectors, labels=None):
    return spark.createDataFrame([(i, [float(x) for x in v], int(i % 3 if labels is None else labels[i])) for i, v in enumerate(vectors)], "id bigint, vec array<double>, label int")


def rows(df):
    return sorted((r["id"], r["rank"], r["label"], round(r["distance"], 9)) for r in df.collect())


@pytest.mark.parametrize("p, k, pivots", [(1, 3, 4), (2, 5, 8), (3, 1, 1)])
def test_same_as_all_distances(spark, monkeypatch, p, k, pivots):
    monkeypatch.setattr(P, "BLOCK_ROWS", 20)
    draw = np.random.default_rng(int(p))
    vectors = np.concatenate([draw.normal(size=(120, 3)), draw.integers(0, 3, (120, 3)).astype(float), np.zeros((30, 3))])
    df = frame(spark, vectors)
    queries = frame(spark, draw.normal(size=(40, 3)) * 2)
    assert rows(P.nearest_by_pivots(df, queries, k, p, pivots=pivots)) == rows(N.nearest(df, queries, k, p))
    assert rows(P.nearest_by_pivots(df, df, k, p, same=True, pivots=pivots)) == rows(N.nearest(df, df, k, p, same=True))


def test_few_blocks_are_visited_where_vectors_lie_in_clusters(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_ROWS", 50)
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(30, 16)) * 10
    vectors = centres[draw.integers(0, 30, 3000)] + draw.normal(size=(3000, 16)) * 0.3
    df, queries = frame(spark, vectors), frame(spark, vectors[:200] + 0.01)
    found = P.nearest_by_pivots(df, queries, 5, pivots=32)
    shares = [r["visited"] for r in found.where("rank = 1").select("visited").collect()]
    print(f"share of blocks visited: {np.mean(shares):.3f}")
    assert len(shares) == 200 and np.mean(shares) < 0.2
    assert rows(found) == rows(N.nearest(df, queries, 5))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    df = frame(spark, [[0, 0], [nan, 1], [inf, 0], [1, 1], [3, 3]])
    queries = frame(spark, [[0, 0.5], [nan, 0], [2, 2]])
    got = P.nearest_by_pivots(df, queries, 4, pivots=2)
    want = {(r["id"], r["rank"]): r["distance"] for r in N.nearest(df, queries, 4).collect()}
    for r in got.collect():
        assert (want[r["id"], r["rank"]] is None and r["distance"] is None) or np.isclose(want[r["id"], r["rank"]], r["distance"])
    assert [r["distance"] for r in got.where("id = 1").collect()] == [None] * 4  # NaN comes last, as NULL
    assert got.where("id = 0 AND distance IS NOT NULL").count() == 4
    assert got.count() == len(want)
    assert P.nearest_by_pivots(df.limit(0), queries, 2).count() == 0 and P.nearest_by_pivots(df, queries.limit(0), 2).count() == 0
    with pytest.raises(ValueError):
        P.nearest_by_pivots(df, queries, 1, 0.5)
