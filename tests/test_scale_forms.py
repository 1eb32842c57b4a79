"""The forms made for large tables, forced on small ones and compared with brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.operators import features as E
from tabkit.operators import joins as J
from tabkit.operators import metrics as X
from tabkit.operators import neighbours as N
from tabkit.operators import quantiles as Q
from tabkit.operators import splits as P
from tabkit.operators import stats as S
from tabkit.operators import validity as V

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


def skewed(n, seed):
    rnd = random.Random(seed)
    return [42.0 if i % 3 == 0 else rnd.choice([rnd.gauss(0, 1), rnd.expovariate(1e-6), float(rnd.randint(0, 9))]) for i in range(n)]


@pytest.mark.parametrize("accuracy, at_once", [(50, 100), (200, 10), (10_000, 2_000_000)])
def test_quantiles(spark, monkeypatch, accuracy, at_once):
    monkeypatch.setattr(Q, "ACCURACY", accuracy)
    monkeypatch.setattr(Q, "SORTED_AT_ONCE", at_once)
    a, b = skewed(5000, 1), [float(i) for i in range(5000)]
    df = spark.createDataFrame([(x, y, None if i % 4 else x, None) for i, (x, y) in enumerate(zip(a, b))],
                               "a double, b double, c double, d double")
    got = Q.exact_quantiles(df, ["a", "b", "c", "d"], PROBS)
    for name, data in (("a", a), ("b", b), ("c", a[::4])):
        assert got[name] == pytest.approx(list(np.quantile(data, PROBS)), rel=1e-12, abs=1e-12)
    assert got["d"] == [None] * len(PROBS)


@pytest.mark.parametrize("per_slice", [7, 100, 10 ** 6])
def test_auc(spark, monkeypatch, per_slice):
    monkeypatch.setattr(X, "SCORES_PER_SLICE", per_slice)
    rnd = random.Random(3)
    rows = [(rnd.random() < 0.3, s) for s in skewed(600, 2)]
    rows = [(int(y), round(s + 0.5 * y, 1)) for y, s in rows]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "y int, s double")
    assert X.auc_roc(df, "y", "s").first()[0] == pytest.approx(want)
    assert X.auc_roc(df.withColumn("s", -F.col("s")), "y", "s").first()[0] == pytest.approx(1 - want)


@pytest.mark.parametrize("seed, few, levels", [(0, 32, 12), (1, 0, 12), (2, 0, 3), (3, 5, 1)])
def test_band_join(spark, monkeypatch, seed, few, levels):
    monkeypatch.setattr(J, "FEW_BANDS", few)
    monkeypatch.setattr(J, "MOST_LEVELS", levels)
    rnd = random.Random(seed)
    bands = []
    for i in range(60):
        lo = rnd.choice([rnd.uniform(-50, 50), rnd.uniform(-1e6, 1e6), 5.0])
        hi = rnd.choice([None, lo, lo + rnd.uniform(0, 3), lo + 4.0, lo + 1e-300, lo + rnd.uniform(0, 1e5), lo - 1.0, float("inf"), 1e308])
        bands.append((rnd.randint(0, 1), lo, hi, i))
    bands += [(0, -float("inf"), -1.5e6, 60), (1, 0.0, 0.0, 61), (0, None, 3.0, 62), (1, -1e308, 1e308, 63)]
    rows = [(i, rnd.randint(0, 1), rnd.choice([5.0, 9.0, 0.0, -0.0, rnd.uniform(-60, 60), rnd.uniform(-2e6, 2e6), None])) for i in range(300)]
    rows += [(300, 0, float("inf")), (301, 1, -float("inf")), (302, 0, float("nan")), (303, 1, 1e308)]
    df = spark.createDataFrame(rows, "id int, g int, x double")
    bd = spark.createDataFrame(bands, "grp int, lo double, hi double, band int")

    def hits(by_group):
        return sorted((i, b) for i, g, x in rows for grp, lo, hi, b in bands
                      if x is not None and lo is not None and x >= lo and (hi is None or x <= hi) and (not by_group or g == grp))

    assert sorted((r["id"], r["band"]) for r in J.join_band(df, bd, "x", "inner").collect()) == hits(False)
    assert sorted((r["id"], r["band"]) for r in J.join_band(df, bd, "x", "inner", ("g", "grp")).collect()) == hits(True)
    for eq in (None, ("g", "grp")):
        found = hits(eq is not None)
        alone = {i for i, _, _ in rows} - {i for i, _ in found}
        left = [(r["id"], r["band"]) for r in J.join_band(df, bd, "x", eq=eq).collect()]
        assert sorted(x for x in left if x[1] is not None) == found and sorted(i for i, b in left if b is None) == sorted(alone)
    with pytest.raises(ValueError):
        J.join_band(df, bd, "x", "full")


def test_a_level_is_as_wide_as_its_bands(spark):
    """At most two intervals to a band, at every scale."""
    rnd = random.Random(4)
    bands = [(lo, lo + rnd.choice([0.0, 1e-9, 1.0, 3.0, 1e7]) * rnd.random()) for lo in (rnd.uniform(-1, 1) * 10.0 ** rnd.randint(-12, 15) for _ in range(500))]
    df = spark.createDataFrame(bands, "lo double, hi double").select("*", J._level(F.col("lo"), F.col("hi")).alias("level"))
    for r in df.collect():
        assert r.hi - r.lo <= 2.0 ** r.level
        assert abs(r.lo / 2.0 ** r.level) < 2**52


@pytest.mark.parametrize("seed", range(4))
def test_overlap_of_neighbours(spark, seed):
    rnd = random.Random(seed)
    for grouped in (False, True):
        n, width = rnd.choice([(40, 60), (40, 3), (8, 900)])
        bands = [(rnd.choice([None, 1, 2]), float(lo), rnd.choice([lo + rnd.random() * width / 40, lo - 1.0, None if rnd.random() < 0.05 else float(lo)])) for lo in rnd.sample(range(1000), n)]
        own = [(g if grouped else 0, lo, float("inf") if hi is None else hi) for g, lo, hi in bands if (not grouped or g is not None) and (hi is None or hi >= lo)]
        want = any(a[0] == b[0] and a[1] <= b[2] and b[1] <= a[2] for i, a in enumerate(own) for b in own[:i])
        df = spark.createDataFrame(bands, "g int, lo double, hi double").repartition(3)
        assert J.bands_overlap(df, "g" if grouped else None) == want


@pytest.mark.parametrize("p, weights, block", [(1, "distance", 20), (2, "uniform", 33), (2, "distance", 1000)])
def test_neighbours(spark, monkeypatch, p, weights, block):
    monkeypatch.setattr(N, "BLOCK_ROWS", block)
    rnd = np.random.default_rng(5)
    vecs = rnd.integers(0, 4, (150, 3)).astype(float)
    vecs[:50] = vecs[0]
    labels = rnd.integers(0, 3, 150)
    rows = [(i, vecs[i].tolist(), int(labels[i])) for i in range(150)]
    df = spark.createDataFrame(rows, "id bigint, vec array<double>, label int")
    classified = N.knn_classify(df, df, 5, p, weights, same=True)
    assert classified.count() == 150  # the same frame on both sides, no column used
    got = {r["id"]: r["prediction"] for r in classified.collect()}
    for i in range(150):
        far = np.abs(vecs - vecs[i]).sum(1) if p == 1 else np.sqrt(((vecs - vecs[i]) ** 2).sum(1))
        near = sorted((far[j], j) for j in range(150) if j != i)[:5]
        votes = {}
        exact = any(d == 0 for d, _ in near)
        for d, j in near:
            w = 1.0 if weights == "uniform" else float(d == 0) if exact else 1 / d
            votes[labels[j]] = votes.get(labels[j], 0.0) + w
        assert got[i] == min(votes, key=lambda label: (-round(votes[label], 9), label))


@pytest.mark.parametrize("per_slice", [5, 100_000])
def test_stratified_split(spark, monkeypatch, per_slice):
    monkeypatch.setattr(P, "slices_for", lambda rows: rows // per_slice + 1)
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 3 > 0 THEN 'hot' WHEN id = 0 THEN NULL WHEN id % 2 = 0 THEN 'b' ELSE 'c' END AS y")
    train, test = P.split_stratified(df, "id", "y", 0.9)
    assert train.count() + test.count() == 1000 and train.intersect(test).count() == 0
    sizes = {r["y"]: r["count"] for r in df.groupBy("y").count().collect()}
    taken = {r["y"]: r["count"] for r in train.groupBy("y").count().collect()}
    assert taken == {y: int(n * 0.9 + 0.5) for y, n in sizes.items() if y is not None} | {None: 1}
    assert P.split_stratified(df, "id", "y", 0.0)[0].count() == 0


def test_codes_over_several_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(500).selectExpr("concat('v', id * 7 % 400) AS c")
        got = {r["c"]: r["c_encoded"] for r in E.label_encode(df, ["c"]).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {v: i for i, v in enumerate(sorted(got))}


def test_hot_key(spark):
    df = spark.range(9000).selectExpr("IF(id % 3 > 0, -1, id) AS k", "9000 - id AS o", "id AS v")
    first = V.dedup_first(df, ["k"], ["o"])
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()
    assert first.count() == 3001 and first.filter("k = -1").first()["v"] == 8999


def test_describe_of_one_row_and_none(spark):
    df = spark.createDataFrame([(3.0, None)], "a double, b double")
    rows = {r["column_name"]: r for r in S.describe(df, ["a", "b"]).collect()}
    assert rows["a"]["p50"] == 3.0 and rows["a"]["std"] is None and rows["b"]["count"] == 0 and rows["b"]["p50"] is None


def test_scaled_values_lie_between_zero_and_one(spark):
    df = spark.createDataFrame([(v,) for v in skewed(300, 9)], "x double")
    lo, hi = E.apply_minmax(df, E.fit_minmax(df, ["x"])).agg(F.min("x"), F.max("x")).first()
    assert lo == 0.0 and hi == pytest.approx(1.0)


def test_bucketed_tables_are_joined_where_they_lie(spark):
    from tabkit.runtime import scratch_path
    from tabkit.sources.writers import write_bucketed
    left = spark.range(1000).select("id", (F.col("id") % 7).alias("a"))
    right = spark.range(500, 1500).select("id", (F.col("id") % 5).alias("b"))
    for name, df in (("bucketed_left", left), ("bucketed_right", right)):
        write_bucketed(df, name, scratch_path(spark, name), ["id"], 6)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = J.join_by_row_key(spark.table("bucketed_left"), spark.table("bucketed_right"), "id")
        counted = joined.groupBy("id").count()
        assert joined.count() == 500 and counted.count() == 500
        for df in (joined, counted):
            df.collect()
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    write_bucketed(left.limit(3), "bucketed_left", scratch_path(spark, "again"), ["id"], 2, sort=False)
    assert spark.table("bucketed_left").count() == 3
    for name in ("bucketed_left", "bucketed_right"):
        spark.sql(f"DROP TABLE {name}")
    with pytest.raises(ValueError):
        write_bucketed(left, "bucketed_left", scratch_path(spark, "none"), ["id"], 0)
