"""What the third review of the larger tables found."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry
from tabkit.functions import draws as D
from tabkit.operators import html as H
from tabkit.operators import joins as J
from tabkit.operators import metrics as X
from tabkit.operators import models as L
from tabkit.operators import neighbours as N
from tabkit.operators import pivots as P
from tabkit.runtime import spread

QUERIES = entry.queries()


def orders(spark, folder, custs):
    """A table of orders with the given customers, alone in a folder."""
    rows = [(i, c, "O", 1000.0 * i, "1-URGENT") for i, c in enumerate(custs)]
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_sparse_vectors_are_not_read_as_long_arrays(spark, tmp_path):
    found = QUERIES["one_hot_sparse"](spark, orders(spark, tmp_path, [30, 10, None, 20, 10]))
    assert "vector_to_array" not in found._jdf.queryExecution().analyzed().toString()
    assert "UDF(cust_vector" not in found._jdf.queryExecution().analyzed().toString()
    got = {r["id"]: tuple(r)[1:] for r in found.collect()}
    assert got == {0: (30, 2.0, 1.0, 3), 1: (10, 0.0, 1.0, 3), 2: (None, -1.0, 0.0, 3), 3: (20, 1.0, 1.0, 3), 4: (10, 0.0, 1.0, 3)}


def block(kind, vectors):
    columns = {f"{kind}_id": np.arange(len(vectors)), f"{kind}_vec": list(vectors)}
    return pd.DataFrame({**columns, "b_label": np.arange(len(vectors)) % 7} if kind == "b" else columns)


@pytest.mark.parametrize("p", [1, 2, 3, 2.5])
@pytest.mark.parametrize("same", [False, True])
def test_rough_distances_choose_the_exact_neighbours(p, same):
    """Ties, copies, an offset, values without a distance and values of very different size, against all distances."""
    draw = np.random.default_rng(5)
    plain = draw.normal(size=(400, 6))
    odd, wide = plain.copy(), plain.copy()
    odd[::50], odd[1::90], odd[2::70], wide[3], wide[9] = np.nan, np.inf, -np.inf, 1e200, 1e30
    for vectors in (plain, np.round(plain), plain + 1e6, plain * 1e-30, np.zeros((400, 6)), odd, wide):
        with np.errstate(all="ignore"):
            got = N.block_search(5, p, same)(block("q", vectors), block("b", vectors))
            far = N.distance_function(p)(vectors, vectors)
        for i, found in got.groupby("id"):
            first = np.argsort(far[i], kind="stable")[:5 + same]
            first = first[first != i] if same else first
            assert found["base_id"].tolist() == first.tolist()
            np.testing.assert_allclose(found["distance"], far[i][first], rtol=1e-12)
        assert got["id"].nunique() == 400


@pytest.mark.parametrize("p", [1, 2])
def test_few_pairs_are_measured_exactly(monkeypatch, p):
    measured = []
    function = N.distance_function

    def counting(p):
        return lambda a, b: measured.append(len(a) * len(b)) or function(p)(a, b)

    monkeypatch.setattr(N, "distance_function", counting)
    vectors = np.random.default_rng(6).normal(size=(1000, 16))
    N.block_search(5, p, True)(block("q", vectors), block("b", vectors))
    assert sum(measured) < 100_000


def test_a_vector_is_sent_a_bounded_number_of_times(spark):
    """20,000 vectors were cut into 20 blocks, and each was sent 20 times on either side."""
    df = spark.range(20_000).selectExpr("id", "array(CAST(id AS DOUBLE), 0.0D) AS vec", "id % 3 AS label")
    sent = N.nearest(df, df, 1).where("rank < 0")._jdf.queryExecution().analyzed().toString()
    assert sent.count("sequence(0, (8 - 1)") + sent.count("sequence(0, 7") == 2


class Direct:
    """A frame whose tasks are called here."""

    schema = T.StructType([T.StructField("q_id", T.LongType()), T.StructField("vec", T.ArrayType(T.DoubleType()))])

    def mapInPandas(self, task, schema):
        return task


def test_a_task_hands_over_visits_in_pieces():
    vectors = np.random.default_rng(7).normal(size=(3000, 64))
    queries = pd.DataFrame({"q_id": np.arange(3000), "vec": list(vectors), "block": np.arange(3000) % 300, "bound": np.inf})
    blocks = pd.DataFrame({"block": np.arange(300), "cell": np.arange(300) % 8, "low": 0.0, "high": 1.0})
    pieces = [(len(x), set(zip(x["q_id"], x["block"]))) for x in P.visits(Direct(), blocks, vectors[:8], 2)(iter([queries]))]
    assert max(n for n, _ in pieces) * 64 <= 2**20
    assert set().union(*(x for _, x in pieces)) == {(q, b) for q in range(3000) for b in range(300) if b != q % 300}
    assert sum(n for n, _ in pieces) == 3000 * 299


def test_the_same_pages_are_uneven(spark):
    """As by the pattern of before, on texts put together at random."""
    rnd = random.Random(8)
    parts = ["<", ">", "</", "<!--", "-->", "a", " ", "\n", "<script", "<STYLE>", "<scripts", "<td>", "x" * 30, "!--", "é"]
    df = spark.createDataFrame([("".join(rnd.choices(parts, k=rnd.randint(0, 7))),) for _ in range(20_000)], "html string")
    before = F.col("html").rlike(r"(?is)<[^>]*<|<!--|<(?:script|style)\b")
    same = df.groupBy(F.col("html").rlike(H.UNEVEN).alias("now"), before.alias("before")).count().collect()
    assert sorted((r["now"], r["before"]) for r in same) == [(False, False), (True, True)]


def test_the_area_under_the_curve_is_that_of_all_pairs(spark, monkeypatch):
    """Against all pairs, in slices, with ties, from vectors and numbers; with one class or no row as the evaluator that it stands for."""
    monkeypatch.setattr(X, "SCORES_PER_SLICE", 20)
    draw = random.Random(3)
    rows = [(float(draw.random() < 0.4), draw.randrange(40) / 40) for _ in range(300)]
    df = spark.createDataFrame(rows, "label double, s double").withColumn("v", array_to_vector(F.array(1 - F.col("s"), "s")))
    pairs = [(p, n) for y, p in rows if y for z, n in rows if not z]
    exact = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in pairs) / len(pairs)
    for score in ("s", "v"):
        found = L.evaluator("auc", "label", score)
        assert isinstance(found, L.ExactAuc) and found.isLargerBetter() and found.evaluate(df) == pytest.approx(exact, abs=1e-12)
        for part in ("label = 1", "label = 0", "label = 2"):
            plain = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol=score, numBins=0)
            assert found.evaluate(df.where(part)) == plain.evaluate(df.where(part))


def test_a_higher_limit_of_iterations_is_not_fitted_again_below_a_lower_one(spark, monkeypatch):
    df = spark.range(400).selectExpr("CAST(id % 7 + id % 3 AS DOUBLE) AS x", "CAST(id * 7 % 11 AS DOUBLE) AS z", "CAST((id % 7 + id % 5) > 5 AS DOUBLE) AS label")
    ready = L.make_pipeline("logreg", ["x", "z"], "label").getStages()[0].transform(df).persist()
    model = L.make_pipeline("logreg", ["x", "z"], "label").getStages()[1]
    points = [{model.maxIter: limit, model.tol: tol} for limit in (40, 1, 20) for tol in (1e-6, 1e-2)]
    plain = [LogisticRegression._fit(model.copy(point), ready) for point in points]
    assert plain[0].summary.totalIterations < 20
    fits, fit = [], L.LimitedLogisticRegression._fit
    monkeypatch.setattr(L.LimitedLogisticRegression, "_fit", lambda self, data: fits.append(self.getMaxIter()) or fit(self, data))
    found = dict(model.fitMultiple(ready, points))
    assert sorted(found) == list(range(6)) and sorted(fits) == [1, 1, 20, 20]
    for i, p in enumerate(plain):
        assert np.array_equal(found[i].coefficients.toArray(), p.coefficients.toArray()) and found[i].intercept == p.intercept


def test_stored_rows_in_one_task_are_spread_over_the_cores(spark, tmp_path):
    spark.range(0, 1000, 1, 1).write.parquet(str(tmp_path / "t"))
    one = spark.read.parquet(str(tmp_path / "t"))
    assert one.rdd.getNumPartitions() == 1 and spread(one).rdd.getNumPartitions() == 1
    dealt = spread(one, 300)
    assert min(dealt.groupBy(F.spark_partition_id()).count().toDF("p", "n").toPandas()["n"]) >= 200
    assert sorted(r.id for r in dealt.collect()) == list(range(1000))


@pytest.mark.parametrize("size", [3, 1_000_000])
def test_totals_of_bands_do_not_list_the_hits(spark, monkeypatch, size):
    """Touching, equal, endless, reversed and NaN bands and values, hot values over several slices, against all pairs."""
    monkeypatch.setattr(J, "ROWS_PER_SLICE", size)
    nan, inf = float("nan"), float("inf")
    bands = [(0.0, 5.0, 1), (5.0, 5.0, 2), (5.0, None, None), (4.0, 3.0, 8), (nan, 9.0, 16), (1.0, nan, 32), (None, 3.0, 64), (-inf, inf, 128), (0.0, 5.0, -7), (7.0, 8.0, None)]
    values = [-0.0, 0.0, 5.0, 4.999, 5.001, nan, None, inf, 7.5, -3.0] + [5.0] * 20
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id bigint, value double")
    for kept in (bands, bands[:6], bands[9:], []):
        b = spark.createDataFrame(kept, "lo double, hi double, key int")
        found = J.join_band(df, b, "value", "inner", totals=["key"])
        assert [f.dataType.simpleString() for f in found.schema.fields] == ["bigint", "double", "bigint", "bigint"]
        hits = J.join_band(df, b, "value", "inner").groupBy("id").agg(F.count(F.lit(1)), F.sum("key"))
        assert sorted((r[0], r[2], r[3]) for r in found.collect()) == sorted(map(tuple, hits.collect()))
    for bad in ({"how": "left"}, {"eq": ("id", "key")}, {"totals": ["lo"]}):
        with pytest.raises(ValueError):
            J.join_band(df, b, "value", **({"how": "inner", "totals": ["key"]} | bad))


def test_draws_of_a_batch_are_those_of_single_columns(spark):
    """Keys of all lengths around a block of MD5, without a key, of other alphabets; the noise and the plan of the trials."""
    keys = [None, "", "é", "0", *["x" * n for n in range(1, 70)]] * 3
    df = spark.createDataFrame([(k, float(i)) for i, k in enumerate(keys)], "key string, `x.y` double")
    names = ["total", "a.b", "ü*z"]
    drawn = D.repeated_with_draws(df, F.col("key"), names, 8, 11).persist()
    assert drawn.columns[:3] == ["key", "x.y", "_number"] and drawn.count() == drawn.select("`x.y`", "_number").distinct().count() == 4 * len(keys)
    for i, name in enumerate(names):
        salt = F.concat(F.lit(f"{name}:"), F.col("_number").cast("string"))
        a, b = F.col(f"_a{i}"), F.col(f"_b{i}")
        plain = [D.uniform_by_key(F.col("key"), F.concat(salt, F.lit(part))) for part in "ab"]
        same = (a == plain[0]) & (b == plain[1]) & (D.normal_of(a, b, 1.2) == D.normal_by_key(F.col("key"), 1.2, salt))
        assert drawn.where(same).count() == 4 * len(keys)
    rows = spark.range(40).selectExpr("id", "CAST(id % 2 AS DOUBLE) AS x", "CAST(id % 2 AS DOUBLE) AS label")
    model = L.make_pipeline("decision_tree", ["x"], "label", maxDepth=1).fit(rows)
    plan = L.perturbation_scores(model, rows, ["x"], "label", "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan and "MapInArrow" in plan
