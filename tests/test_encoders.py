"""Fitted encoders and stratified folds."""

from collections import Counter

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tabkit.operators import models as L
from tabkit.operators.encoders import CategoryIndexer, SentinelImputer
from tabkit.operators.splits import stratified_folds

TRAIN = [("b", 3, "x"), ("b", 10, None), ("a", 3, "x"), ("c", None, "y"), ("a", 2, "y"), (None, 2, "y"), ("a", 3, "y")]
TEST = [("a", 10, "x"), ("z", 4, None), (None, None, "q"), ("c", 2, "y")]
SCHEMA = "t string, n bigint, `a.b` string"


def test_indexes_come_from_the_training_rows(spark):
    cols = ["t", "n", "a.b"]
    model = CategoryIndexer(inputCols=cols).fit(spark.createDataFrame(TRAIN, SCHEMA))
    out = model.transform(spark.createDataFrame(TEST, SCHEMA))
    assert out.columns == [*cols, "tIndex", "nIndex", "a.bIndex"]
    assert sorted(tuple(r)[3:] for r in out.collect()) == sorted([(0.0, 2.0, 1.0), (3.0, 3.0, 2.0), (3.0, 3.0, 2.0), (2.0, 1.0, 0.0)])
    by_value = CategoryIndexer(inputCols=["n"], order="value", unknown="null").fit(spark.createDataFrame(TRAIN, SCHEMA))
    assert sorted((r.n or 0, r.nIndex) for r in by_value.transform(spark.createDataFrame(TEST, SCHEMA)).collect() if r.nIndex is not None) == [(2, 0.0), (10, 2.0)]
    again = by_value.transform(by_value.transform(spark.createDataFrame(TEST, SCHEMA)))
    assert again.columns == [*cols, "nIndex"]


def test_imputer_fills_what_the_indexer_did_not_know(spark):
    pipeline = Pipeline(stages=[CategoryIndexer(inputCols=["t", "n"]), SentinelImputer(inputCols=["tIndex", "nIndex"])])
    out = pipeline.fit(spark.createDataFrame(TRAIN, SCHEMA)).transform(spark.createDataFrame(TEST, SCHEMA))
    assert sorted((r.ImputedtIndex, r.ImputednIndex) for r in out.collect()) == [(0.0, 0.0), (0.0, 0.0), (0.0, 2.0), (2.0, 1.0)]
    numbers = spark.createDataFrame([(1.0, -1.0), (1.0, 4.0), (-1.0, 8.0), (None, None)], "a double, b double")
    mean = SentinelImputer(inputCols=["a", "b"], outputCols=["a", "b"], sentinels=[-1.0, -1.0], strategy="mean").fit(numbers)
    assert sorted(map(tuple, mean.transform(numbers).collect())) == [(1.0, 4.0), (1.0, 6.0), (1.0, 6.0), (1.0, 8.0)]
    with pytest.raises(ValueError):
        SentinelImputer(inputCols=["a"]).fit(numbers)


def test_nothing_known(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = Pipeline(stages=[CategoryIndexer(inputCols=["t"]), SentinelImputer(inputCols=["tIndex"])]).fit(empty)
    assert [(r.tIndex, r.ImputedtIndex) for r in model.transform(spark.createDataFrame(TEST, SCHEMA)).collect()] == [(0.0, 0.0)] * 4
    assert model.transform(empty).count() == 0


def test_saved_and_loaded(spark, tmp_path):
    train, test = spark.createDataFrame(TRAIN, SCHEMA), spark.createDataFrame(TEST, SCHEMA)
    pipeline = Pipeline(stages=[CategoryIndexer(inputCols=["t", "n"]), SentinelImputer(inputCols=["tIndex", "nIndex"])])
    pipeline.save(str(tmp_path / "pipeline"))
    model = Pipeline.load(str(tmp_path / "pipeline")).fit(train)
    model.save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    assert loaded.stages[0].uid == model.stages[0].uid
    assert sorted(map(str, loaded.transform(test).collect())) == sorted(map(str, model.transform(test).collect()))


def test_every_fold_learns_from_its_own_rows(spark):
    """A value that only one fold has is unknown to the model which is tested on it."""
    rows = [(i, "rare" if i == 7 else "ab"[i % 2], float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, t string, label double")
    seen = []

    class Watch(CategoryIndexer):
        def _fit(self, dataset):
            model = super()._fit(dataset)
            seen.append((dataset.count(), model.sizes))
            return model

    pipeline = L.make_pipeline("decision_tree", ["tIndex"], "label", [Watch(inputCols=["t"])])
    fitted, score, params = L.cross_validate(df, pipeline, {"maxDepth": [1, 2], "maxBins": [8, 16]}, "label", "id", 3)
    assert len(seen) == 4 and sorted(s for _, s in seen) == [[2], [3], [3], [3]]  # once per fold and once for the winner
    assert 0.9 < score <= 1 and set(params) == {"maxDepth", "maxBins"}
    assert len(fitted.avgMetrics) == 4 and fitted.transform(df).where("prediction = label").count() >= 59


@pytest.mark.parametrize("folds", [1, 2, 5, 7])
def test_folds_deal_every_label_evenly(spark, folds):
    rows = [(i, None if i % 9 == 0 else "abc"[(i * i) % 3], "e") for i in range(503)] + [(1000, "once", "x")]
    df = spark.createDataFrame(rows, "id bigint, label string, _n string")
    out = stratified_folds(df, "id", "label", folds, "fold").collect()
    assert len(out) == len(rows) and {r.fold for r in out} == set(range(folds))
    counts = Counter((r.label, r.fold) for r in out)
    for label in {r.label for r in out}:
        sizes = [counts[label, f] for f in range(folds)]
        assert max(sizes) - min(sizes) <= 1
    again = stratified_folds(df.repartition(7), "id", "label", folds, "fold").collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_folds_refuse_rows_without_a_key(spark):
    df = spark.createDataFrame([(None, "a")], "id bigint, label string")
    with pytest.raises(ValueError):
        stratified_folds(df, "id", "label", 3, "fold")
    assert stratified_folds(df.where(F.lit(False)), "id", "label", 3, "fold").count() == 0
