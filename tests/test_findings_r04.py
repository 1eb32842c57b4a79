"""What the review of round 4 found: whole grids, and fits that are shared or batched without a change of the outcome."""

import pytest

from tabkit.catalog import flagships
from tabkit.operators import models as L
from tabkit.plans import records

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(float(i % 17), float(i * 7 % 23), float(i * i % 11), float((i % 17 + i * 7 % 23 + i % 5) > 20)) for i in range(600)]
    return spark.createDataFrame(data, "a double, b double, c double, label double").repartition(3).persist()


def assembled(rows):
    return L.make_pipeline("gbt", COLS, "label").getStages()[0].transform(rows).select("label", "features")


def test_clean_and_model_searches_whole_grids(spark, small, monkeypatch):
    """every published point of all four kinds over five folds, not the first corner of two of them."""
    seen = {}

    def leaderboard(train, test, contestants, label):
        seen.update(contestants)
        return spark.createDataFrame([], L.LEADERBOARD)

    monkeypatch.setattr(records.L, "leaderboard", leaderboard)
    flagships.clean_and_model(spark, small)
    points = {kind: {frozenset((p.name, v) for p, v in point.items()) for point in search.getEstimatorParamMaps()} for kind, search in seen.items()}
    assert {kind: len(found) for kind, found in points.items()} == {"random_forest": 24, "logreg": 16, "gbt": 16, "decision_tree": 24}
    assert {("numTrees", 1000), ("maxDepth", 8), ("maxBins", 50)} <= set().union(*points["random_forest"])
    assert {("maxIter", 40), ("maxDepth", 8), ("stepSize", 0.01)} <= set().union(*points["gbt"])
    assert all(search.getNumFolds() == 5 for search in seen.values())


def test_boosted_trees_are_fitted_once_for_all_limits(spark, rows, monkeypatch):
    """the shorter model is the first trees of the longer one, tree by tree as fitted by itself."""
    data, fits = assembled(rows), []
    pipeline = L.make_pipeline("gbt", COLS, "label", maxDepth=2)
    gbt, fit = pipeline.getStages()[-1], L.GBTClassifier._fit
    monkeypatch.setattr(L.GBTClassifier, "_fit", lambda self, dataset: fits.append(self.getMaxIter()) or fit(self, dataset))
    points = L.param_grid(pipeline, {"maxIter": [3, 6], "stepSize": [0.1, 0.5]})
    found = dict(gbt.fitMultiple(data, points))
    assert sorted(fits) == [6, 6] and sorted(found) == [0, 1, 2, 3]
    for i, point in enumerate(points):
        alone = L.GBTClassifier(labelCol="label", seed=L.SEED, maxDepth=2, **{p.name: v for p, v in point.items()}).fit(data)
        assert found[i].getMaxIter() == point[gbt.maxIter] == found[i].getNumTrees
        assert found[i].treeWeights == alone.treeWeights
        assert [t.toDebugString.split("\n", 1)[1] for t in found[i].trees] == [t.toDebugString.split("\n", 1)[1] for t in alone.trees]
        scores = [m.transform(data).select("probability").collect() for m in (found[i], alone)]
        assert scores[0] == scores[1]


def test_boosted_trees_with_validation_rows_are_fitted_alone(rows):
    """there the number of trees depends on errors, so a shorter model need not be the beginning of a longer one."""
    pipeline = L.make_pipeline("gbt", COLS, "label", validationIndicatorCol="v")
    gbt = pipeline.getStages()[-1]
    assert not isinstance(gbt.fitMultiple(rows, L.param_grid(pipeline, {"maxIter": [3, 6]})), L._Boosts)


def test_forest_in_batches(rows, monkeypatch):
    """all trees are grown, with draws of their own, while no fit keeps more than so many; a forest within the bound is Spark's own."""
    data, fits, fit = assembled(rows), [], L.RandomForestClassifier._fit
    monkeypatch.setattr(L.RandomForestClassifier, "_fit", lambda self, dataset: fits.append(self.getNumTrees()) or fit(self, dataset))

    def forest(**params):
        return L.make_pipeline("random_forest", COLS, "label", **params).getStages()[-1]

    whole = forest(numTrees=10).fit(data)
    plain = L.RandomForestClassifier(labelCol="label", numTrees=10, seed=L.SEED).fit(data)
    assert whole.toDebugString.split("\n", 1)[1] == plain.toDebugString.split("\n", 1)[1]
    fits.clear()
    monkeypatch.setattr(L, "DRAWS", 4 * 600)
    batched = forest(numTrees=10, maxDepth=3).fit(data)
    assert len(fits) == 3 and sum(fits) == 10 and max(fits) <= 4
    assert batched.getNumTrees == 10 and len(batched.trees) == 10 and batched.getMaxDepth() == 3
    assert len({t.toDebugString.split("\n", 1)[1] for t in batched.trees}) == 10
    scored = batched.transform(data)
    assert L.evaluator("auc", "label", "probability").evaluate(scored) > 0.9
    raw = scored.first()["rawPrediction"]
    assert sum(raw) == pytest.approx(10)
