"""Training, cross-validation and comparison of Spark ML classifiers."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from statistics import NormalDist, pstdev
from threading import Lock

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassificationModel, GBTClassifier, LinearSVC, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.columns import ref, replace_columns
from tabkit.functions.draws import fold_by_key, normal_of, repeated_with_draws
from tabkit.operators import metrics as X
from tabkit.operators.neighbours import knn_classify
from tabkit.operators.splits import stratified_folds
from tabkit.runtime import scratch, spread

SEED = 42
FOLD = "_fold"
DRAWS = 32_000_000  # numbers of 4 bytes that a forest keeps at a time; the nodes that rows have reached take up to three times as many
SEEDS_APART = 1_000_003  # Spark adds the number of the partition to the seed of a forest
LEADERBOARD = "place int, model string, metric string, value double, seconds double, params string"


class _Fits:
    """The models of a grid, in the order of their limits of iterations, for several threads at once."""

    def __init__(self, estimator: Estimator, dataset: DataFrame, points: Sequence[dict]):
        self.estimator, self.dataset, self.points = estimator, dataset, points
        self.limits = [estimator.copy(point).getMaxIter() for point in points]
        others = [{p: v for p, v in point.items() if p.name != "maxIter"} for point in points]
        self.group = [others.index(x) for x in others]  # points that differ in the limit alone
        self.order, self.lock = iter(self._in_order()), Lock()
        self.fitted, self.waits = {g: [] for g in self.group}, {g: Lock() for g in self.group}

    def _in_order(self) -> list[int]:
        return sorted(range(len(self.points)), key=self.limits.__getitem__)

    def _known(self, i: int, fitted: list[tuple[int, Model]]) -> Model | None:
        """The model of a point by those that its group has so far."""
        return next((m for limit, m in fitted if m.summary.totalIterations < limit), None)

    def __iter__(self) -> Iterator[tuple[int, Model]]:
        return self

    def __next__(self) -> tuple[int, Model]:
        with self.lock:
            i = next(self.order)
        with self.waits[self.group[i]]:
            known = self.fitted[self.group[i]]
            model = self._known(i, known)
            if model is None:
                model = self.estimator.fit(self.dataset, self.points[i])
                known.append((self.limits[i], model))
        return i, model


class _Boosts(_Fits):
    """Boosted trees of a grid, the longest first: shorter ones of the same settings are its first trees."""

    def _in_order(self) -> list[int]:
        return super()._in_order()[::-1]

    def _known(self, i: int, fitted: list[tuple[int, Model]]) -> Model | None:
        return first_trees(fitted[0][1], self.estimator.copy(self.points[i])) if fitted else None


class LimitedLogisticRegression(LogisticRegression):
    """Logistic regression that does not fit again under a higher limit of iterations what stopped below a lower one.

    A limit changes nothing before it is reached: a fit that ended by its tolerance has the coefficients of any higher limit.
    """

    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence[dict]) -> Iterator[tuple[int, Model]]:
        return _Fits(self, dataset, paramMaps)


def _java_trees(spark: SparkSession, kind: str, trees: Sequence):
    """Trees of the JVM as an array of their class."""
    found = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.spark.ml, kind), len(trees))
    for i, tree in enumerate(trees):
        found[i] = tree
    return found


def _modelled(estimator: Estimator, java_model) -> Model:
    """A model that was put together in the JVM, with the estimator's settings."""
    model = estimator._copyValues(estimator._create_model(java_model))
    model._transfer_params_to_java()
    return model


def first_trees(model: GBTClassificationModel, estimator: GBTClassifier) -> GBTClassificationModel:
    """The model that the estimator would fit with fewer iterations than the given one had: the first of its trees.

    A boosted tree depends on the trees before it and on the seed plus its own number, not on the number of trees to come.
    """
    n, java, spark = estimator.getMaxIter(), model._java_obj, SparkSession.active()
    weights = spark.sparkContext._gateway.new_array(spark._jvm.double, n)
    for i, weight in enumerate(model.treeWeights[:n]):
        weights[i] = weight
    trees = _java_trees(spark, "regression.DecisionTreeRegressionModel", list(java.trees())[:n])
    short = spark._jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), trees, weights, java.numFeatures(), java.numClasses())
    return _modelled(estimator, java.copyValues(short, spark._jvm.org.apache.spark.ml.param.ParamMap()))


class SharedGBTClassifier(GBTClassifier):
    """Boosted trees that are fitted once for all numbers of iterations of a grid, by the highest one.

    With a validation column the number of trees depends on their errors; then every point is fitted by itself.
    """

    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence[dict]) -> Iterator[tuple[int, Model]]:
        if any(self.copy(point).isDefined("validationIndicatorCol") for point in paramMaps):
            return super().fitMultiple(dataset, paramMaps)
        return _Boosts(self, dataset, paramMaps)


class BatchedForestClassifier(RandomForestClassifier):
    """Random forest whose trees are fitted in batches, so that the draws it keeps do not grow with rows times trees.

    Spark stores the weights that each row has in all trees of a fit: 1,000 trees on 600,000 rows are 2.4 GB. Trees are independent of
    each other, so batches with seeds of their own are one forest. A forest within ``DRAWS`` is Spark's own, tree by tree. The node that
    a row has reached is stored, not found again from the root for each level; so the grown trees do not travel with every task.
    """

    def _fit(self, dataset: DataFrame) -> Model:
        trees = self.getNumTrees()
        most = max(2, DRAWS // max(dataset.count(), 1)) if trees > 2 else trees
        if trees <= most:
            return RandomForestClassifier._fit(self.copy({self.cacheNodeIds: True}), dataset)
        batches = -(-trees // most)
        settings = {self.featureSubsetStrategy: "sqrt"} if self.getFeatureSubsetStrategy() == "auto" else {}  # as of more than one tree
        found, spark = [], dataset.sparkSession
        for i in range(batches):
            here = trees * (i + 1) // batches - trees * i // batches
            part = self.copy({**settings, self.numTrees: here, self.cacheNodeIds: True, self.seed: self.getSeed() + i * SEEDS_APART})
            found.append(RandomForestClassifier._fit(part, dataset))
        first = found[0]._java_obj
        whole = spark._jvm.org.apache.spark.ml.classification.RandomForestClassificationModel(
            first.uid(), _java_trees(spark, "classification.DecisionTreeClassificationModel", [t for m in found for t in m._java_obj.trees()]),
            first.numFeatures(), max(m._java_obj.numClasses() for m in found))
        return _modelled(self, first.copyValues(whole, spark._jvm.org.apache.spark.ml.param.ParamMap()))


CLASSIFIERS: dict[str, Callable] = {
    "logreg": LimitedLogisticRegression,
    "random_forest": BatchedForestClassifier,
    "gbt": SharedGBTClassifier,
    "decision_tree": DecisionTreeClassifier,
    "linear_svc": LinearSVC,
}

# The parameter grids compared for each kind of model.
GRIDS: dict[str, dict[str, list]] = {
    "random_forest": {"maxDepth": [4, 8], "numTrees": [10, 100, 1000], "maxBins": [10, 50],
                      "featureSubsetStrategy": ["sqrt", "log2"]},
    "logreg": {"maxIter": [20, 40], "regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5], "tol": [1e-6, 1e-4]},
    "gbt": {"maxDepth": [4, 8], "maxIter": [20, 40], "maxBins": [20, 40], "stepSize": [0.1, 0.01]},
    "decision_tree": {"maxDepth": [4, 8], "maxBins": [20, 40], "minInfoGain": [0.0, 0.1],
                      "minInstancesPerNode": [1, 10, 20]},
    "linear_svc": {"maxIter": [20, 40], "regParam": [0.01, 0.1], "tol": [1e-6, 1e-4]},
}

# The depths and sizes of forests compared on their own.
FOREST_GRID: dict[str, list] = {"maxDepth": [2, 4, 6, 8, 10], "numTrees": [10, 100, 1000]}

# Of a training and a test frame, the test frame with predictions.
Scorer = Callable[[DataFrame, DataFrame], DataFrame]


def make_pipeline(kind: str, cols: Sequence[str], label: str, before: Sequence = (), **params) -> Pipeline:
    """Preparing stages, vector assembly and one classifier."""
    model = CLASSIFIERS[kind](labelCol=label, featuresCol="features", **params)
    if model.hasParam("seed"):
        model.set(model.getParam("seed"), SEED)
    return Pipeline(stages=[*before, VectorAssembler(inputCols=list(cols), outputCol="features"), model])


class ExactAuc(BinaryClassificationEvaluator):
    """Exact area under the ROC curve by ``metrics.auc_roc``: scores are counted and ranked as columns, in slices, not as objects of an RDD.

    As of the evaluator that it stands for, the area is 0 without positive rows, 1 without negative ones and 0.5 without any. What it stores
    is deleted at its end.
    """

    def _evaluate(self, dataset: DataFrame) -> float:
        score, spark = self.getRawPredictionCol(), dataset.sparkSession
        found = vector_to_array(ref(score))[1] if isinstance(dataset.schema[score].dataType, VectorUDT) else ref(score)
        rows = dataset.select(found.alias("s"), (ref(self.getLabelCol()) > 0.5).cast("int").alias("y")).persist()  # the model scores a row once
        try:
            with scratch(spark):
                area = X.auc_roc(rows, "y", "s").first()["auc"]
            if area is None:
                area = rows.agg(F.coalesce(F.max("y").cast("double"), F.lit(0.5))).first()[0]
        finally:
            rows.unpersist()
        return area


def evaluator(metric: str, label: str, score: str = "rawPrediction"):
    """Area under the ROC curve of a score column ("auc") or share of right predictions ("accuracy")."""
    if metric == "auc":
        return ExactAuc(labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=0)  # 0: exact
    return MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")


def score_column(classifier) -> str:
    """The probability where a model gives one: the raw prediction of a single tree is a row count, not a score."""
    return "probability" if classifier.hasParam("probabilityCol") else "rawPrediction"


def param_grid(pipeline: Pipeline, grid: dict[str, list]) -> list:
    classifier = pipeline.getStages()[-1]
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(classifier.getParam(name), values)
    return builder.build()


class FoldedCrossValidator(CrossValidator):
    """Cross-validator that takes its folds from the fold column by plain filters, without a Python check per row.

    The stages before the classifier are fitted once per fold, on its training rows alone, and once on all rows for the winner, not again
    for every point of a grid that varies the classifier only. Folds keep the label and the features.
    """

    def _pairs(self, dataset: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
        fold = F.col(self.getFoldCol())
        return [(dataset.filter(fold != i), dataset.filter(fold == i)) for i in range(self.getNumFolds())]

    def _kFold(self, dataset: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
        if self._before is None:
            return self._pairs(dataset)
        prepared = [(train, test, self._before.fit(train)) for train, test in self._pairs(self._raw)]
        classifier = self.getEstimator()
        cols = [classifier.getLabelCol(), classifier.getFeaturesCol()]
        return [tuple(model.transform(part).select(*cols) for part in (train, test)) for train, test, model in prepared]

    _before = _raw = None

    def _fit(self, dataset: DataFrame) -> CrossValidatorModel:
        pipeline = self.getEstimator()
        stages = pipeline.getStages() if isinstance(pipeline, Pipeline) else []
        if len(stages) < 2 or any(p.parent != stages[-1].uid for point in self.getEstimatorParamMaps() for p in point):
            return super()._fit(dataset)
        inner = self.copy()
        inner.setEstimator(stages[-1])
        inner._before, inner._raw = Pipeline(stages=stages[:-1]), dataset
        whole = inner._before.fit(dataset)
        found = super(FoldedCrossValidator, inner)._fit(whole.transform(dataset))
        best = PipelineModel([*whole.stages, found.bestModel])
        return self._copyValues(CrossValidatorModel(best, avgMetrics=found.avgMetrics, subModels=found.subModels, stdMetrics=found.stdMetrics))


def with_folds(df: DataFrame, key: str, folds: int = 5, stratify: str | None = None) -> DataFrame:
    """Add the fold number of every row, fixed by its key; with ``stratify`` every fold has its share of each label to a row."""
    if stratify is not None:
        return stratified_folds(df, key, stratify, folds, FOLD)
    return df.withColumn(FOLD, fold_by_key(ref(key), folds))


def grid_search(pipeline: Pipeline, grid: dict[str, list], label: str, folds: int = 5, metric: str = "auc",
                parallelism: int = 4) -> CrossValidator:
    """Estimator that picks the best parameters over the folds of ``with_folds``."""
    return FoldedCrossValidator(estimator=pipeline, estimatorParamMaps=param_grid(pipeline, grid), numFolds=folds,
                                evaluator=evaluator(metric, label, score_column(pipeline.getStages()[-1])), foldCol=FOLD, parallelism=parallelism, seed=SEED)


def best_params(fitted: CrossValidatorModel) -> tuple[float, dict]:
    """Cross-validated score of the winning parameters, and the parameters by name."""
    best = max(range(len(fitted.avgMetrics)), key=fitted.avgMetrics.__getitem__)
    return float(fitted.avgMetrics[best]), {p.name: v for p, v in fitted.getEstimatorParamMaps()[best].items()}


def cross_validate(df: DataFrame, pipeline: Pipeline, grid: dict[str, list], label: str, key: str, folds: int = 5,
                   metric: str = "auc", stratify: bool = False) -> tuple[CrossValidatorModel, float, dict]:
    """Grid search over keyed folds, with ``stratify`` dealt evenly by label: the fitted model, its score and its parameters."""
    folded = spread(with_folds(df, key, folds, label if stratify else None)).persist()
    fitted = grid_search(pipeline, grid, label, folds, metric).fit(folded)
    folded.unpersist()
    return fitted, *best_params(fitted)


def knn_scorer(cols: Sequence[str], label: str, key: str, k: int = 5, p: float = 2, weights: str = "uniform") -> Scorer:
    """Nearest neighbours as a contestant: the test rows with the vote of their neighbours among the training rows."""
    def vectors(df: DataFrame) -> DataFrame:
        return df.select(ref(key), F.array(*[ref(c).cast("double") for c in cols]).alias("_vec"), ref(label))

    def score(train: DataFrame, test: DataFrame) -> DataFrame:
        votes = knn_classify(vectors(train), vectors(test), k, p, weights, key, "_vec", label)
        return test.join(votes.select(F.col("id").alias("_key"), F.col("prediction").cast("double").alias("prediction")), ref(key) == F.col("_key")).drop("_key")

    return score


def _scored(contestant: Estimator | Scorer, train: DataFrame, test: DataFrame) -> tuple[DataFrame, dict]:
    """The test rows with predictions, and the parameters that a grid search chose."""
    if not hasattr(contestant, "fit"):
        return contestant(train, test), {}
    fitted = contestant.fit(train)
    return fitted.transform(test), best_params(fitted)[1] if isinstance(fitted, CrossValidatorModel) else {}


def oof_predictions(df: DataFrame, contestant: Estimator | Scorer, key: str, folds: int = 5, stratify: str | None = None) -> DataFrame:
    """Prediction of every row by a model that has not seen its fold; ``stratify`` names a label to deal evenly to the folds.
    Persist or settle ``df`` first: every fold reads it."""
    folded = with_folds(df, key, folds, stratify)
    parts = []
    for fold in range(folds):
        parts.append(_scored(contestant, folded.filter(F.col(FOLD) != fold), folded.filter(F.col(FOLD) == fold))[0])
    return reduce(DataFrame.unionByName, parts)


def leaderboard(train: DataFrame, test: DataFrame, contestants: dict[str, Estimator | Scorer], label: str,
                metrics: Sequence[str] = ("auc",)) -> DataFrame:
    """Fit every contestant, score all on the same test rows by the same metrics, and record the seconds taken.

    A contestant without a score of its own is ranked by its prediction.
    """
    train, test = train.persist(), test.persist()
    rows = []
    for place, (name, contestant) in enumerate(contestants.items()):
        started = time.time()
        scored, params = _scored(contestant, train, test)
        score = next(c for c in ("probability", "rawPrediction", "prediction") if c in scored.columns)
        values = {metric: evaluator(metric, label, score).evaluate(scored) for metric in metrics}
        seconds = time.time() - started
        rows += [(place, name, metric, value, seconds, str(params)) for metric, value in values.items()]
    train.unpersist()
    test.unpersist()
    return train.sparkSession.createDataFrame(rows, LEADERBOARD)


def _trial_scores(model: PipelineModel, df: DataFrame, cols: Sequence[str], label: str, key: str, std: float, first: int, last: int) -> DataFrame:
    """Accuracy of the trials ``first`` to ``last``. Rows are spread over all cores before they are repeated, by their key, so a table
    in few files does not leave the trials to few tasks; repeated rows are never shuffled. The draws of all columns are made batch by batch."""
    dealt = df.repartition(df.sparkSession.sparkContext.defaultParallelism, ref(key))
    drawn = repeated_with_draws(dealt, ref(key), cols, first, last)
    noise = {c: ref(c) + normal_of(F.col(f"_a{i}"), F.col(f"_b{i}"), std) for i, c in enumerate(cols)}
    noisy = replace_columns(drawn, noise).withColumnRenamed("_number", "trial").drop(*[f"_{part}{i}" for i in range(len(cols)) for part in "ab"])
    right = (F.col("prediction") == ref(label)).cast("double")
    return model.transform(noisy).groupBy("trial").agg(F.avg(right).alias("accuracy"))


def perturbation_scores(model: PipelineModel, df: DataFrame, cols: Sequence[str], label: str, key: str,
                        std: float = 1.2, trials: int = 50) -> DataFrame:
    """Accuracy under Gaussian noise on all features, one row per trial; all trials run in one job."""
    return _trial_scores(model, df, cols, label, key, std, 1, trials)


def perturbation_until(model: PipelineModel, df: DataFrame, cols: Sequence[str], label: str, key: str, width: float,
                       std: float = 1.2, level: float = 0.95, batch: int = 10, most: int = 200) -> DataFrame:
    """One row per trial as ``perturbation_scores`` gives it, for as many batches of trials as it takes until the interval of the
    mean accuracy is no wider than ``width``, and no more than ``most`` trials.

    A batch is one job; the driver sees one number per trial. An empty table ends after its first batch, without rows.
    """
    if batch < 2 or width <= 0:
        raise ValueError("a batch has two trials or more, and the width is above zero")
    z, done = NormalDist().inv_cdf(0.5 + level / 2.0), []
    while len(done) < most:
        found = _trial_scores(model, df, cols, label, key, std, len(done) + 1, min(len(done) + batch, most)).collect()
        done += sorted((r["trial"], r["accuracy"]) for r in found)
        scores = [a for _, a in done if a is not None]
        if len(scores) < len(done) or not scores or 2 * z * pstdev(scores) / math.sqrt(len(scores)) <= width:
            break
    return df.sparkSession.createDataFrame(done, "trial int, accuracy double")
