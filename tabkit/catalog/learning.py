"""Training, cross-validation, neighbours and robustness."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabkit.catalog.registry import query, rounded, table
from tabkit.operators import features as E
from tabkit.operators import metrics as X
from tabkit.operators import missing as M
from tabkit.operators import models as L
from tabkit.operators.encoders import CategoryIndexer, SentinelImputer
from tabkit.operators.neighbours import knn_classify
from tabkit.operators.pivots import nearest_by_pivots
from tabkit.operators.splits import split_by_key
from tabkit.operators.transformers import PairwiseProduct, Square
from tabkit.runtime import settle

FEATURES = ["total", "priority", "lines", "quantity", "discount", "tax"]


def labelled(spark, sf_dir):
    """Orders with totals of their lines, stored for the folds that read it; the label is a large order, blurred by the customer."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("double").alias("lines"), F.sum("l_quantity").alias("quantity"),
        F.avg("l_discount").alias("discount"), F.avg("l_tax").alias("tax"))
    orders = table(spark, sf_dir, "orders")
    large = (F.col("o_totalprice") + F.col("o_custkey") % 10 * 20000 > 340000).cast("double")
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
    return settle(joined.select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("total"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("priority"),
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in FEATURES[2:]], large.alias("label")), "labelled")


def scores(spark, sf_dir, kind, **params):
    train, test = split_by_key(labelled(spark, sf_dir), "id", 0.9)
    contestant = {kind: L.make_pipeline(kind, FEATURES, "label", **params)}
    return L.leaderboard(train, test, contestant, "label", ["auc", "accuracy"]).drop("seconds")


@query("train_logreg")
def train_logreg(spark, sf_dir):
    return scores(spark, sf_dir, "logreg", maxIter=20, regParam=0.01)


@query("train_random_forest")
def train_random_forest(spark, sf_dir):
    return scores(spark, sf_dir, "random_forest", numTrees=10, maxDepth=4)


@query("train_gbt")
def train_gbt(spark, sf_dir):
    return scores(spark, sf_dir, "gbt", maxIter=5, maxDepth=3)


@query("train_decision_tree")
def train_decision_tree(spark, sf_dir):
    return scores(spark, sf_dir, "decision_tree", maxDepth=4)


@query("train_linear_svc")
def train_linear_svc(spark, sf_dir):
    return scores(spark, sf_dir, "linear_svc", maxIter=10, regParam=0.01)


@query("fit_predict")
def fit_predict(spark, sf_dir):
    """Index and fill text, fill numbers, add products and squares, assemble, fit on training rows and predict test rows."""
    customer = table(spark, sf_dir, "customer")
    df = settle(customer.select(
        F.col("c_custkey").alias("id"), (F.col("c_acctbal") > 5000).cast("double").alias("label"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("balance"), F.col("c_nationkey").cast("double").alias("nation")), "customers")
    train, test = split_by_key(df, "id", 0.8)
    numbers = ["Imputedbalance", "Imputednation"]
    products = PairwiseProduct(inputCols=numbers)
    before = [CategoryIndexer(inputCols=["segment"]), SentinelImputer(inputCols=["segmentIndex"]), M.ml_imputer(["balance", "nation"]), products, Square(inputCols=numbers)]
    cols = [*products.getOutputCols(), *numbers, "ImputedsegmentIndex"]
    model = L.make_pipeline("random_forest", cols, "label", before, numTrees=10, maxDepth=4).fit(train)
    return model.transform(test).select("id", "label", "prediction")


@query("classify_flow")
def classify_flow(spark, sf_dir):
    """From text and number columns with gaps to a forest: all published depths over three folds of the training rows, scored on test rows."""
    customer = table(spark, sf_dir, "customer")
    df = settle(customer.select(
        F.col("c_custkey").alias("id"), (F.col("c_acctbal") + F.col("c_nationkey") * 200 > 6000).cast("double").alias("label"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("segment"), F.substring("c_name", -2, 2).alias("ending"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("balance"), F.col("c_nationkey").cast("double").alias("nation")), "customers")
    train, test = split_by_key(df, "id", 0.8)
    texts, numbers = ["segment", "ending"], ["balance", "nation"]
    products = PairwiseProduct(inputCols=[f"Imputed{c}" for c in numbers])
    before = [CategoryIndexer(inputCols=texts), SentinelImputer(inputCols=[f"{c}Index" for c in texts]), M.ml_imputer(numbers), products,
              Square(inputCols=[f"Imputed{c}" for c in numbers])]
    cols = [*products.getOutputCols(), *[f"Imputed{c}" for c in numbers], *[f"Imputed{c}Index" for c in texts]]
    pipeline = L.make_pipeline("random_forest", cols, "label", before)
    fitted, score, params = L.cross_validate(train, pipeline, {**L.FOREST_GRID, "numTrees": L.FOREST_GRID["numTrees"][:1]}, "label", "id", 3)
    auc = L.evaluator("auc", "label", "probability").evaluate(fitted.transform(test))
    return spark.createDataFrame([(score, auc, str(sorted(params.items())))], "score double, auc double, params string")


@query("cross_validate")
def cross_validate(spark, sf_dir):
    """The whole grid of the logistic regression over five folds."""
    pipeline = L.make_pipeline("logreg", FEATURES, "label")
    _, score, params = L.cross_validate(labelled(spark, sf_dir), pipeline, L.GRIDS["logreg"], "label", "id")
    return spark.createDataFrame([(score, str(sorted(params.items())))], "score double, params string")


@query("oof_predictions")
def oof_predictions(spark, sf_dir):
    tree = L.make_pipeline("decision_tree", FEATURES, "label", maxDepth=4)
    return L.oof_predictions(labelled(spark, sf_dir), tree, "id").select("id", "label", "prediction")


@query("oof_report")
def oof_report(spark, sf_dir):
    return X.classification_report(oof_predictions(spark, sf_dir), "label", "prediction", (0.0, 1.0))


@query("leaderboard")
def leaderboard(spark, sf_dir):
    train, test = split_by_key(labelled(spark, sf_dir), "id", 0.9)
    contestants = {"logreg": L.make_pipeline("logreg", FEATURES, "label", maxIter=20),
                   "decision_tree": L.make_pipeline("decision_tree", FEATURES, "label", maxDepth=4)}
    return L.leaderboard(train, test, contestants, "label", ["auc", "accuracy"])


@query("perturbation_scores")
def perturbation_scores(spark, sf_dir):
    train, test = split_by_key(labelled(spark, sf_dir), "id", 0.8)
    params = E.fit_minmax(train, FEATURES)
    train, test = E.apply_minmax(train, params), E.apply_minmax(test, params)
    model = L.make_pipeline("logreg", FEATURES, "label", maxIter=20).fit(train)
    return L.perturbation_scores(model, test, FEATURES, "label", "id", 1.2)


KNN_SQL = """
WITH d AS (SELECT q.vec_id AS id, b.vec_id AS bid, b.label, {distance} AS dist FROM
            (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings) AS q
            JOIN (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings) AS b ON q.vec_id <> b.vec_id),
     n AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY id ORDER BY dist, bid) <= {k}),
     v AS (SELECT id, label, round(sum({weight}), 9) AS votes FROM n GROUP BY id, label)
SELECT id, label AS prediction FROM v QUALIFY row_number() OVER (PARTITION BY id ORDER BY votes DESC, label) = 1"""


def vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").selectExpr("vec_id AS id", "embedding AS vec", "label")


@query("knn_classify", KNN_SQL.format(distance="list_distance(q.e, b.e)", k=5, weight="1"))
def knn_uniform(spark, sf_dir):
    """Every vector labelled by its 5 nearest others."""
    df = vectors(spark, sf_dir)
    return knn_classify(df, df, 5, 2, "uniform", same=True)


@query("knn_classify_weighted", KNN_SQL.format(
    distance="list_sum(list_transform(list_zip(q.e, b.e), lambda x: abs(x[1] - x[2])))", k=10, weight="1 / dist"))
def knn_weighted(spark, sf_dir):
    df = vectors(spark, sf_dir)
    return knn_classify(df, df, 10, 1, "distance", same=True)


TRAIN_TEST_SQL = """
WITH base AS (SELECT vec_id % 400 AS id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id % 5 <> 0),
 d AS (SELECT q.vec_id AS id, b.id AS bid, {label} AS label, {distance} AS dist
   FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id % 5 = 0) AS q, base AS b),
 n AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY id ORDER BY dist, bid) <= 5),
 v AS (SELECT id, label, count(*) AS votes FROM n GROUP BY id, label)
SELECT id, label AS prediction FROM v QUALIFY row_number() OVER (PARTITION BY id ORDER BY votes DESC, label) = 1"""


@query("knn_train_test", TRAIN_TEST_SQL.format(label="b.label", distance="list_distance(q.e, b.e)").replace("vec_id % 400", "vec_id"))
def knn_train_test(spark, sf_dir):
    """Test vectors against training vectors."""
    df = vectors(spark, sf_dir)
    return knn_classify(df.where("id % 5 <> 0"), df.where("id % 5 = 0"))


@query("knn_pivots", TRAIN_TEST_SQL.format(label="b.label", distance="list_distance(q.e, b.e)").replace("vec_id % 400", "vec_id"))
def knn_pivots(spark, sf_dir):
    """The same with blocks left out that cannot hold a neighbour."""
    df = vectors(spark, sf_dir)
    return knn_classify(df.where("id % 5 <> 0"), df.where("id % 5 = 0"), search=nearest_by_pivots)


@query("knn_text_labels", TRAIN_TEST_SQL.format(label="'class ' || CAST(b.label AS VARCHAR)", distance=(
    "pow(list_sum(list_transform(list_zip(q.e, b.e), lambda x: pow(abs(x[1] - x[2]), 3))), 1 / 3.0::DOUBLE)")).replace("vec_id % 400", "vec_id + 1"))
def knn_text_labels(spark, sf_dir):
    """Text labels, the third power, and ids that the two tables share for different vectors."""
    df = vectors(spark, sf_dir)
    base = df.where("id % 5 <> 0").select((F.col("id") + 1).alias("id"), "vec", F.concat(F.lit("class "), F.col("label")).alias("label"))
    return knn_classify(base, df.where("id % 5 = 0"), 5, 3)


@query("leaderboard_knn", f"""
WITH p AS ({TRAIN_TEST_SQL.format(label="b.label", distance="list_distance(q.e, b.e)").replace("vec_id % 400", "vec_id")})
SELECT 0 AS place, 'knn' AS model, 'accuracy' AS metric, round(avg(CAST(e.label = p.prediction AS DOUBLE)), 9) AS value
FROM p JOIN embeddings AS e ON e.vec_id = p.id""")
def leaderboard_knn(spark, sf_dir):
    """Neighbours as a contestant, scored on the rows they have not seen."""
    df = vectors(spark, sf_dir).select("id", F.col("label").cast("double").alias("label"), *[F.col("vec")[i].cast("double").alias(f"v{i}") for i in range(64)])
    knn = L.knn_scorer([f"v{i}" for i in range(64)], "label", "id")
    board = L.leaderboard(df.where("id % 5 <> 0"), df.where("id % 5 = 0"), {"knn": knn}, "label", ["accuracy"])
    return rounded(board.select("place", "model", "metric", "value"), 9, "value")
