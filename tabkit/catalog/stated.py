"""Fits whose outcome SQL can state: models over one 0/1 column or the cells of one category."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabkit.catalog.registry import draw_sql, query, rounded, table
from tabkit.operators import metrics as X
from tabkit.operators import models as L
from tabkit.operators.encoders import CategoryIndexer, SentinelImputer
from tabkit.operators.splits import split_by_key
from tabkit.operators.transformers import PairwiseProduct, Square
from tabkit.runtime import settle

COLUMNS = ("o_orderkey AS id", "CAST(o_totalprice > 250000 AS DOUBLE) AS x", "substr(o_orderpriority, 1, 1) AS cell",
           "CAST(o_totalprice + o_custkey % 10 * 20000 > 340000 AS DOUBLE) AS label")
ORDERS = f"(SELECT {', '.join(COLUMNS)} FROM orders)"
CELLS = ("2", "3", "4", "5")  # the first cell is the one without a column of its own


def labelled(spark, sf_dir):
    return settle(table(spark, sf_dir, "orders").selectExpr(*COLUMNS), "labelled")


def fold_sql(folds: int) -> str:
    return f"CAST(floor({draw_sql('id', repr('fold'))} * {folds}) AS INT)"


TREE = {"maxDepth": 1}
MAJORITY_SQL = f"SELECT x, CAST(avg(label) > 0.5 AS DOUBLE) AS prediction, avg(label) AS share FROM {ORDERS} GROUP BY x"


def predicted(spark, sf_dir, kind, **params):
    """id, prediction and, where the model has one, the probability of label 1."""
    df = labelled(spark, sf_dir)
    out = L.make_pipeline(kind, ["x"], "label", **params).fit(df).transform(df)
    if "probability" not in out.columns:
        return out.select("id", "prediction")
    return rounded(out.select("id", "prediction", vector_to_array("probability")[1].alias("probability")), 6, "probability")


SPLIT_SQL = f"SELECT id, prediction, round(share, 6) AS probability FROM {ORDERS} JOIN ({MAJORITY_SQL}) USING (x)"


@query("decision_tree_split", SPLIT_SQL)
def decision_tree_split(spark, sf_dir):
    return predicted(spark, sf_dir, "decision_tree", **TREE)


@query("random_forest_split", SPLIT_SQL)
def random_forest_split(spark, sf_dir):
    """A forest of one tree, grown on all rows."""
    return predicted(spark, sf_dir, "random_forest", numTrees=1, bootstrap=False, subsamplingRate=1.0, featureSubsetStrategy="all", **TREE)


@query("gbt_round", f"""
SELECT id, prediction, round(1 / (1 + exp(-2 * (2 * share - 1))), 6) AS probability FROM {ORDERS} JOIN ({MAJORITY_SQL}) USING (x)""")
def gbt_round(spark, sf_dir):
    """One boosting round: the margin of a leaf is the mean of the labels as -1 and 1."""
    return predicted(spark, sf_dir, "gbt", maxIter=1, **TREE)


@query("linear_svc_flag", f"SELECT id, prediction FROM {ORDERS} JOIN ({MAJORITY_SQL}) USING (x)")
def linear_svc_flag(spark, sf_dir):
    """With a small penalty the hinge loss is least with each value's majority on its side."""
    return predicted(spark, sf_dir, "linear_svc", maxIter=10, regParam=0.01)


@query("logreg_cells", f"""
SELECT id, CAST(share > 0.5 AS DOUBLE) AS prediction, round(share, 4) + 0.0 AS probability
FROM {ORDERS} JOIN (SELECT cell, avg(label) AS share FROM {ORDERS} GROUP BY cell) USING (cell)""")
def logreg_cells(spark, sf_dir):
    """Without a penalty the probability of every cell is its share of label 1."""
    df = labelled(spark, sf_dir).select("*", *[(F.col("cell") == c).cast("double").alias(f"cell_{c}") for c in CELLS])
    model = L.make_pipeline("logreg", [f"cell_{c}" for c in CELLS], "label", maxIter=200, tol=1e-9, regParam=0.0)
    out = model.fit(df).transform(df).select("id", "prediction", vector_to_array("probability")[1].alias("probability"))
    return rounded(out, 4, "probability")


@query("fit_predict_split", f"""
SELECT id, label, prediction FROM (SELECT id, label, x * high AS p FROM (
  SELECT o.*, CAST(cell IN ('1', '2') AS DOUBLE) AS high FROM {ORDERS} AS o)) JOIN (
 SELECT p, CAST(avg(label) > 0.5 AS DOUBLE) AS prediction FROM (SELECT label, x * CAST(cell IN ('1', '2') AS DOUBLE) AS p FROM {ORDERS}) GROUP BY p) USING (p)""")
def fit_predict_split(spark, sf_dir):
    """Products and squares as stages of the pipeline, under names of the caller's choice."""
    df = labelled(spark, sf_dir).withColumn("high", F.col("cell").isin("1", "2").cast("double"))
    stages = [PairwiseProduct(inputCols=["x", "high"], outputCols=["both"]), Square(inputCols=["both"], outputCols=["both_again"])]
    return L.make_pipeline("decision_tree", ["both_again"], "label", stages, **TREE).fit(df).transform(df).select("id", "label", "prediction")


OOF_SQL = f"""
SELECT id, label, CAST((s.ones - f.ones) / (s.n - f.n) > 0.5 AS DOUBLE) AS prediction, fold FROM (SELECT *, {fold_sql(5)} AS fold FROM {ORDERS})
JOIN (SELECT x, sum(label) AS ones, count(*) AS n FROM {ORDERS} GROUP BY x) AS s USING (x)
JOIN (SELECT x, {fold_sql(5)} AS fold, sum(label) AS ones, count(*) AS n FROM {ORDERS} GROUP BY 1, 2) AS f USING (x, fold)"""


@query("oof_split", f"SELECT id, label, prediction FROM ({OOF_SQL})")
def oof_split(spark, sf_dir):
    tree = L.make_pipeline("decision_tree", ["x"], "label", **TREE)
    return L.oof_predictions(labelled(spark, sf_dir), tree, "id", 5).select("id", "label", "prediction")


@query("oof_split_accuracy", f"SELECT avg(CAST(label = prediction AS DOUBLE)) AS accuracy FROM ({OOF_SQL})")
def oof_split_accuracy(spark, sf_dir):
    return X.accuracy(oof_split(spark, sf_dir), "label", "prediction")


@query("grid_search_split", f"""
SELECT round(avg(a), 9) AS score, '[(''maxDepth'', 1)]' AS params FROM (SELECT fold, avg(CAST(label = prediction AS DOUBLE)) AS a FROM ({OOF_SQL}) GROUP BY fold)""")
def grid_search_split(spark, sf_dir):
    """Of a tree without a split and one with one, the second wins; its score is the mean over the folds."""
    pipeline = L.make_pipeline("decision_tree", ["x"], "label")
    _, score, params = L.cross_validate(labelled(spark, sf_dir), pipeline, {"maxDepth": [0, 1]}, "label", "id", 5, "accuracy")
    return rounded(spark.createDataFrame([(score, str(sorted(params.items())))], "score double, params string"), 9, "score")


PARTS_SQL = f"(SELECT *, {draw_sql('id', repr('split'))} < 0.8 AS train FROM {ORDERS})"


@query("leaderboard_split", f"""
WITH p AS (SELECT * FROM {PARTS_SQL}), m AS (SELECT x, avg(label) AS share FROM p WHERE train GROUP BY x),
 t AS (SELECT label, share, CAST(share > 0.5 AS DOUBLE) AS prediction FROM p JOIN m USING (x) WHERE NOT train),
 pairs AS (SELECT sum(a.n * b.n * CASE WHEN a.share > b.share THEN 1 WHEN a.share = b.share THEN 0.5 ELSE 0 END) / sum(a.n * b.n) AS auc
  FROM (SELECT share, count(*) AS n FROM t WHERE label = 1 GROUP BY share) AS a, (SELECT share, count(*) AS n FROM t WHERE label = 0 GROUP BY share) AS b)
SELECT CAST(place AS INT) AS place, model, metric, round(CASE metric WHEN 'auc' THEN (SELECT auc FROM pairs)
  ELSE (SELECT avg(CAST(label = prediction AS DOUBLE)) FROM t) END, 9) AS value
FROM (VALUES (0, 'tree'), (1, 'logreg')) AS k(place, model), (VALUES ('auc'), ('accuracy')) AS s(metric)""")
def leaderboard_split(spark, sf_dir):
    train, test = split_by_key(labelled(spark, sf_dir), "id", 0.8)
    contestants = {"tree": L.make_pipeline("decision_tree", ["x"], "label", **TREE),
                   "logreg": L.make_pipeline("logreg", ["x"], "label", maxIter=100, regParam=0.0)}
    board = L.leaderboard(train, test, contestants, "label", ["auc", "accuracy"])
    return rounded(board.select("place", "model", "metric", "value"), 9, "value")


def noise_sql(trial: str, std: float) -> str:
    first, second = (draw_sql("id", f"('x:' || CAST({trial} AS VARCHAR) || '{part}')") for part in "ab")
    return f"sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {first})) * cos(2.0::DOUBLE * pi() * {second}) * {std}::DOUBLE"


@query("perturbation_split", f"""
WITH m AS ({MAJORITY_SQL}), n AS (SELECT o.*, trial, x + {noise_sql('trial', 1.2)} > 0.5 AS high FROM {ORDERS} AS o, (SELECT unnest(range(1, 51)) AS trial))
SELECT CAST(trial AS INT) AS trial, round(avg(CAST(label = CASE WHEN high THEN (SELECT prediction FROM m WHERE x = 1) ELSE
 (SELECT prediction FROM m WHERE x = 0) END AS DOUBLE)), 9) AS accuracy FROM n GROUP BY trial""")
def perturbation_split(spark, sf_dir):
    """Fifty trials of noise on the split column."""
    df = labelled(spark, sf_dir)
    model = L.make_pipeline("decision_tree", ["x"], "label", **TREE).fit(df)
    return rounded(L.perturbation_scores(model, df, ["x"], "label", "id", 1.2, 50), 9, "accuracy")


# The interval at 95 % is 2 * 1.959963984540054 standard errors wide.
@query("perturbation_width", f"""
WITH m AS ({MAJORITY_SQL}), n AS (SELECT o.*, trial, x + {noise_sql('trial', 1.2)} > 0.5 AS high FROM {ORDERS} AS o, (SELECT unnest(range(1, 41)) AS trial)),
 s AS (SELECT CAST(trial AS INT) AS trial, avg(CAST(label = CASE WHEN high THEN (SELECT prediction FROM m WHERE x = 1) ELSE
  (SELECT prediction FROM m WHERE x = 0) END AS DOUBLE)) AS accuracy FROM n GROUP BY trial),
 w AS (SELECT b.ends, 2 * 1.959963984540054 * stddev_pop(s.accuracy) / sqrt(count(*)) AS width FROM s JOIN (SELECT unnest([5, 10, 15, 20, 25, 30, 35, 40]) AS ends) AS b
  ON s.trial <= b.ends GROUP BY b.ends)
SELECT trial, round(accuracy, 9) AS accuracy FROM s WHERE trial <= coalesce((SELECT min(ends) FROM w WHERE width <= 0.0028), 40)""")
def perturbation_width(spark, sf_dir):
    """Noise on the split column, by fives of trials until the mean accuracy is known to 0.0028, or forty."""
    df = labelled(spark, sf_dir)
    model = L.make_pipeline("decision_tree", ["x"], "label", **TREE).fit(df)
    return rounded(L.perturbation_until(model, df, ["x"], "label", "id", 0.0028, 1.2, batch=5, most=40), 9, "accuracy")


STRATIFIED_SQL = f"""
SELECT *, CAST(len(list_filter([1, 2, 3, 4], lambda j: (2 * n * j + 5) // 10 < r)) AS INT) AS fold FROM (
 SELECT *, row_number() OVER (PARTITION BY label ORDER BY {draw_sql('id', repr('fold'))}, id) AS r, count(*) OVER (PARTITION BY label) AS n FROM {ORDERS})"""


@query("stratified_folds", f"SELECT id, label, fold FROM ({STRATIFIED_SQL})")
def stratified_folds(spark, sf_dir):
    return L.with_folds(labelled(spark, sf_dir), "id", 5, "label").select("id", "label", F.col(L.FOLD).alias("fold"))


@query("oof_stratified", f"""
WITH f AS ({STRATIFIED_SQL}), s AS (SELECT x, sum(label) AS ones, count(*) AS n FROM f GROUP BY x), p AS (SELECT x, fold, sum(label) AS ones, count(*) AS n FROM f GROUP BY x, fold)
SELECT f.id, f.label, f.fold, CAST((s.ones - p.ones) / (s.n - p.n) > 0.5 AS DOUBLE) AS prediction FROM f JOIN s USING (x) JOIN p USING (x, fold)""")
def oof_stratified(spark, sf_dir):
    """Out-of-fold predictions over folds with equal shares of each label."""
    tree = L.make_pipeline("decision_tree", ["x"], "label", **TREE)
    return L.oof_predictions(labelled(spark, sf_dir), tree, "id", 5, "label").select("id", "label", F.col(L.FOLD).alias("fold"), "prediction")


# Orders with a category of which a tenth of the test rows has a value that no training row has, and some have none.
SHOPS = ("o_orderkey AS id", "o_orderkey % 5 = 0 AS test", "CAST(o_totalprice + o_custkey % 10 * 20000 > 340000 AS DOUBLE) AS label",
         "CASE WHEN o_orderkey % 50 = 0 THEN 'new' WHEN o_orderkey % 11 = 3 THEN NULL WHEN o_totalprice > 250000 THEN 'large' ELSE 'small' END AS size",
         "CAST(o_custkey AS BIGINT) AS customer")
SHOPS_SQL = f"(SELECT {', '.join(SHOPS)} FROM orders)"


def shops(spark, sf_dir):
    return settle(table(spark, sf_dir, "orders").selectExpr(*SHOPS), "shops")


def index_sql(column: str, order: str) -> str:
    return (f"SELECT CAST({column} AS VARCHAR) AS value, CAST(row_number() OVER (ORDER BY {order}) - 1 AS DOUBLE) AS i"
            f" FROM {SHOPS_SQL} WHERE NOT test AND {column} IS NOT NULL GROUP BY {column}")


@query("fitted_index_unseen", f"""
WITH s AS ({index_sql('size', 'count(*) DESC, size')}), c AS ({index_sql('customer', 'count(*) DESC, CAST(customer AS VARCHAR)')})
SELECT t.id, coalesce(s.i, CAST((SELECT count(*) FROM s) AS DOUBLE)) AS "sizeIndex", coalesce(c.i, CAST((SELECT count(*) FROM c) AS DOUBLE)) AS "customerIndex",
 coalesce(s.i, 0.0) AS "ImputedsizeIndex", coalesce(c.i, 0.0) AS "ImputedcustomerIndex"
FROM {SHOPS_SQL} AS t LEFT JOIN s ON t.size = s.value LEFT JOIN c ON CAST(t.customer AS VARCHAR) = c.value WHERE t.test""")
def fitted_index_unseen(spark, sf_dir):
    """Indexes learnt from training rows, applied to test rows with values that were not among them."""
    df = shops(spark, sf_dir)
    cols = ["size", "customer"]
    pipeline = Pipeline(stages=[CategoryIndexer(inputCols=cols), SentinelImputer(inputCols=[f"{c}Index" for c in cols])])
    out = pipeline.fit(df.where("NOT test")).transform(df.where("test"))
    return out.select("id", *[f"{p}{c}Index" for p in ("", "Imputed") for c in cols])


@query("fitted_label_encode", f"""
WITH s AS ({index_sql('size', 'size')}), c AS ({index_sql('customer', 'customer')})
SELECT t.id, s.i AS size_encoded, c.i AS customer_encoded FROM {SHOPS_SQL} AS t LEFT JOIN s ON t.size = s.value LEFT JOIN c ON CAST(t.customer AS VARCHAR) = c.value WHERE t.test""")
def fitted_label_encode(spark, sf_dir):
    """Codes in sorted order, learnt from training rows; test rows with other values have none."""
    df = shops(spark, sf_dir)
    coder = CategoryIndexer(inputCols=["size", "customer"], outputCols=["size_encoded", "customer_encoded"], order="value", unknown="null")
    return coder.fit(df.where("NOT test")).transform(df.where("test")).select("id", "size_encoded", "customer_encoded")


GROUPS_SQL = f"""
WITH t AS (SELECT *, {fold_sql(5)} AS fold FROM {SHOPS_SQL} WHERE NOT test),
 often AS (SELECT f, arg_min(size, (-n, size)) AS top FROM (SELECT f, size, count(*) AS n FROM t, (SELECT unnest(range(6)) AS f) WHERE fold <> f AND size IS NOT NULL GROUP BY f, size) GROUP BY f),
 fitted AS (SELECT f, coalesce(size, top) AS size, avg(label) AS share FROM t JOIN often ON fold <> f GROUP BY ALL)"""


@query("pipeline_unseen", f"""{GROUPS_SQL}
SELECT id, label, CAST(share > 0.5 AS DOUBLE) AS prediction, round((SELECT avg(a) FROM (SELECT avg(CAST(label = CAST(share > 0.5 AS DOUBLE) AS DOUBLE)) AS a
   FROM t JOIN often ON fold = often.f JOIN fitted ON fitted.f = fold AND fitted.size = coalesce(t.size, top) GROUP BY fold)), 9) AS score
FROM {SHOPS_SQL} AS t JOIN often ON often.f = 5 JOIN fitted ON fitted.f = 5 AND fitted.size = CASE WHEN t.size IN (SELECT size FROM fitted WHERE f = 5) THEN t.size ELSE top END WHERE t.test""")
def pipeline_unseen(spark, sf_dir):
    """Indexer, imputer and tree in one pipeline under cross-validation: every fold learns its indexes from its own training rows."""
    df = shops(spark, sf_dir)
    before = [CategoryIndexer(inputCols=["size"]), SentinelImputer(inputCols=["sizeIndex"])]
    pipeline = L.make_pipeline("decision_tree", ["ImputedsizeIndex"], "label", before)
    fitted, score, _ = L.cross_validate(df.where("NOT test"), pipeline, {"maxDepth": [1]}, "label", "id", 5, "accuracy")
    out = fitted.transform(df.where("test")).select("id", "label", "prediction", F.lit(score).alias("score"))
    return rounded(out, 9, "score")
