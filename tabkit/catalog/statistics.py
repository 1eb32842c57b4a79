"""Group aggregates, descriptive statistics, and scores of predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabkit.catalog.registry import GAPPY_SQL, gappy, query, rounded, table
from tabkit.functions.numbers import code_to_label
from tabkit.operators import metrics as X
from tabkit.operators import stats as S
from tabkit.operators.gram import corr_matrix_wide

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def lineitem(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


def per_column(template: str, cols=tuple(MEASURES), source: str = "lineitem") -> str:
    """The same one-row query for every column, one under the other."""
    return " UNION ALL ".join(template.format(c=c, t=source) for c in cols)


@query("group_avg", "SELECT o_orderpriority, round(avg(o_totalprice), 4) AS average_price FROM orders GROUP BY 1")
def group_avg(spark, sf_dir):
    groups = S.group_agg(table(spark, sf_dir, "orders"), ["o_orderpriority"], ["o_totalprice"])
    return rounded(groups.withColumnRenamed("o_totalprice", "average_price"), 4, "average_price")


@query("group_mean_all", "SELECT l_returnflag, " + ", ".join(f"round(avg({c}), 6) + 0.0 AS {c}" for c in MEASURES)
       + " FROM lineitem GROUP BY 1")
def group_mean_all(spark, sf_dir):
    return rounded(S.group_agg(lineitem(spark, sf_dir), ["l_returnflag"], MEASURES), 6, *MEASURES)


@query("group_sum_all", "SELECT l_linestatus, " + ", ".join(f"round(sum({c}), 2) + 0.0 AS {c}" for c in MEASURES)
       + " FROM lineitem GROUP BY 1")
def group_sum_all(spark, sf_dir):
    return rounded(S.group_agg(lineitem(spark, sf_dir), ["l_linestatus"], MEASURES, S.SUM), 2, *MEASURES)


@query("group_by_weekday", """
SELECT dayname(ts) AS weekday, round(avg(value), 6) AS mean_value, round(sum(value), 2) AS total_value,
       CAST(count(*) AS BIGINT) AS events FROM events GROUP BY 1""")
def group_by_weekday(spark, sf_dir):
    days = table(spark, sf_dir, "events").withColumn("weekday", code_to_label(F.weekday("ts") + 1))
    groups = days.groupBy("weekday").agg(F.avg("value").alias("mean_value"), F.sum("value").alias("total_value"),
                                         F.count(F.lit(1)).alias("events"))
    return rounded(rounded(groups, 6, "mean_value"), 2, "total_value")


@query("group_count_desc", "SELECT l_suppkey, CAST(count(*) AS BIGINT) AS count FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1")
def group_count_desc(spark, sf_dir):
    return S.frequency(lineitem(spark, sf_dir), "l_suppkey")


@query("column_stats", per_column("""
SELECT '{c}' AS column_name, round(avg({c}), 6) + 0.0 AS mean, round(quantile_cont({c}, 0.5), 6) + 0.0 AS median,
 round(stddev_samp({c}), 6) AS std_dev, round((SELECT {c} FROM {t} GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1), 6) + 0.0 AS mode,
 round(var_samp({c}), 2) AS variance, round(max({c}), 6) + 0.0 AS max, round(min({c}), 6) + 0.0 AS min FROM {t}"""))
def column_stats(spark, sf_dir):
    stats = rounded(S.column_stats(lineitem(spark, sf_dir), MEASURES), 6, "mean", "median", "std_dev", "mode", "max", "min")
    return rounded(stats, 2, "variance")


@query("describe", per_column("""
SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 6) + 0.0 AS mean, round(stddev_samp({c}), 6) AS std,
 round(min({c}), 6) + 0.0 AS min, round(quantile_cont({c}, 0.25), 6) + 0.0 AS p25, round(quantile_cont({c}, 0.5), 6) + 0.0 AS p50,
 round(quantile_cont({c}, 0.75), 6) + 0.0 AS p75, round(max({c}), 6) + 0.0 AS max FROM {t}"""))
def describe(spark, sf_dir):
    return rounded(S.describe(lineitem(spark, sf_dir), MEASURES), 6, "mean", "std", "min", "p25", "p50", "p75", "max")


@query("skew_kurtosis", per_column("""
SELECT '{c}' AS column_name, round(skewness({c}), 6) + 0.0 AS skewness, round(kurtosis({c}), 6) + 0.0 AS kurtosis FROM {t}"""))
def skew_kurtosis(spark, sf_dir):
    return rounded(S.skew_kurtosis(lineitem(spark, sf_dir), MEASURES), 6, "skewness", "kurtosis")


@query("correlation_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS column_x, '{b}' AS column_y, " + ("CASE WHEN var_samp({a}) > 0 THEN CAST(1.0 AS DOUBLE) END".replace("{a}", a) if a == b else f"round(corr({a}, {b}), 8)")
    + f" + 0.0 AS corr FROM {GAPPY_SQL}"
    for a in ("price", "age", "flag") for b in ("price", "age", "flag")))
def correlation_matrix(spark, sf_dir):
    return rounded(S.corr_matrix(gappy(spark, sf_dir), ["price", "age", "flag"]), 8, "corr")


@query("correlation_wide", """
WITH e AS (SELECT vec_id, unnest(range(24)) AS d, unnest(embedding[1:24]) AS x FROM embeddings),
 g AS (SELECT vec_id, d, CASE WHEN (vec_id + d) % 7 <> 0 THEN CAST(x AS DOUBLE) + 1000 * d END AS x FROM e)
SELECT 'v' || a.d AS column_x, 'v' || b.d AS column_y, round(CASE WHEN a.d = b.d THEN 1.0 ELSE corr(a.x, b.x) END, 6) + 0.0 AS corr
FROM g AS a JOIN g AS b USING (vec_id) GROUP BY a.d, b.d""")
def correlation_wide(spark, sf_dir):
    """Many columns with gaps, far from zero."""
    vectors = table(spark, sf_dir, "embeddings").select(*[
        F.when((F.col("vec_id") + d) % 7 != 0, F.col("embedding")[d].cast("double") + 1000 * d).alias(f"v{d}") for d in range(24)])
    return rounded(corr_matrix_wide(vectors, [f"v{d}" for d in range(24)]), 6, "corr")


@query("count_distinct", per_column("SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_values FROM {t}",
                                    ("l_suppkey", "l_returnflag", "l_quantity")))
def count_distinct(spark, sf_dir):
    return S.count_distinct(lineitem(spark, sf_dir), ["l_suppkey", "l_returnflag", "l_quantity"])


@query("boxplot_stats", """
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT 'value' AS column_name, round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS median, round(any_value(q3), 6) AS q3,
 min(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
 max(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
 CAST(count_if(value NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS BIGINT) AS outliers FROM events, q""")
def boxplot_stats(spark, sf_dir):
    return rounded(S.boxplot_stats(table(spark, sf_dir, "events"), ["value"]), 6, "q1", "median", "q3")


@query("pair_bins", " UNION ALL ".join(f"""
SELECT '{a}' AS column_x, '{b}' AS column_y, bin_x, bin_y, CAST(count(*) AS BIGINT) AS count FROM (
 SELECT CAST(least(floor(({a} - alo) / ((ahi - alo) / 10)), 9) AS INT) AS bin_x,
        CAST(least(floor(({b} - blo) / ((bhi - blo) / 10)), 9) AS INT) AS bin_y FROM lineitem,
 (SELECT min({a}) AS alo, max({a}) AS ahi, min({b}) AS blo, max({b}) AS bhi FROM lineitem)) GROUP BY bin_x, bin_y"""
    for a, b in (("l_quantity", "l_extendedprice"), ("l_quantity", "l_tax"), ("l_extendedprice", "l_tax"))))
def pair_bins(spark, sf_dir):
    return S.pair_bins(lineitem(spark, sf_dir), ["l_quantity", "l_extendedprice", "l_tax"], 10)


# A rule of thumb as the model: long documents are good ones.
JUDGED_SQL = "(SELECT doc_id, quality, n_chars, CAST(n_chars >= 600 AS INT) AS guess FROM labels JOIN documents USING (doc_id))"


def judged(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return table(spark, sf_dir, "labels").join(documents, "doc_id").withColumn("guess", (F.col("n_chars") >= 600).cast("int"))


@query("confusion_matrix", " UNION ALL ".join(f"""
SELECT {a} AS actual, {p} AS predicted, CAST(count_if(quality = {a} AND guess = {p}) AS BIGINT) AS count,
 round(count_if(quality = {a} AND guess = {p}) * 100.0::DOUBLE / count(*), 6) AS percent FROM {JUDGED_SQL}"""
    for a in (0, 1) for p in (0, 1)))
def confusion_matrix(spark, sf_dir):
    return rounded(X.confusion_matrix(judged(spark, sf_dir), "quality", "guess"), 6, "percent")


@query("accuracy", f"SELECT round(avg(CAST(quality = guess AS DOUBLE)), 9) AS accuracy FROM {JUDGED_SQL}")
def accuracy(spark, sf_dir):
    return rounded(X.accuracy(judged(spark, sf_dir), "quality", "guess"), 9, "accuracy")


@query("classification_report", f"""
WITH j AS (SELECT quality, guess FROM {JUDGED_SQL}),
 c AS (SELECT k, count_if(quality = k AND guess = k)::DOUBLE AS hit, count_if(guess = k)::DOUBLE AS said, count_if(quality = k)::DOUBLE AS n
       FROM j, (VALUES (0), (1)) AS classes(k) GROUP BY k),
 r AS (SELECT k, CASE WHEN said = 0 THEN 0 ELSE hit / said END AS p, CASE WHEN n = 0 THEN 0 ELSE hit / n END AS r, n, hit FROM c),
 f AS (SELECT *, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f FROM r),
 a AS (SELECT CAST(k AS VARCHAR) AS label, p, r, f, n FROM f
       UNION ALL SELECT 'accuracy', sum(hit) / sum(n), sum(hit) / sum(n), sum(hit) / sum(n), sum(n) FROM f
       UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(n) FROM f
       UNION ALL SELECT 'weighted avg', sum(p * n) / sum(n), sum(r * n) / sum(n), sum(f * n) / sum(n), sum(n) FROM f)
SELECT label, round(p, 9) AS precision, round(r, 9) AS recall, round(f, 9) AS f1, CAST(n AS BIGINT) AS support FROM a""")
def classification_report(spark, sf_dir):
    return rounded(X.classification_report(judged(spark, sf_dir), "quality", "guess"), 9, "precision", "recall", "f1")


AUC_SQL = """
WITH s AS (SELECT {score} AS score, sum({y})::DOUBLE AS pos, sum(1 - {y})::DOUBLE AS neg FROM {t} GROUP BY 1),
     c AS (SELECT *, sum(neg) OVER (ORDER BY score) - neg AS below FROM s)
SELECT round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 9) AS auc FROM c"""


@query("auc_roc", AUC_SQL.format(score="n_chars", y="quality", t=JUDGED_SQL))
def auc_roc(spark, sf_dir):
    return rounded(X.auc_roc(judged(spark, sf_dir), "quality", "n_chars"), 9, "auc")


@query("auc_roc_lineitem", AUC_SQL.format(score="l_extendedprice", y="CAST(l_returnflag = 'R' AS INT)", t="lineitem"))
def auc_roc_lineitem(spark, sf_dir):
    scored = lineitem(spark, sf_dir).select("l_extendedprice", (F.col("l_returnflag") == "R").cast("int").alias("returned"))
    return rounded(X.auc_roc(scored, "returned", "l_extendedprice"), 9, "auc")


SPECIAL = "CASE WHEN event_id % 11 = 0 THEN CAST('NaN' AS DOUBLE) WHEN event_id % 7 = 0 THEN CAST('Infinity' AS DOUBLE) WHEN event_id % 5 = 0 THEN CAST('-Infinity' AS DOUBLE) ELSE value END"


@query("auc_roc_special", AUC_SQL.format(score="score", y="y", t=f"(SELECT {SPECIAL} AS score, CAST(event_id % 3 = 0 AS INT) AS y FROM events)"))
def auc_roc_special(spark, sf_dir):
    """NaN counts as the highest score, above infinity."""
    scored = table(spark, sf_dir, "events").selectExpr(f"{SPECIAL} AS score", "CAST(event_id % 3 = 0 AS INT) AS y")
    return rounded(X.auc_roc(scored, "y", "score"), 9, "auc")


@query("score_interval", """
SELECT round(m, 8) AS mean, round(se, 8) AS std_error, round(m - 1.959963984540054 * se, 8) AS low, round(m + 1.959963984540054 * se, 8) AS high
FROM (SELECT avg(value) AS m, stddev_pop(value) / sqrt(count(value)) AS se FROM events)""")
def score_interval(spark, sf_dir):
    return rounded(X.score_interval(table(spark, sf_dir, "events"), "value"), 8, "mean", "std_error", "low", "high")


# Three rules of thumb compared by accuracy.
RULES = [("production", 300), ("max", 600), ("product", 1200)]
BOARD_SQL = "(" + " UNION ALL ".join(
    f"SELECT {i} AS place, '{m}' AS model, 'accuracy' AS metric, round(avg(CAST((n_chars >= {n}) = (quality = 1) AS DOUBLE)), 9) AS value"
    f" FROM {JUDGED_SQL}" for i, (m, n) in enumerate(RULES)) + ")"


def board(spark, sf_dir):
    df = judged(spark, sf_dir)
    rules = F.inline(F.array(*[F.struct(F.lit(i).alias("place"), F.lit(m).alias("model"), F.lit(n).alias("least"))
                               for i, (m, n) in enumerate(RULES)]))
    right = ((F.col("n_chars") >= F.col("least")) == (F.col("quality") == 1)).cast("double")
    scores = df.select("n_chars", "quality", rules).groupBy("place", "model").agg(F.avg(right).alias("value"))
    return rounded(scores.withColumn("metric", F.lit("accuracy")), 9, "value")


@query("select_best", f"SELECT model, metric, value FROM {BOARD_SQL} ORDER BY value DESC, place LIMIT 1")
def select_best(spark, sf_dir):
    return X.select_best(board(spark, sf_dir), "accuracy", "place").select("model", "metric", "value")


@query("promote_decision", f"""
WITH b AS (SELECT max(value) FILTER (model = 'production') AS c, max(value) FILTER (model = 'max') AS m,
                  max(value) FILTER (model = 'product') AS p FROM {BOARD_SQL})
SELECT CASE WHEN greatest(m, p) - c < -0.01 THEN 'do_nothing' WHEN m > p THEN 'max' ELSE 'product' END AS decision,
       c AS champion, greatest(m, p) AS best_challenger FROM b""")
def promote_decision(spark, sf_dir):
    return X.promote_decision(board(spark, sf_dir), "production", ["max", "product"])
