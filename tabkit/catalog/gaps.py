"""Missing values and outliers."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tabkit.catalog.registry import GAPPY_SQL, draw_sql, gappy, query, rounded, table
from tabkit.operators import missing as M
from tabkit.operators import outliers as O
from tabkit.operators.frequent import mode_table
from tabkit.sources.readers import inline


@query("missing_counts", f"""
SELECT c AS column_name, CAST(n AS BIGINT) AS missing FROM (
  SELECT count_if(id IS NULL) AS id, count_if(cust IS NULL) AS cust, count_if(price IS NULL) AS price,
         count_if(priority IS NULL) AS priority, count_if(flag IS NULL) AS flag, count_if(age IS NULL) AS age,
         count_if(sex IS NULL) AS sex FROM {GAPPY_SQL}) UNPIVOT (n FOR c IN (id, cust, price, priority, flag, age, sex))""")
def missing_counts(spark, sf_dir):
    return M.missing_counts(gappy(spark, sf_dir))


@query("null_review", f"""
SELECT 'price,priority,flag,age' AS columns_with_null, CAST(count(*) AS BIGINT) AS rows_with_null
FROM {GAPPY_SQL} WHERE price IS NULL OR priority IS NULL OR flag IS NULL OR age IS NULL""")
def null_review(spark, sf_dir):
    return M.null_review(gappy(spark, sf_dir))


@query("impute_mode", f"""
WITH t AS (SELECT id, priority, flag, age FROM {GAPPY_SQL}),
     p AS (SELECT priority FROM t WHERE priority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
     f AS (SELECT flag FROM t WHERE flag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
     a AS (SELECT age FROM t WHERE age IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT t.id, coalesce(t.priority, p.priority) AS priority, coalesce(t.flag, f.flag) AS flag, coalesce(t.age, a.age) AS age
FROM t, p, f, a""")
def impute_mode(spark, sf_dir):
    cols = ["priority", "flag", "age"]
    return M.impute_mode(gappy(spark, sf_dir).select("id", *cols), cols)


# Keys of which a twentieth are one value, keys as they are (none is frequent), their text with a frequent word, and a price.
NEAR_UNIQUE = {
    "some": "CASE WHEN l_orderkey % 20 = 3 THEN -7 ELSE l_orderkey * 10 + l_linenumber END",
    "none": "l_orderkey",
    "word": "CASE WHEN l_partkey % 11 < 2 THEN 'none' ELSE concat(l_orderkey, '-', l_linenumber) END",
    "price": "CASE WHEN l_orderkey % 9 = 0 THEN NULL WHEN l_orderkey % 9 = 1 THEN 0 ELSE CAST(l_extendedprice * 100 AS BIGINT) END",
}


@query("mode_near_unique", " UNION ALL ".join(f"""
(SELECT '{name}' AS column_name, CAST(v AS VARCHAR) AS value, count(*) AS n FROM (SELECT {sql} AS v FROM lineitem) WHERE v IS NOT NULL
 GROUP BY v ORDER BY count(*) DESC, v LIMIT 1)""" for name, sql in NEAR_UNIQUE.items()))
def mode_near_unique(spark, sf_dir):
    """Modes of columns with almost as many values as rows."""
    cols = table(spark, sf_dir, "lineitem").selectExpr(*[f"{sql} AS {name}" for name, sql in NEAR_UNIQUE.items()])
    return mode_table(cols, list(NEAR_UNIQUE))


@query("impute_mean", f"""
WITH t AS (SELECT id, price, age FROM {GAPPY_SQL})
SELECT id, round(coalesce(price, (SELECT avg(price) FROM t)), 4) AS price, round(coalesce(age, (SELECT avg(age) FROM t)), 4) AS age
FROM t""")
def impute_mean(spark, sf_dir):
    return rounded(M.impute_mean(gappy(spark, sf_dir).select("id", "price", "age"), ["price", "age"]), 4, "price", "age")


@query("impute_constant", f"""
SELECT id, coalesce(flag, 0) AS flag, coalesce(price, 130.0) AS price, coalesce(priority, 'none') AS priority FROM {GAPPY_SQL}""")
def impute_constant(spark, sf_dir):
    filled = M.impute_constant(gappy(spark, sf_dir), {"flag": 0, "price": 130.0, "priority": "none"})
    return filled.select("id", "flag", "price", "priority")


@query("clamp_flag", f"SELECT id, CASE WHEN flag > 1 THEN 0 ELSE coalesce(flag, 0) END AS flag FROM {GAPPY_SQL}")
def clamp_flag(spark, sf_dir):
    return M.clamp_flag(gappy(spark, sf_dir), ["flag"]).select("id", "flag")


@query("replace_out_of_range_mode", f"""
WITH t AS (SELECT id, age FROM {GAPPY_SQL}),
     m AS (SELECT age AS v FROM t WHERE age IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
     c AS (SELECT id, CASE WHEN age <= 25 THEN v ELSE age END AS age FROM t, m),
     n AS (SELECT age AS v FROM c WHERE age IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT id, coalesce(age, v) AS age FROM c, n""")
def replace_out_of_range_mode(spark, sf_dir):
    return M.replace_out_of_range(gappy(spark, sf_dir).select("id", "age"), "age", F.col("age") <= 25, "mode")


@query("replace_out_of_range_mean", f"""
WITH t AS (SELECT id, price FROM {GAPPY_SQL}),
     c AS (SELECT id, CASE WHEN price >= 400000 OR price <= 20000 THEN (SELECT avg(price) FROM t) ELSE price END AS price FROM t)
SELECT id, round(coalesce(price, (SELECT avg(price) FROM c)), 4) AS price FROM c""")
def replace_out_of_range_mean(spark, sf_dir):
    outside = (F.col("price") >= 400000) | (F.col("price") <= 20000)
    return rounded(M.replace_out_of_range(gappy(spark, sf_dir).select("id", "price"), "price", outside, "mean"), 4, "price")


@query("ml_imputer", f"""
WITH t AS (SELECT id, price, CAST(age AS DOUBLE) AS age FROM {GAPPY_SQL}),
     m AS (SELECT age AS v FROM t WHERE age IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT id, round(coalesce(price, (SELECT avg(price) FROM t)), 4) AS "Imputedprice", coalesce(age, v) AS "Imputedage" FROM t, m""")
def ml_imputer(spark, sf_dir):
    df = gappy(spark, sf_dir).select("id", "price", F.col("age").cast("double").alias("age"))
    stages = Pipeline(stages=[M.ml_imputer(["price"], "mean"), M.ml_imputer(["age"], "mode")])
    return rounded(stages.fit(df).transform(df).select("id", "Imputedprice", "Imputedage"), 4, "Imputedprice")


@query("impute_category_sentinel", f"""
WITH t AS (SELECT id, priority FROM {GAPPY_SQL}),
     k AS (SELECT priority, CAST(row_number() OVER (ORDER BY count(*) DESC, priority) - 1 AS DOUBLE) AS i
           FROM t WHERE priority IS NOT NULL GROUP BY priority)
SELECT t.id, coalesce(k.i, CAST((SELECT count(*) FROM k) AS DOUBLE)) AS "priorityIndex", coalesce(k.i, 0.0) AS "ImputedpriorityIndex"
FROM t LEFT JOIN k ON t.priority = k.priority""")
def impute_category_sentinel(spark, sf_dir):
    df = gappy(spark, sf_dir).select("id", "priority")
    return M.impute_category(df, ["priority"]).drop("priority")


# Made-up rates by age, and by sex and age; the last band of each is open-ended.
AGE_RATES = [(18, 24, 0.08), (25, 34, 0.12), (35, 64, 0.14), (65, None, 0.06)]
SEX_AGE_RATES = [(s, lo, hi, p * f) for s, f in ((0, 1.0), (1, 1.5)) for lo, hi, p in ((18, 24, 0.05), (25, 44, 0.12), (45, 64, 0.15), (65, None, 0.08))]


def values_sql(rows, name):
    return "(VALUES " + ", ".join("(" + ", ".join("NULL" if v is None else repr(v) for v in row) + ")" for row in rows) + f") AS {name}"


@query("impute_by_rate", f"""
SELECT g.id, g.sex, g.age, coalesce(CASE WHEN g.flag > 1 THEN 1 ELSE g.flag END, greatest(
    coalesce(CAST({draw_sql('g.id', repr('first'))} < CAST(a.prob AS DOUBLE) AS INT), 0),
    coalesce(CAST({draw_sql('g.id', repr('second'))} < CAST(s.prob AS DOUBLE) AS INT), 0))) AS flag
FROM {GAPPY_SQL} AS g
LEFT JOIN {values_sql(AGE_RATES, 'a(lo, hi, prob)')} ON g.age >= a.lo AND (a.hi IS NULL OR g.age <= a.hi)
LEFT JOIN {values_sql(SEX_AGE_RATES, 's(grp, lo, hi, prob)')} ON g.sex = s.grp AND g.age >= s.lo AND (s.hi IS NULL OR g.age <= s.hi)""")
def impute_by_rate(spark, sf_dir):
    flag = F.least(F.col("flag"), F.lit(1))
    df = gappy(spark, sf_dir).select("id", "sex", "age", F.when(F.col("flag").isNotNull(), flag).alias("flag"))
    bands = inline(spark, AGE_RATES, "lo int, hi int, prob double")
    by_sex = inline(spark, SEX_AGE_RATES, "grp int, lo int, hi int, prob double")
    return M.impute_by_rate(df, "flag", "id", "age", "sex", bands, by_sex)


@query("impute_by_rate_named", f"""
SELECT g.id, g.sex, g.age, g.age AS lo, 'kept' AS hi, g.sex AS grp, coalesce(CASE WHEN g.flag > 1 THEN 1 ELSE g.flag END, greatest(
    coalesce(CAST({draw_sql('g.id', repr('first'))} < CAST(a.prob AS DOUBLE) AS INT), 0),
    coalesce(CAST({draw_sql('g.id', repr('second'))} < CAST(s.prob AS DOUBLE) AS INT), 0))) AS flag
FROM {GAPPY_SQL} AS g
LEFT JOIN {values_sql(AGE_RATES, 'a(lo, hi, prob)')} ON g.age >= a.lo AND (a.hi IS NULL OR g.age <= a.hi)
LEFT JOIN {values_sql(SEX_AGE_RATES, 's(grp, lo, hi, prob)')} ON g.sex = s.grp AND g.age >= s.lo AND (s.hi IS NULL OR g.age <= s.hi)""")
def impute_by_rate_named(spark, sf_dir):
    """The caller's own columns lo, hi and grp are kept."""
    flag = F.least(F.col("flag"), F.lit(1))
    df = gappy(spark, sf_dir).select("id", "sex", "age", F.col("age").alias("lo"), F.lit("kept").alias("hi"), F.col("sex").alias("grp"),
                                     F.when(F.col("flag").isNotNull(), flag).alias("flag"))
    return M.impute_by_rate(df, "flag", "id", "age", "sex", inline(spark, AGE_RATES, "lo int, hi int, prob double"),
                            inline(spark, SEX_AGE_RATES, "grp int, lo int, hi int, prob double"))


def _chain_sql(width: str, lo_op: str, hi_op: str) -> str:
    steps, source = [], "t"
    for i, c in enumerate(("value", "sq")):
        steps.append(f"s{i} AS (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM {source}), "
                     f"t{i} AS (SELECT x.* FROM {source} AS x, s{i} WHERE {c} {lo_op} m - {width} * s AND {c} {hi_op} m + {width} * s)")
        source = f"t{i}"
    return ("WITH t AS (SELECT event_id, value, value * value AS sq FROM events), " + ", ".join(steps)
            + f" SELECT event_id, value FROM {source}")


def event_values(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "value", (F.col("value") * F.col("value")).alias("sq"))


@query("outliers_sequential", _chain_sql("3.0", ">=", "<="))
def outliers_sequential(spark, sf_dir):
    return O.outliers_sequential(event_values(spark, sf_dir), ["value", "sq"]).select("event_id", "value")


@query("outliers_zscore", _chain_sql("3.01", ">", "<"))
def outliers_zscore(spark, sf_dir):
    return O.outliers_zscore(event_values(spark, sf_dir), ["value", "sq"]).select("event_id", "value")


@query("outliers_onepass", """
WITH t AS (SELECT event_id, value, value * value AS sq FROM events),
     s AS (SELECT avg(value) AS mv, stddev_samp(value) AS sv, avg(sq) AS mq, stddev_samp(sq) AS sq2 FROM t)
SELECT event_id, value FROM t, s WHERE value BETWEEN mv - 3 * sv AND mv + 3 * sv AND sq BETWEEN mq - 3 * sq2 AND mq + 3 * sq2""")
def outliers_onepass(spark, sf_dir):
    return O.outliers_onepass(event_values(spark, sf_dir), ["value", "sq"]).select("event_id", "value")


@query("nan_to_null", "SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS value FROM events")
def nan_to_null(spark, sf_dir):
    value = F.when(F.col("event_id") % 9 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return M.nan_to_null(table(spark, sf_dir, "events").select("event_id", value.alias("value")))
