"""Encodings, scaling, pairwise features, splits and samples."""

from __future__ import annotations

from itertools import combinations, combinations_with_replacement

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabkit.catalog.registry import GAPPY_SQL, draw_sql, gappy, query, rounded, table
from tabkit.functions import draws
from tabkit.operators import features as E
from tabkit.operators import splits as P
from tabkit.operators.transformers import PairwiseProduct, Square

MEASURES = ["l_quantity", "l_discount", "l_tax"]
SPARSE = r"^\((\d+),\[([^\]]*)\],\[([^\]]*)\]\)$"  # a sparse vector as text


def measures(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *MEASURES)


@query("one_hot", f"""
SELECT id, """ + ", ".join(f"""CAST(coalesce(priority = '{p}', false) AS INT) AS "priority_{p}" """ for p in
                           ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")) + f" FROM {GAPPY_SQL}")
def one_hot(spark, sf_dir):
    return E.one_hot(gappy(spark, sf_dir).select("id", "priority"), "priority")


@query("label_encode", f"""
SELECT id, priority, priority_encoded, cust, cust_encoded FROM {GAPPY_SQL}
LEFT JOIN (SELECT priority, CAST(row_number() OVER (ORDER BY priority) - 1 AS BIGINT) AS priority_encoded
           FROM (SELECT DISTINCT priority FROM {GAPPY_SQL} WHERE priority IS NOT NULL)) USING (priority)
LEFT JOIN (SELECT cust, CAST(row_number() OVER (ORDER BY cust) - 1 AS BIGINT) AS cust_encoded
           FROM (SELECT DISTINCT cust FROM {GAPPY_SQL})) USING (cust)""")
def label_encode(spark, sf_dir):
    return E.label_encode(gappy(spark, sf_dir).select("id", "priority", "cust"), ["priority", "cust"])


@query("string_index_frequency", f"""
WITH t AS (SELECT id, priority FROM {GAPPY_SQL}),
     k AS (SELECT priority, CAST(row_number() OVER (ORDER BY count(*) DESC, priority) - 1 AS DOUBLE) AS i
           FROM t WHERE priority IS NOT NULL GROUP BY priority)
SELECT t.id, t.priority, coalesce(k.i, CAST((SELECT count(*) FROM k) AS DOUBLE)) AS "priorityIndex"
FROM t LEFT JOIN k ON t.priority = k.priority""")
def string_index_frequency(spark, sf_dir):
    return E.string_index_frequency(gappy(spark, sf_dir).select("id", "priority"), ["priority"])


@query("string_index_frequency_large", """
WITH k AS (SELECT CAST(l_partkey AS VARCHAR) AS part, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(l_partkey AS VARCHAR)) - 1 AS DOUBLE) AS i
           FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_linenumber, k.part, i AS "partIndex" FROM lineitem JOIN k ON CAST(l_partkey AS VARCHAR) = k.part""")
def string_index_frequency_large(spark, sf_dir):
    """As many values as there are parts."""
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"))
    return E.string_index_frequency(df, ["part"])


@query("one_hot_sparse", f"""
SELECT id, cust, CAST(dense_rank() OVER (ORDER BY cust) - 1 AS DOUBLE) AS position, 1.0::DOUBLE AS total,
 CAST((SELECT count(DISTINCT cust) FROM {GAPPY_SQL}) AS INT) AS size FROM {GAPPY_SQL}""")
def one_hot_sparse(spark, sf_dir):
    """The place of the 1, the sum and the length of every vector."""
    out = E.one_hot_sparse(gappy(spark, sf_dir).select("id", "cust"), "cust")
    # read from the stored places, "(size,[places],[values])": as an array every vector would be as long as there are values
    stored = out.withColumn("_text", F.col("cust_vector").cast("string"))
    part = lambda i, kind: F.from_json(F.concat(F.lit("["), F.regexp_extract("_text", SPARSE, i), F.lit("]")), f"array<{kind}>")
    return stored.withColumns({"_places": part(2, "int"), "_values": part(3, "double")}).select(
        "id", "cust", F.coalesce(F.get("_places", F.array_position("_values", 1.0).cast("int") - 1).cast("double"), F.lit(-1.0)).alias("position"),
        F.aggregate("_values", F.lit(0.0), lambda a, x: a + x).alias("total"), F.regexp_extract("_text", SPARSE, 1).cast("int").alias("size"))


@query("minmax_params", " UNION ALL ".join(
    f"SELECT '{c}' AS name, min({c}) + 0.0 AS min, max({c}) + 0.0 AS max, round(1.0 / (max({c}) - min({c})), 9) AS scale FROM lineitem"
    for c in MEASURES))
def minmax_params(spark, sf_dir):
    return rounded(E.fit_minmax(measures(spark, sf_dir), MEASURES), 9, "scale")


@query("minmax_scale", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round(({c} - (SELECT min({c}) FROM lineitem)) / (SELECT max({c}) - min({c}) FROM lineitem), 9) + 0.0 AS {c}" for c in MEASURES)
       + " FROM lineitem")
def minmax_scale(spark, sf_dir):
    df = measures(spark, sf_dir)
    return rounded(E.apply_minmax(df, E.fit_minmax(df, MEASURES)), 9, *MEASURES)


def _pairs_sql(fn: str, name: str, pairs) -> str:
    made = ", ".join(f'round({fn.format(a=a, b=b)}, 9) + 0.0 AS "{name.format(a=a, b=b)}"' for a, b in pairs)
    return f"SELECT l_orderkey, l_linenumber, {made} FROM lineitem"


def _made(df):
    made = [c for c in df.columns if c not in ("l_orderkey", "l_linenumber", *MEASURES)]
    return rounded(df.drop(*MEASURES), 9, *made)


@query("pairwise_products", _pairs_sql("{a} * {b}", "{a}_x_{b}", combinations_with_replacement(MEASURES, 2)))
def pairwise_products(spark, sf_dir):
    return _made(E.pairwise(measures(spark, sf_dir), MEASURES, with_self=True))


@query("pairwise_cross", _pairs_sql("{a} * {b}", "{a}_{b}", combinations(MEASURES, 2)))
def pairwise_cross(spark, sf_dir):
    return _made(PairwiseProduct(inputCols=MEASURES).transform(measures(spark, sf_dir)))


@query("squares", _pairs_sql("{a} * {a}", "{a}_square", [(c, c) for c in MEASURES]))
def squares(spark, sf_dir):
    return _made(Square(inputCols=MEASURES).transform(measures(spark, sf_dir)))


@query("pairwise_max", _pairs_sql("greatest({a}, {b})", "max_{a}_{b}", combinations(MEASURES, 2)))
def pairwise_max(spark, sf_dir):
    return _made(E.pairwise(measures(spark, sf_dir), MEASURES, "max", name="max_{a}_{b}"))


@query("assemble_vector", """
SELECT l_orderkey, l_linenumber, l_quantity AS v0, l_discount + 0.0 AS v1, l_tax + 0.0 AS v2 FROM lineitem""")
def assemble_vector(spark, sf_dir):
    vector = vector_to_array(F.col("features"))
    values = E.assemble(measures(spark, sf_dir), MEASURES).select(
        "l_orderkey", "l_linenumber", *[(vector[i] + 0.0).alias(f"v{i}") for i in range(3)])
    return values


@query("split_by_key", f"""
SELECT o_orderkey, CASE WHEN {draw_sql('o_orderkey', repr('split'))} < 0.9 THEN 'train' ELSE 'test' END AS part FROM orders""")
def split_by_key(spark, sf_dir):
    train, test = P.split_by_key(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 0.9)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("split_stratified", f"""
SELECT o_orderkey, o_orderstatus, CASE WHEN r <= floor(n * 0.9 + 0.5) THEN 'train' ELSE 'test' END AS part FROM (
 SELECT o_orderkey, o_orderstatus, count(*) OVER (PARTITION BY o_orderstatus) AS n,
  row_number() OVER (PARTITION BY o_orderstatus ORDER BY {draw_sql('o_orderkey', repr('split'))}, o_orderkey) AS r FROM orders)""")
def split_stratified(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    train, test = P.split_stratified(orders, "o_orderkey", "o_orderstatus", 0.9)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("sample_fraction", f"SELECT o_orderkey, o_totalprice FROM orders WHERE {draw_sql('o_orderkey', repr('sample'))} < 0.01")
def sample_fraction(spark, sf_dir):
    return P.sample_by_key(table(spark, sf_dir, "orders"), "o_orderkey", 0.01).select("o_orderkey", "o_totalprice")


@query("fold_by_key", f"SELECT o_orderkey, CAST(floor({draw_sql('o_orderkey', repr('fold'))} * 5) AS INT) AS fold FROM orders")
def fold_by_key(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", draws.fold_by_key(F.col("o_orderkey"), 5).alias("fold"))


@query("minmax_test_part", f"""
WITH t AS (SELECT o_orderkey, o_totalprice, {draw_sql('o_orderkey', repr('split'))} < 0.8 AS train FROM orders),
     r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM t WHERE train)
SELECT o_orderkey, round((o_totalprice - lo) / (hi - lo), 9) + 0.0 AS o_totalprice FROM t, r WHERE NOT train""")
def minmax_test_part(spark, sf_dir):
    """Test rows scaled by the ranges of the training rows."""
    train, test = P.split_by_key(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 0.8)
    return rounded(E.apply_minmax(test, E.fit_minmax(train, ["o_totalprice"])), 9, "o_totalprice")
