"""Projections, casts, filters, duplicates, order and union."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabkit.catalog.registry import DIRTY_SQL, GAPPY_SQL, dirty, gappy, query, table, text
from tabkit.columns import float_cols, numeric_cols
from tabkit.operators import projection as P
from tabkit.operators import validity as V


@query("project_columns", "SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem")
def project_columns(spark, sf_dir):
    return P.project(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_quantity", "l_returnflag"])


@query("drop_columns", "SELECT p_partkey, p_brand, p_type, p_size FROM part")
def drop_columns(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumnRenamed("p_name", "name(of part")
    return P.drop_columns(part, ["name(of part", "p_retailprice"])


@query("columns_by_role", "SELECT p_size, p_retailprice FROM part")
def columns_by_role(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return P.project(part, numeric_cols(part, exclude=["p_partkey"]))


@query("bulk_cast", """
SELECT l_orderkey, l_linenumber, CAST(trunc(l_quantity) AS INT) AS l_quantity, CAST(trunc(l_extendedprice) AS INT) AS l_extendedprice,
       CAST(trunc(l_discount) AS INT) AS l_discount, CAST(trunc(l_tax) AS INT) AS l_tax FROM lineitem""")
def bulk_cast(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").drop("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate")
    return P.cast_all(lineitem, float_cols(lineitem), "int")


@query("trim_strings", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def trim_strings(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    padded = customer.select("c_custkey", text("  ", F.col("c_name")).alias("c_name"),
                             text(" ", F.col("c_mktsegment"), "   ").alias("c_mktsegment"))
    return P.trim_strings(padded)


PLAIN_SQL = "({c} IS NULL OR regexp_full_match({c}, '[0-9]+\\.?[0-9]*|\\.[0-9]+'))"
READABLE_SQL = ("({c} IS NULL OR regexp_full_match(trim({c}), "
                "'[+-]?(([0-9](_?[0-9])*(\\.([0-9](_?[0-9])*)?)?|\\.[0-9](_?[0-9])*)([eE][+-]?[0-9](_?[0-9])*)?|(?i)inf(inity)?|nan)'))")


@query("valid_rows_pattern", f"SELECT * FROM {DIRTY_SQL} WHERE {PLAIN_SQL.format(c='a')} AND {PLAIN_SQL.format(c='b')}")
def valid_rows_pattern(spark, sf_dir):
    return V.valid_rows_pattern(dirty(spark, sf_dir), ["a", "b"])


@query("valid_rows_parse", f"SELECT * FROM {DIRTY_SQL} WHERE {READABLE_SQL.format(c='a')} AND {READABLE_SQL.format(c='b')}")
def valid_rows_parse(spark, sf_dir):
    return V.valid_rows_parse(dirty(spark, sf_dir), ["a", "b"])


@query("filter_between", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity BETWEEN 30 AND 50")
def filter_between(spark, sf_dir):
    return P.filter_between(table(spark, sf_dir, "lineitem"), "l_quantity", 30, 50).select("l_orderkey", "l_linenumber", "l_quantity")


@query("filter_eq", "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_eq(spark, sf_dir):
    return P.filter_eq(table(spark, sf_dir, "customer"), "c_mktsegment", "BUILDING")


@query("drop_null_rows", f"""
SELECT * FROM {GAPPY_SQL} WHERE price IS NOT NULL AND priority IS NOT NULL AND flag IS NOT NULL AND age IS NOT NULL""")
def drop_null_rows(spark, sf_dir):
    return V.drop_null_rows(gappy(spark, sf_dir))


@query("drop_rows_thresh", f"""
SELECT * FROM {GAPPY_SQL} WHERE CAST(price IS NOT NULL AS INT) + CAST(priority IS NOT NULL AS INT)
 + CAST(flag IS NOT NULL AS INT) + CAST(age IS NOT NULL AS INT) >= 3""")
def drop_rows_thresh(spark, sf_dir):
    return V.drop_rows_thresh(gappy(spark, sf_dir), 0.7 * 4, ["price", "priority", "flag", "age"])


@query("drop_null_subset", f"SELECT * FROM {GAPPY_SQL} WHERE flag IS NOT NULL")
def drop_null_subset(spark, sf_dir):
    return V.drop_null_subset(gappy(spark, sf_dir), ["flag"])


@query("drop_sparse_columns", f"SELECT id, cust, price, age, sex FROM {GAPPY_SQL}")
def drop_sparse_columns(spark, sf_dir):
    return V.drop_sparse_columns(gappy(spark, sf_dir), 0.82)


@query("drop_empty_columns", f"SELECT * FROM {GAPPY_SQL}")
def drop_empty_columns(spark, sf_dir):
    return V.drop_empty_columns(gappy(spark, sf_dir).withColumn("empty", F.lit(None).cast("double")))


@query("case_replace", f"""
SELECT id, CASE WHEN price >= 400000 THEN 1.5 WHEN price <= 1000 THEN 0.5 ELSE price END AS price FROM {GAPPY_SQL}""")
def case_replace(spark, sf_dir):
    rules = [(F.col("price") >= 400000, 1.5), (F.col("price") <= 1000, 0.5)]
    return P.case_replace(gappy(spark, sf_dir).select("id", "price"), "price", rules)


@query("dedup_keep_first", """
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""")
def dedup_keep_first(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    first = V.dedup_first(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return first.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


@query("top_one", "SELECT l_suppkey, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 1")
def top_one(spark, sf_dir):
    counts = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return P.top_n(counts, [F.desc("n"), F.asc("l_suppkey")], 1)


@query("limit_n", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def limit_n(spark, sf_dir):
    return P.top_n(table(spark, sf_dir, "orders"), [F.asc("o_orderkey")], 5)


@query("union_all", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""")
def union_all(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance")
    supplier = table(spark, sf_dir, "supplier").selectExpr("s_acctbal AS balance", "s_name AS name", "s_suppkey AS id")
    return P.union_all(customer, supplier)


@query("repartition", "SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY event_type")
def repartition(spark, sf_dir):
    return P.spread(table(spark, sf_dir, "events"), 8).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
