"""Equality, band and outer joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabkit.catalog.gaps import AGE_RATES, SEX_AGE_RATES, values_sql
from tabkit.catalog.io import SEGMENT_RATES, SEGMENT_RATES_SCHEMA, SEGMENT_RATES_SQL
from tabkit.catalog.registry import GAPPY_SQL, gappy, query, rounded, table
from tabkit.operators import joins as J
from tabkit.operators import missing as M
from tabkit.operators import outliers as O
from tabkit.runtime import scratch_path
from tabkit.sources.readers import inline
from tabkit.sources.writers import write_bucketed


@query("join_full_outer", f"""
SELECT c_custkey, c_mktsegment, segment, male, female FROM customer FULL OUTER JOIN {SEGMENT_RATES_SQL} ON c_mktsegment = segment""")
def join_full_outer(spark, sf_dir):
    rates = inline(spark, SEGMENT_RATES, SEGMENT_RATES_SCHEMA)
    joined = J.join_full_outer(table(spark, sf_dir, "customer"), rates, "c_mktsegment", "segment")
    return joined.select("c_custkey", "c_mktsegment", "segment", "male", "female")


@query("join_band", f"""
SELECT g.id, g.age, a.lo, a.hi, CAST(a.prob AS DOUBLE) AS prob FROM {GAPPY_SQL} AS g
LEFT JOIN {values_sql(AGE_RATES, 'a(lo, hi, prob)')} ON g.age >= a.lo AND (a.hi IS NULL OR g.age <= a.hi)""")
def join_band(spark, sf_dir):
    bands = inline(spark, AGE_RATES, "lo int, hi int, prob double")
    return J.join_band(gappy(spark, sf_dir).select("id", "age"), bands, "age")


@query("join_eq_band", f"""
SELECT g.id, g.age, g.sex, s.lo, s.hi, CAST(s.prob AS DOUBLE) AS prob FROM {GAPPY_SQL} AS g
JOIN {values_sql(SEX_AGE_RATES, 's(grp, lo, hi, prob)')} ON g.sex = s.grp AND g.age >= s.lo AND (s.hi IS NULL OR g.age <= s.hi)""")
def join_eq_band(spark, sf_dir):
    bands = inline(spark, SEX_AGE_RATES, "grp int, lo int, hi int, prob double")
    joined = J.join_band(gappy(spark, sf_dir).select("id", "age", "sex"), bands, "age", "inner", ("sex", "grp"))
    return joined.drop("grp")


# Bands that grow with the data: twice the price of every part, and a little more.
@query("join_band_large", """
SELECT l_suppkey, CAST(count(*) AS BIGINT) AS hits, CAST(sum(p_partkey) AS BIGINT) AS keys
FROM lineitem JOIN part ON l_extendedprice / l_quantity >= p_retailprice * 2
 AND l_extendedprice / l_quantity <= p_retailprice * 2.0002 GROUP BY 1""")
def join_band_large(spark, sf_dir):
    bands = table(spark, sf_dir, "part").selectExpr("p_retailprice * 2 AS lo", "p_retailprice * 2.0002D AS hi", "p_partkey")
    prices = table(spark, sf_dir, "lineitem").selectExpr("l_suppkey", "l_extendedprice / l_quantity AS price")
    found = J.join_band(prices, bands, "price", "inner", totals=["p_partkey"])
    return found.groupBy("l_suppkey").agg(F.sum("hits").alias("hits"), F.sum("p_partkey").alias("keys"))


SPREAD = ["SELECT p_retailprice * 2 AS lo, p_retailprice * 2.0002 AS hi, p_partkey FROM part",
          "SELECT CAST(1e12 AS DOUBLE), CAST(1.1e12 AS DOUBLE), -1", "SELECT CAST(0 AS DOUBLE), CAST(1e6 AS DOUBLE), -2",
          "SELECT CAST(4000 AS DOUBLE), CAST(NULL AS DOUBLE), -3", "SELECT CAST(5 AS DOUBLE), CAST(4 AS DOUBLE), -4"]


@query("join_band_spread", f"""
SELECT l_suppkey, CAST(count(*) AS BIGINT) AS hits, CAST(sum(p_partkey) AS BIGINT) AS keys
FROM lineitem JOIN ({' UNION ALL '.join(SPREAD)}) ON l_extendedprice / l_quantity >= lo AND (hi IS NULL OR l_extendedprice / l_quantity <= hi) GROUP BY 1""")
def join_band_spread(spark, sf_dir):
    """Tightly packed bands with a far, a very long, an open-ended and a reversed one among them."""
    bands = table(spark, sf_dir, "part").selectExpr("p_retailprice * 2 AS lo", "p_retailprice * 2.0002D AS hi", "p_partkey")
    bands = bands.unionByName(inline(spark, [(1e12, 1.1e12, -1), (0.0, 1e6, -2), (4000.0, None, -3), (5.0, 4.0, -4)], "lo double, hi double, p_partkey bigint"))
    prices = table(spark, sf_dir, "lineitem").selectExpr("l_suppkey", "l_extendedprice / l_quantity AS price")
    found = J.join_band(prices, bands, "price", "inner", totals=["p_partkey"])
    return found.groupBy("l_suppkey").agg(F.sum("hits").alias("hits"), F.sum("p_partkey").alias("keys"))


@query("join_by_row_key", """
SELECT event_id, value, round(value * 2.0, 6) + 0.0 AS twice FROM events""")
def join_by_row_key(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    extra = events.select("event_id", (F.col("value") * 2.0).alias("twice"))
    return rounded(J.join_by_row_key(events.select("event_id", "value"), extra, "event_id"), 6, "twice")


@query("join_bucketed", """
SELECT o_orderkey, o_totalprice, CAST(count(*) AS BIGINT) AS lines, round(sum(l_quantity), 4) AS quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2""")
def join_bucketed(spark, sf_dir):
    """Orders and lines, both stored by the order's key: joined and summed where they lie."""
    orders, lines = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    write_bucketed(orders, "orders_by_key", scratch_path(spark, "bucketed"), ["o_orderkey"], 8)
    write_bucketed(lines, "lines_by_order", scratch_path(spark, "bucketed"), ["l_orderkey"], 8)
    joined = J.join_by_row_key(spark.table("orders_by_key"), spark.table("lines_by_order").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")
    return rounded(joined.groupBy("o_orderkey", "o_totalprice").agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity")), 4, "quantity")


# Surcharge by price band, the last band open-ended.
SURCHARGES = [(0.0, 99999.99, 0.01), (100000.0, 199999.99, 0.02), (200000.0, 399999.99, 0.03), (400000.0, None, 0.05)]


@query("clean_and_rate", f"""
WITH g AS (SELECT id, price, priority FROM {GAPPY_SQL}),
 m AS (SELECT priority AS v FROM g WHERE priority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
 f AS (SELECT id, coalesce(price, (SELECT avg(price) FROM g)) AS price, coalesce(priority, v) AS priority FROM g, m),
 s AS (SELECT avg(price) AS a, stddev_samp(price) AS d FROM f),
 k AS (SELECT f.* FROM f, s WHERE price BETWEEN a - 2 * d AND a + 2 * d)
SELECT priority, CAST(count(*) AS BIGINT) AS orders, round(avg(CAST(rate AS DOUBLE)), 6) AS mean_rate, round(avg(price), 4) AS mean_price
FROM k LEFT JOIN {values_sql(SURCHARGES, 'b(lo, hi, rate)')} ON price >= lo AND (hi IS NULL OR price <= hi)
GROUP BY priority""")
def clean_and_rate(spark, sf_dir):
    """Fill, remove outliers, attach the surcharge band and average by priority."""
    df = gappy(spark, sf_dir).select("id", "price", "priority")
    df = M.impute_mean(M.impute_mode(df, ["priority"]), ["price"])
    df = O.outliers_onepass(df, ["price"], 2.0)
    df = J.join_band(df, inline(spark, SURCHARGES, "lo double, hi double, rate double"), "price")
    groups = df.groupBy("priority").agg(F.count(F.lit(1)).alias("orders"), F.avg("rate").alias("mean_rate"),
                                        F.avg("price").alias("mean_price"))
    return rounded(rounded(groups, 6, "mean_rate"), 4, "mean_price")
