"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabkit.catalog.registry import draw_sql, query, rounded, table, text
from tabkit.functions import draws as D
from tabkit.functions import numbers as N
from tabkit.functions import text as X


@query("str_strip", """
SELECT p_partkey, trim('  ' || p_name || ' ') AS spaces, trim('?!' || p_name || '.,', '.,;:!?"''') AS marks FROM part""")
def str_strip(spark, sf_dir):
    name = F.col("p_name")
    return table(spark, sf_dir, "part").select(
        "p_partkey", X.str_strip(text("  ", name, " ")).alias("spaces"),
        X.str_strip(text("?!", name, ".,"), X.WORD_STRIP_CHARS).alias("marks"))


# One sentence per line item; some hold no percentage.
SHARE_TEXT = ("'about ' || CAST(l_linenumber AS STRING) || '.' || CAST(l_orderkey % 10 AS STRING)"
              " || CASE WHEN l_orderkey % 4 = 0 THEN ' in all' ELSE '% of 7% in ' END || l_returnflag")


@query("extract_percentage", f"""
SELECT l_orderkey, l_linenumber, TRY_CAST(nullif(regexp_extract({SHARE_TEXT}, '(\\d+(?:\\.\\d+)?)%', 1), '') AS DOUBLE) AS pct
FROM lineitem""")
def extract_percentage(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    return lineitem.select("l_orderkey", "l_linenumber", X.extract_percentage(F.expr(SHARE_TEXT)).alias("pct"))


AGE_TEXT = ("'adults aged ' || CAST(p_size AS STRING) || CASE WHEN p_partkey % 3 = 0 THEN ' and older'"
            " ELSE '–' || CAST(p_size + 10 AS STRING) END || ' years'")


@query("extract_age_range", f"""
SELECT p_partkey, TRY_CAST(nullif(regexp_extract({AGE_TEXT}, 'aged (\\d+)–(\\d+)', 1), '') AS INT) AS lo,
       TRY_CAST(nullif(regexp_extract({AGE_TEXT}, 'aged (\\d+)–(\\d+)', 2), '') AS INT) AS hi FROM part""")
def extract_age_range(spark, sf_dir):
    ages = table(spark, sf_dir, "part").select("p_partkey", X.extract_age_range(F.expr(AGE_TEXT)).alias("ages"))
    return ages.select("p_partkey", "ages.lo", "ages.hi")


@query("extract_numbers", """
SELECT doc_id, CAST(pos AS INT) AS pos, TRY_CAST(numbers[pos + 1] AS BIGINT) AS number
FROM (SELECT doc_id, numbers, unnest(range(len(numbers))) AS pos
      FROM (SELECT doc_id, regexp_extract_all(text, '\\d+') AS numbers FROM documents))""")
def extract_numbers(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", F.posexplode(X.extract_numbers(F.col("text"))).alias("pos", "number"))


# The references that the test pages hold.
ENTITIES_SQL = ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")


def strip_sql(x: str) -> str:
    text = f"regexp_replace({x}, '(?s)<!--.*?-->|<[^>]*>', '', 'g')"
    for entity, char in ENTITIES_SQL:
        text = f"replace({text}, '{entity}', '{char}')"
    return f"regexp_replace(trim(regexp_replace({text}, '[ \\t\\r\\n]+', ' ', 'g')), '&nbsp;|' || chr(160), '', 'g')"


@query("strip_markup", f"SELECT page_id, {strip_sql('html')} AS content FROM pages")
def strip_markup(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.strip_markup(F.col("html")).alias("content"))


@query("round_price", "SELECT l_orderkey, l_linenumber, round_even(l_extendedprice / 7.0, 2) AS price FROM lineitem")
def round_price(spark, sf_dir):
    price = N.round_half_even(F.col("l_extendedprice") / 7.0, 2)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", price.alias("price"))


@query("array_band", """
SELECT p_partkey, p_size AS lo, CASE WHEN p_partkey % 3 <> 0 THEN p_size + 10 END AS hi FROM part""")
def array_band(spark, sf_dir):
    ages = F.when(F.col("p_partkey") % 3 == 0, F.array("p_size")).otherwise(F.array(F.col("p_size"), F.col("p_size") + 10))
    return table(spark, sf_dir, "part").select("p_partkey", N.band_from_array(ages).alias("band")).select("p_partkey", "band.*")


@query("array_map", """
SELECT vec_id, CAST(pos AS INT) AS pos, CAST(embedding[pos + 1] AS DOUBLE) * 2 AS doubled
FROM (SELECT vec_id, embedding, unnest(range(len(embedding))) AS pos FROM embeddings)""")
def array_map(spark, sf_dir):
    doubled = N.array_map(F.col("embedding"), lambda x: x.cast("double") * 2)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(doubled).alias("pos", "doubled"))


@query("code_to_label", "SELECT event_id, dayname(ts) AS weekday FROM events")
def code_to_label(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", N.code_to_label(F.weekday("ts") + 1).alias("weekday"))


@query("row_max", """
SELECT l_orderkey, l_linenumber, greatest(l_quantity, CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_discount * 300 END) AS larger
FROM lineitem""")
def row_max(spark, sf_dir):
    other = F.when(F.col("l_orderkey") % 3 != 0, F.col("l_discount") * 300)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", N.row_max(F.col("l_quantity"), other).alias("larger"))


@query("same_value", "SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) = o_custkey % 5 AS same FROM orders")
def same_value(spark, sf_dir):
    same = N.same_value(F.substring("o_orderpriority", 1, 1), F.col("o_custkey") % 5)
    return table(spark, sf_dir, "orders").select("o_orderkey", same.alias("same"))


@query("bernoulli_by_key", f"SELECT o_orderkey, CAST({draw_sql('o_orderkey', repr('0'))} < 0.3 AS INT) AS flag FROM orders")
def bernoulli_by_key(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", D.bernoulli_by_key(F.col("o_orderkey"), 0.3).alias("flag"))


@query("gaussian_noise", f"""
SELECT o_orderkey, round(1.2 * sqrt(-2.0 * ln(1.0 - {draw_sql('o_orderkey', repr('0a'))}))
  * cos(2.0 * pi() * {draw_sql('o_orderkey', repr('0b'))}), 6) + 0.0 AS noise FROM orders""")
def gaussian_noise(spark, sf_dir):
    noise = table(spark, sf_dir, "orders").select("o_orderkey", D.normal_by_key(F.col("o_orderkey"), 1.2).alias("noise"))
    return rounded(noise, 6, "noise")
