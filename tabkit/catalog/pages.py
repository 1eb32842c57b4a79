"""Lists and tables of web pages, rates from sentences."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabkit.catalog.registry import GAPPY_SQL, draw_sql, gappy, query, rounded, table
from tabkit.catalog.scalars import strip_sql
from tabkit.operators import html as H
from tabkit.operators import missing as M
from tabkit.runtime import settle

@query("html_list_items", f"""
SELECT page_id, CAST(pos AS INT) AS item_no, {strip_sql('items[pos + 1]')} AS item
FROM (SELECT page_id, items, unnest(range(len(items))) AS pos
      FROM (SELECT page_id, regexp_extract_all(html, '(?is)<li\\b[^>]*>(.*?)</li>', 1) AS items FROM pages))""")
def html_list_items(spark, sf_dir):
    return H.html_list_items(table(spark, sf_dir, "pages").select("page_id", "html"), "html")


# One page per order with two tables; the second lists the order and ends with a row of a single cell.
ORDER_PAGE = ("'<html><body><table><tr><td>menu</td></tr></table><p>x</p><TABLE class=\"t\"><thead><tr><th>Field</th><th>Value</th></tr>"
              "</thead><tbody>\n<tr><td>status</td><td> <b>' || o_orderstatus || '</b>&nbsp;</td></tr><tr><td>customer</td><td>'"
              " || CAST(o_custkey AS STRING) || '<br></td></tr><tr><td>' || o_orderpriority || '</td></tr></tbody></TABLE></body></html>'")


@query("html_table_rows", """
SELECT o_orderkey, row_no, is_header, c[1] AS field, c[2] AS value FROM (
 SELECT o_orderkey, 0 AS row_no, true AS is_header, ['Field', 'Value'] AS c FROM orders
 UNION ALL SELECT o_orderkey, 1, false, ['status', o_orderstatus] FROM orders
 UNION ALL SELECT o_orderkey, 2, false, ['customer', CAST(o_custkey AS VARCHAR)] FROM orders
 UNION ALL SELECT o_orderkey, 3, false, [o_orderpriority, '150'] FROM orders)""")
def html_table_rows(spark, sf_dir):
    pages = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(ORDER_PAGE.replace("\n", "\\n")).alias("html"))
    rows = H.html_table_rows(pages, "html", 1)
    return rows.select("o_orderkey", "row_no", "is_header", F.col("cells")[0].alias("field"), F.col("cells")[1].alias("value"))


# One page per order without end tags of cells, rows and items, with a table inside a cell and numeric references.
LEGAL_PAGE = ("'<table><tr><th>Field<th>Value<tr><td>status<td><table><tr><td>' || o_orderstatus || '</table> &amp; <i>more</i><tr><td>'"
              " || CAST(o_custkey AS STRING) || '&#8211;&#x31;</table><ul class=menu><li>home<li>' || o_orderpriority || '</ul>"
              "<div class=\"x rates\"><ul><li>aged 18&#8211;24 (' || CAST(o_custkey % 9 AS STRING) || '.5%)<li>aged 25 and older (7%)</ul></div>'")


def legal_pages(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.expr(LEGAL_PAGE).alias("html"))


@query("html_table_rows_legal", """
SELECT o_orderkey, table_no, row_no, is_header, c[1] AS field, c[2] AS value FROM (
 SELECT o_orderkey, 0 AS table_no, 0 AS row_no, true AS is_header, ['Field', 'Value'] AS c FROM orders
 UNION ALL SELECT o_orderkey, 0, 1, false, ['status', o_orderstatus || ' & more'] FROM orders
 UNION ALL SELECT o_orderkey, 0, 2, false, [CAST(o_custkey AS VARCHAR) || '–1', '150'] FROM orders
 UNION ALL SELECT o_orderkey, 1, 0, false, [o_orderstatus, '150'] FROM orders)""")
def html_table_rows_legal(spark, sf_dir):
    pages = legal_pages(spark, sf_dir)
    rows = [H.html_table_rows(pages, "html", n).withColumn("table_no", F.lit(n)) for n in (0, 1)]
    return rows[0].unionByName(rows[1]).select("o_orderkey", "table_no", "row_no", "is_header", F.col("cells")[0].alias("field"), F.col("cells")[1].alias("value"))


@query("html_list_items_chosen", """
SELECT o_orderkey, 'menu' AS taken, unnest([0, 1]) AS item_no, unnest(['home', o_orderpriority]) AS item FROM orders
UNION ALL SELECT o_orderkey, 'rates', unnest([0, 1]), unnest(['aged 18–24 (' || CAST(o_custkey % 9 AS VARCHAR) || '.5%)', 'aged 25 and older (7%)']) FROM orders""")
def html_list_items_chosen(spark, sf_dir):
    """The first list of the page, and the list in a container."""
    pages = legal_pages(spark, sf_dir)
    menu = H.html_list_items(pages, "html", list_no=0).withColumn("taken", F.lit("menu"))
    return menu.unionByName(H.html_list_items(pages, "html", container="rates").withColumn("taken", F.lit("rates")))


@query("rates_from_pages", """
SELECT o_orderkey, 18 AS lo, 24 AS hi, o_custkey % 9 + 0.5::DOUBLE AS rate FROM orders
UNION ALL SELECT o_orderkey, 25, NULL, 7.0::DOUBLE FROM orders""")
def rates_from_pages(spark, sf_dir):
    """From pages to rates: the items of one container, read as sentences."""
    return H.rates_from_text(H.html_list_items(legal_pages(spark, sf_dir), "html", container="rates"), "item").drop("item", "item_no")


# One sentence per part about an age band and a share.
RATE_TEXT = ("'Nearly ' || CAST(p_size AS STRING) || ' of every 100 adults aged ' || CAST(p_size AS STRING)"
             " || CASE WHEN p_partkey % 4 = 0 THEN ' years and older' ELSE '–' || CAST(p_size + 9 AS STRING) || ' years' END"
             " || ' (' || CAST(p_size AS STRING) || '.' || CAST(p_partkey % 10 AS STRING) || '%)'")
RATES_SQL = """SELECT p_partkey, p_size AS lo, CASE WHEN p_partkey % 4 <> 0 THEN p_size + 9 END AS hi,
 CAST(CAST(p_size AS VARCHAR) || '.' || CAST(p_partkey % 10 AS VARCHAR) AS DOUBLE) AS rate FROM part"""


@query("rates_from_text", RATES_SQL)
def rates_from_text(spark, sf_dir):
    sentences = table(spark, sf_dir, "part").select("p_partkey", F.expr(RATE_TEXT).alias("sentence"))
    return H.rates_from_text(sentences, "sentence").drop("sentence")


@query("scale_rates", f"""
SELECT grp, lo, hi, round(rate * CASE grp WHEN 1 THEN 13.1::DOUBLE / 10.1::DOUBLE ELSE 1 END / 100, 8) AS prob
FROM ({RATES_SQL}), (VALUES (0), (1)) AS sexes(grp)""")
def scale_rates(spark, sf_dir):
    sentences = table(spark, sf_dir, "part").select("p_partkey", F.expr(RATE_TEXT).alias("sentence"))
    return rounded(H.scale_rates(H.rates_from_text(sentences, "sentence"), 13.1, 10.1), 8, "prob")


# A page with one list of rates, an item for each region: bands of 16 years from 5 on.
BANDS_SQL = "(SELECT 5 + 16 * r_regionkey AS lo, 20 + 16 * r_regionkey AS hi, (7.5 + 3 * r_regionkey)::DOUBLE AS rate FROM region)"


@query("flags_from_pages", f"""
SELECT g.id, g.sex, g.age, coalesce(CASE WHEN g.flag > 1 THEN 1 ELSE g.flag END, greatest(
    coalesce(CAST({draw_sql('g.id', repr('first'))} < a.rate / 100 AS INT), 0),
    coalesce(CAST({draw_sql('g.id', repr('second'))} < a.rate * CASE g.sex WHEN 1 THEN 13.1::DOUBLE / 10.1::DOUBLE ELSE 1 END / 100 AS INT), 0))) AS flag
FROM {GAPPY_SQL} AS g LEFT JOIN {BANDS_SQL} AS a ON g.age BETWEEN a.lo AND a.hi""")
def flags_from_pages(spark, sf_dir):
    """From a page to rates, from rates to filled flags."""
    item = F.expr("'<li>adults aged ' || (5 + 16 * r_regionkey) || '&#8211;' || (20 + 16 * r_regionkey) || ' years (' || (7.5 + 3 * r_regionkey) || '%)'")
    items = F.array_join(F.array_sort(F.collect_list(item)), "")
    page = table(spark, sf_dir, "region").agg(F.concat(F.lit("<ul><li>menu</ul><div class='card rates'><ul>"), items, F.lit("</ul></div>")).alias("html"))
    bands = settle(H.rates_from_text(H.html_list_items(page, "html", container="rates"), "item").select("lo", "hi", "rate"), "rates")
    flag = F.least(F.col("flag"), F.lit(1))
    df = gappy(spark, sf_dir).select("id", "sex", "age", F.when(F.col("flag").isNotNull(), flag).alias("flag"))
    return M.impute_by_rate(df, "flag", "id", "age", "sex", bands.withColumn("prob", F.col("rate") / 100), H.scale_rates(bands, 13.1, 10.1))
