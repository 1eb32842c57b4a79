"""Sources, sinks and staged steps: every query writes a table and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.catalog.registry import query, rounded, table, text
from tabkit.operators.stats import word_count
from tabkit.operators.validity import drop_null_subset
from tabkit.plans import extract
from tabkit.runtime import scratch_path
from tabkit.sources.published import Publication
from tabkit.sources.readers import inline, read_csv, read_jsonl, read_mixed, read_parquet, read_text, read_xml
from tabkit.sources.rescue import read_mixed_rescued
from tabkit.sources.staging import run_step, stage, table_shape
from tabkit.sources.writers import write_csv, write_jsonl, write_parquet, write_text, write_xml

CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
PART_SCHEMA = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"

# Published shares by segment, one of them without a match in the data.
SEGMENT_RATES = [("FURNITURE", 47.35, 41.81), ("MACHINERY", 67.54, 68.33), ("BUILDING", 3.58, 11.61), ("GARDEN", 10.82, 15.09)]
SEGMENT_RATES_SCHEMA = "segment string, male double, female double"
SEGMENT_RATES_SQL = ("(VALUES ('FURNITURE', 47.35::DOUBLE, 41.81::DOUBLE), ('MACHINERY', 67.54, 68.33),"
                     " ('BUILDING', 3.58, 11.61), ('GARDEN', 10.82, 15.09)) AS rates(segment, male, female)")


@query("scan_csv_infer", "SELECT * FROM customer")
def scan_csv_infer(spark, sf_dir):
    path = write_csv(table(spark, sf_dir, "customer"), scratch_path(spark, "csv"))
    return read_csv(spark, path).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("scan_csv_schema", "SELECT * FROM customer")
def scan_csv_schema(spark, sf_dir):
    path = write_csv(table(spark, sf_dir, "customer"), scratch_path(spark, "csv"), header=False)
    return read_csv(spark, path, CUSTOMER_SCHEMA, header=False)


@query("scan_jsonl", "SELECT * FROM part")
def scan_jsonl(spark, sf_dir):
    path = write_jsonl(table(spark, sf_dir, "part"), scratch_path(spark, "json"))
    return read_jsonl(spark, path, PART_SCHEMA)


@query("scan_xml", "SELECT * FROM supplier")
def scan_xml(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    path = write_xml(supplier, scratch_path(spark, "xml"))
    return read_xml(spark, path, "row", supplier.schema)


@query("scan_parquet_roundtrip", "SELECT * FROM orders")
def scan_parquet_roundtrip(spark, sf_dir):
    first, second = table(spark, sf_dir, "orders").randomSplit([0.5, 0.5], seed=1)
    paths = [write_parquet(part, scratch_path(spark, "parquet")) for part in (first, second)]
    return read_parquet(spark, paths)


@query("extract_mixed_formats", "SELECT *, CAST(p_partkey % 3 AS INT) AS source_rank FROM part")
def extract_mixed_formats(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in part.schema.fields])
    share = {name: part.filter(F.col("p_partkey") % 3 == rank) for rank, name in enumerate(("csv", "json", "xml"))}
    paths = {
        "csv": write_csv(share["csv"], scratch_path(spark, "csv")),
        "json": write_jsonl(share["json"], scratch_path(spark, "json")),
        "xml": write_xml(share["xml"], scratch_path(spark, "xml")),
    }
    return read_mixed(spark, paths, schema)


# Customers as lines of text, of which some hold no number where one belongs, are cut short or have a field too many.
# Per format: a line, whether it is broken, and whether the segment and the nation are missing from a good one.
BROKEN = {
    "csv": ("CAST(c_custkey AS STRING) || ',' || c_mktsegment || ',' || CASE c_custkey % 7 WHEN 0 THEN 'n/a' WHEN 1 THEN '' WHEN 2 THEN '1,2' ELSE CAST(c_nationkey AS STRING) END",
            "c_custkey % 7 IN (0, 2)", "false", "c_custkey % 7 = 1"),
    "json": ("'{\"c_custkey\":' || CAST(c_custkey AS STRING) || CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN ',\"c_nationkey\":\"many\"}'"
             " WHEN 2 THEN '}' ELSE ',\"c_mktsegment\":\"' || c_mktsegment || '\",\"c_nationkey\":' || CAST(c_nationkey AS STRING) || '}' END",
             "c_custkey % 5 IN (0, 1)", "c_custkey % 5 = 2", "c_custkey % 5 = 2"),
}
BROKEN_SQL = " UNION ALL ".join(f"""
SELECT {rank} AS source_rank, NOT ({bad}) AS good, CASE WHEN NOT ({bad}) THEN c_custkey END AS c_custkey,
 CASE WHEN NOT ({bad}) AND NOT {no_segment} THEN c_mktsegment END AS c_mktsegment, CASE WHEN NOT ({bad}) AND NOT {no_nation} THEN c_nationkey END AS c_nationkey,
 CASE WHEN {bad} THEN {line} END AS raw FROM customer""" for rank, (line, bad, no_segment, no_nation) in enumerate(BROKEN.values()))


@query("rescued_records", BROKEN_SQL)
def rescued_records(spark, sf_dir):
    """Two formats with broken records: the good ones by column, the others as they stand in the files."""
    customer = table(spark, sf_dir, "customer")
    paths = {fmt: write_text(customer, F.expr(line), scratch_path(spark, fmt)) for fmt, (line, *_) in BROKEN.items()}
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_mktsegment", T.StringType()), T.StructField("c_nationkey", T.IntegerType())])
    good, bad = read_mixed_rescued(spark, paths, schema, header=False)
    return good.withColumn("good", F.lit(True)).unionByName(bad.drop("file").withColumn("good", F.lit(False)), allowMissingColumns=True)


@query("extract_flow", """
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, source_rank FROM (
 SELECT p_partkey, p_name, p_brand, p_type, p_size, round(p_retailprice, 1) + 0.0 AS p_retailprice, CAST(p_partkey % 3 AS INT) AS source_rank FROM part)
QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY source_rank, p_partkey) = 1""")
def extract_flow(spark, sf_dir):
    """Three formats, rounded prices, one row per type."""
    part = table(spark, sf_dir, "part")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in part.schema.fields])
    share = {name: part.filter(F.col("p_partkey") % 3 == rank) for rank, name in enumerate(("csv", "json", "xml"))}
    writers = {"csv": write_csv, "json": write_jsonl, "xml": write_xml}
    paths = {name: writers[name](df, scratch_path(spark, name)) for name, df in share.items()}
    return extract.run(spark, paths, schema, "p_type", "p_retailprice", ["p_partkey"], 1)


@query("scan_text_lines", """
SELECT line, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
GROUP BY line""")
def scan_text_lines(spark, sf_dir):
    path = write_text(table(spark, sf_dir, "documents"), F.col("text"), scratch_path(spark, "text"))
    lines = read_text(spark, path).withColumnRenamed("value", "line")
    return lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query("stage_table_roundtrip", "SELECT * FROM customer")
def stage_table_roundtrip(spark, sf_dir):
    return stage(table(spark, sf_dir, "customer"), "staged_customer")


@query("inline_rates", f"""
SELECT c_custkey, c_mktsegment, male, female FROM customer JOIN {SEGMENT_RATES_SQL} ON c_mktsegment = segment""")
def inline_rates(spark, sf_dir):
    rates = inline(spark, SEGMENT_RATES, SEGMENT_RATES_SCHEMA)
    customer = table(spark, sf_dir, "customer")
    return customer.join(rates, customer.c_mktsegment == rates.segment).select("c_custkey", "c_mktsegment", "male", "female")


@query("sink_csv_roundtrip", "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def sink_csv_roundtrip(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return read_csv(spark, write_csv(orders, scratch_path(spark, "csv")), orders.schema)


WORDS_SQL = """
SELECT trim(word, '.,;:!?"''') AS word, CAST(count(*) AS BIGINT) AS count
FROM (SELECT unnest(string_split(line, ' ')) AS word
      FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents))
GROUP BY 1 HAVING count(*) >= 3"""


def document_lines(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("line"))


@query("word_count", WORDS_SQL)
def count_words(spark, sf_dir):
    return word_count(document_lines(spark, sf_dir), "line")


@query("sink_text", f"SELECT '(''' || word || ''', ' || CAST(count AS VARCHAR) || ')' AS value FROM ({WORDS_SQL})")
def sink_text(spark, sf_dir):
    counts = word_count(document_lines(spark, sf_dir), "line")
    line = text("('", F.col("word"), "', ", F.col("count"), ")")
    return read_text(spark, write_text(counts, line, scratch_path(spark, "text")))


@query("staged_step", """
SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS orders, round(avg(o_totalprice), 4) AS mean_price,
       (SELECT CAST(count(*) AS BIGINT) FROM orders WHERE o_custkey % 13 <> 0) AS kept
FROM orders WHERE o_custkey % 13 <> 0 GROUP BY o_orderpriority""")
def staged_step(spark, sf_dir):
    gap = F.when(F.col("o_custkey") % 13 != 0, F.col("o_totalprice"))
    stage(table(spark, sf_dir, "orders").withColumn("o_totalprice", gap), "raw_orders")

    def clean(tables):
        kept = drop_null_subset(tables["raw_orders"], ["o_totalprice"])
        return {"clean_orders": kept}, {"kept": kept.count()}

    def total(tables):
        groups = tables["clean_orders"].groupBy("o_orderpriority")
        return {"order_totals": groups.agg(F.count(F.lit(1)).alias("orders"), F.avg("o_totalprice").alias("mean_price"))}, {}

    metrics = run_step(spark, clean, ["raw_orders"], ["clean_orders"], drop=["raw_orders"])
    run_step(spark, total, ["clean_orders"], ["order_totals"])
    return rounded(spark.table("order_totals").withColumn("kept", F.lit(metrics["kept"]).cast("bigint")), 4, "mean_price")


@query("published_steps", """
SELECT version, o_orderpriority, CAST(count(*) AS BIGINT) AS orders, round(avg(o_totalprice), 4) AS mean_price,
       (SELECT CAST(count(*) AS BIGINT) FROM orders WHERE o_custkey % 13 <> 0) AS kept
FROM orders, (VALUES (1), (2)) AS v(version) WHERE version = 1 OR o_custkey % 13 <> 0 GROUP BY version, o_orderpriority""")
def published_steps(spark, sf_dir):
    """Orders and their totals, published together in two versions; a reader of the first still has it when the second is there."""
    shop = Publication(spark, scratch_path(spark, "published"))

    def totals(orders):
        return orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"), F.avg("o_totalprice").alias("mean_price"))

    orders = table(spark, sf_dir, "orders")
    shop.publish({"orders": orders, "totals": totals(orders)})
    before = shop.snapshot()

    def clean(tables):
        kept = tables["orders"].where(F.col("o_custkey") % 13 != 0)
        return {"orders": kept, "totals": totals(kept)}, {"kept": kept.count()}

    metrics = shop.run_step(clean, ["orders"], ["orders", "totals"])
    both = [s.read("totals").withColumn("version", F.lit(i + 1)) for i, s in enumerate((before, shop.snapshot()))]
    return rounded(both[0].unionByName(both[1]).withColumn("kept", F.lit(metrics["kept"]).cast("bigint")), 4, "mean_price")


@query("table_shape", """
SELECT CAST(p AS INT) AS position, c AS column_name, t AS data_type, (SELECT CAST(count(*) AS BIGINT) FROM customer) AS row_count
FROM (VALUES (0, 'c_custkey', 'bigint'), (1, 'c_name', 'string'), (2, 'c_nationkey', 'int'), (3, 'c_acctbal', 'double'),
             (4, 'c_mktsegment', 'string')) AS shape(p, c, t)""")
def shape(spark, sf_dir):
    return table_shape(table(spark, sf_dir, "customer"))
