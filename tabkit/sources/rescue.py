"""Readers that keep what they cannot read.

Plain readers turn a cell of the wrong kind into NULL. These put the whole record aside instead, as it stands in the file and with the file's
name. A record is good if every field can be read as its type, and, in CSV, if it has as many fields as the schema. Whether a record is good
must not depend on the columns a query happens to use, so the files are parsed once, with all columns, and stored; both sides are
filters over what is stored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.columns import ref
from tabkit.operators.missing import nan_to_null
from tabkit.runtime import settle

RAW, FILE = "_raw_record", "_source_file"


class Rescued(NamedTuple):
    """``good`` has the columns of the schema, ``bad`` the columns file and raw."""

    good: DataFrame
    bad: DataFrame


def read_rescued(spark: SparkSession, path: str, fmt: str, schema: T.StructType, **options) -> Rescued:
    """Files of one format ("csv", "json" or "xml"; options as for Spark's reader) as good records and those set aside.

    Missing fields of JSON and XML are NULL and good, as are empty cells and NaN (Spark's option ``nanValue`` names another spelling);
    blank lines are no records.
    """
    if fmt not in ("csv", "json", "xml"):
        raise ValueError(f"{fmt} has no records to set aside")
    taken = {RAW, FILE} & set(schema.fieldNames())
    if taken:
        raise ValueError(f"the names {sorted(taken)} are taken")
    wide = T.StructType([*(T.StructField(f.name, f.dataType) for f in schema.fields), T.StructField(RAW, T.StringType())])
    reader = spark.read.format(fmt).schema(wide).options(mode="PERMISSIVE", columnNameOfCorruptRecord=RAW, **options)
    parsed = settle(reader.load(path).withColumn(FILE, F.col("_metadata.file_path")), "rescued")
    good = parsed.where(ref(RAW).isNull()).select(*[ref(f.name) for f in schema.fields])
    bad = parsed.where(ref(RAW).isNotNull()).select(ref(FILE).alias("file"), ref(RAW).alias("raw"))
    return Rescued(nan_to_null(good, text=True), bad)


def read_mixed_rescued(spark: SparkSession, paths: dict[str, str], schema: T.StructType, row_tag: str = "row", header: bool = True) -> Rescued:
    """CSV, JSON-lines and XML folders appended, with ``source_rank``, the order in which they were named, on both sides."""
    options = {"csv": {"header": header}, "xml": {"rowTag": row_tag}}
    good, bad = None, None
    for rank, (fmt, path) in enumerate(paths.items()):
        part = [side.withColumn("source_rank", F.lit(rank)) for side in read_rescued(spark, path, fmt, schema, **options.get(fmt, {}))]
        good, bad = part if good is None else (good.unionByName(part[0]), bad.unionByName(part[1]))
    return Rescued(good, bad)
