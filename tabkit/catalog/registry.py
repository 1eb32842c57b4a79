"""Registration of queries, and the derived tables several of them share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    """Doubles at a stated precision; adding zero turns a negative zero into a plain one."""
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) + F.lit(0.0) for c in cols})


def text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def draw_sql(key: str, salt: str) -> str:
    """The keyed uniform draw in SQL; ``key`` and ``salt`` are SQL texts."""
    return (f"(CAST(CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || ':' || {salt}), 1, 13) AS BIGINT) AS DOUBLE)"
            " / CAST(4503599627370496 AS DOUBLE))")


# Orders with gaps: price, priority, flag and age are missing for some keys. The same text runs in both engines.
GAPPY_COLUMNS = [
    "o_orderkey AS id",
    "o_custkey AS cust",
    "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price",
    "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS priority",
    "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_custkey % 3 AS INT) END AS flag",
    "CASE WHEN o_orderkey % 6 = 1 THEN NULL ELSE CAST(18 + o_custkey % 70 AS INT) END AS age",
    "CAST(o_orderkey % 2 AS INT) AS sex",
]
GAPPY_SQL = f"(SELECT {', '.join(GAPPY_COLUMNS)} FROM orders)"

# Orders as text with cells that are no numbers.
DIRTY_COLUMNS = [
    "o_orderkey AS id",
    "CASE o_orderkey % 10 WHEN 0 THEN NULL WHEN 1 THEN '-3.5' WHEN 2 THEN '1e5' WHEN 3 THEN ' 42 ' WHEN 4 THEN '1.2.3'"
    " WHEN 5 THEN 'nan' WHEN 6 THEN 'abc' WHEN 7 THEN '.5' WHEN 8 THEN '1.5f' ELSE CAST(o_custkey AS STRING) END AS a",
    "CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '12.' WHEN 2 THEN '1_000' WHEN 3 THEN ''"
    " WHEN 4 THEN '3 4' ELSE CAST(o_orderkey AS STRING) END AS b",
]
DIRTY_SQL = f"(SELECT {', '.join(DIRTY_COLUMNS)} FROM orders)"


def gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*GAPPY_COLUMNS)


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*DIRTY_COLUMNS)
