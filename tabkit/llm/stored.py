"""Small frames of iterations, stored in fewer files and removed when the next round no longer needs them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tabkit.runtime import delete, scratch_path


def store(df: DataFrame, label: str) -> DataFrame:
    """Write and read back a frame that is small beside the input: four shuffle partitions share a file, as long as that keeps
    all cores busy."""
    spark = df.sparkSession
    files = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    path = scratch_path(spark, label)
    df.coalesce(files).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a frame that ``store`` gave, once nothing reads it any more."""
    delete(df.sparkSession, df.stored_at)
