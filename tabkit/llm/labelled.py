"""Labelled rows for training: a stored sample of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.runtime import settle


def remainder(id_col: Column, of: int) -> Column:
    """crc32 of the id as text, modulo a number; -1 for a NULL id."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(of)).cast("int"), F.lit(-1))


def training_rows(df: DataFrame, labels: DataFrame, label: str, most: int, folds: int, held_out: int,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored (label, text) of about ``most`` labelled documents, or of all if there are fewer.

    Rows whose id falls into the held-out fold are never taken. The draw hashes the id, so it is the same on every run; its
    share is set by the number of labelled ids. A NULL label is no label; an id labelled twice counts by its greater label.
    """
    known = (labels.select(F.col(f"`{id_col}`").alias("k"), F.col(f"`{label}`").cast("int").alias("label")).where("k IS NOT NULL AND label IS NOT NULL")
             .where(remainder(F.col("k"), folds) != held_out).groupBy("k").agg(F.max("label").alias("label")))
    share = min(1.0, most / max(1, known.count()))
    drawn = known.where(F.pmod(F.xxhash64(F.lit("draw"), "k"), F.lit(1_000_000)) < int(share * 1_000_000))
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    # about `most` rows of two numbers at most, so they can go to every task
    return settle(docs.join(F.broadcast(drawn), F.col("id") == F.col("k")).select("label", "text"), "labelled")
