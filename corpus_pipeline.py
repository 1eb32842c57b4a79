"""Corpus pipeline: five operators of ``tabkit.llm`` clean a document table and encode what is left.

Each stage takes the documents its predecessor kept and returns the columns of documents; the last returns pieces. What the
operators state about NULLs, empty and long texts, ties, repeated rows, empty tables and further columns holds for the stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.llm import leaks, lines, near, pieces, quality
from tabkit.llm.queries import tokenizer_file
from tabkit.runtime import settle


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field, trained on the labelled ones among them, scores 0.7 or more; a text without a word goes."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs go; a document that loses its last word goes with them. ``n_chars`` follows the text."""
    done = lines.dedup_lines(docs)
    lost = F.col(f"`{done.columns[-1]}`")
    kept = done.where((lost == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(lost > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the least id."""
    return near.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return leaks.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces and pieces of every document."""
    encoded = pieces.encode_pieces(docs, pieces.load(tokenizer_file("piece_bpe_32k.model")))
    return encoded.select("doc_id", F.size("pieces").cast("long").alias("n_pieces"), "pieces")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("sentence_pieces", sentence_pieces),
]

ORACLE_SQL = None  # a trained field and a vocabulary cannot be said in SQL; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; each stage's documents are stored for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
