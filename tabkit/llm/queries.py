"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.llm import huffman, leaks, lines, mixing, near, pages, pieces, prefixes, quality, ranked, rules, secrets, toxicity
from tabkit.runtime import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn
    return register


def tokenizer_file(name: str) -> str:
    """Where the public tokenizer of that name lies on the driver; its content is sent to the tasks."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query(rules.SQL)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(documents(spark, sf_dir)).drop("cleaned_text")


@query()
def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    huffman.write_ids(documents(spark, sf_dir), path, tokenizer_file("byte_bpe_50k.json"))
    return huffman.read_ids(spark, path, digest=True)


@query()
def op3_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = pieces.load(tokenizer_file("piece_bpe_32k.model"))
    encoded = pieces.encode_pieces(documents(spark, sf_dir), vocabulary)
    return pieces.decode_pieces(encoded, vocabulary).select(
        "doc_id", F.size("pieces").cast("long").alias("n_pieces"), "pieces", F.crc32(F.col("text").cast("binary")).alias("decoded_crc32"))


@query()
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


@query()
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(documents(spark, sf_dir))
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", number("assign"), number("access"), number("hex"),
                        F.sha2(secrets.spans_text(F.col("base")), 256).alias("base_sha256"),
                        secrets.spans_text(F.col("spans")).alias("spans"))


@query()
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(documents(spark, sf_dir), labels(spark, sf_dir))


@query()
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = pages.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query()
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(documents(spark, sf_dir))


@query()
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(documents(spark, sf_dir))


@query(mixing.SQL)
def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(documents(spark, sf_dir))


@query(ranked.SQL)
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query(prefixes.SQL)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
