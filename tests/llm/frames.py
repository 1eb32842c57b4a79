"""Small frames with the cases that every operator has to bear."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

CLASHING = ("id", "print", "host", "gone", "row", "pos", "label", "score", "kept", "t", "k", "node", "c0", "p1", "removed_lines", "lost", "blocks", "words")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed: int, words: int, per_line: int = 12) -> str:
    draw = random.Random(seed)
    out = [draw.choice(WORDS) + str(draw.randrange(50)) for _ in range(words)]
    return "\n".join(" ".join(out[i:i + per_line]) for i in range(0, words, per_line))


def edge_rows() -> list[tuple]:
    long = prose(1, 60_000)
    same = prose(2, 120)
    return [
        (1, None, "en", "a", None), (2, "", None, None, 0), (3, " \n\t ", "en", "a", 4), (None, same, "en", "a", 1), (None, None, None, None, None),
        (5, long, "en", "b", len(long)), (6, same, "en", "a", 7), (6, same, "en", "a", 7), (6, prose(3, 80), "de", "b", 9), (8, same, "fr", None, 2),
        (9, "one two three", "en", "a", 13), (10, "é日本🙂 naïve Straße\r\n x", "fr", "a", 1), (11, "a\x00b ￿", "en", "b", 3),
    ]


def edge_docs(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """The cases, with further columns whose names operators might use for themselves."""
    docs = spark.createDataFrame(edge_rows() if rows is None else rows, SCHEMA)
    return docs.selectExpr("*", *[f"concat('{c}', doc_id) AS {c}" for c in CLASHING])


def empty_docs(spark: SparkSession) -> DataFrame:
    return edge_docs(spark, [])


def labels(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    return spark.createDataFrame([] if rows is None else rows, "doc_id bigint, quality int, toxic int")
