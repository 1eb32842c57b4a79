"""Line dedup: a suffix array over the line-id sequences of all documents, built by distributed prefix doubling.

Lines with a word, stripped at both ends, are the letters of the array; every document is a sequence of them. Round 0 ranks
the lines that occur more than once by a global sort. Round k sorts the pairs of neighbouring ranks, which gives the order
of all suffixes by their first 2^k lines. A suffix whose prefix occurs only once is settled and leaves, so the rounds shrink
to the text that really repeats. A run of at least ``least_words`` words has at most that many lines, hence rounds beyond
log2(least_words), or beyond the longest part that is still open, cannot change a decision and are not run.

A run of l lines is named by its ranks of the first and the last 2^k lines (2^k <= l < 2^(k+1)). All suffixes with one
name form an LCP interval of the array: they are the occurrences of one repeated run. Maximal runs are covered by their
shortest parts with enough words, those that cannot be shortened at the end and those that cannot at the start: a line is
in a repeated run of at least ``least_words`` words exactly if it is in a repeated part of one of the two kinds. Every
occurrence but the first, by (doc_id, place), is a later copy, and its lines go.

Everything is joins, windows over one document and aggregates that add up before they shuffle; a line that half of all
documents hold is counted before the shuffle, and the joins on it are ones that Spark splits. Each round is written to the
shared folder, so a lost executor costs one round at most.

Cases: NULL and empty texts have no line and stay as they are; rows that repeat an id and a text are one document and get
equal results; documents with equal ids and different texts are ordered by a hash of the text; NULL ids come last; copies
within one document count; an empty table gives an empty result; extra input columns stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkit.llm.text import SPACE, ragged, runs, slices, span_hashes, text_bytes
from tabkit.llm.stored import store
from tabkit.runtime import settle

LEAST_WORDS = 50


def split_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of every line with a word: the text it is in, its number there, its first and end byte without outer white space, and its words."""
    starts, ends = runs(~SPACE[data], offsets)  # words
    if not len(starts):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    owner = np.searchsorted(offsets, starts, side="right") - 1
    feeds = np.concatenate([[0], np.cumsum(data == 10)])
    line = feeds[starts] - feeds[offsets[owner]]
    new = np.ones(len(starts), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (line[1:] != line[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return owner[first], line[first], starts[first], ends[last], last - first + 1


def shortest_runs(words: np.ndarray, owner: np.ndarray, texts: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of the runs of lines of one text with ``least`` words or more that are shortest from their start or to their end."""
    sums = np.concatenate([[0], np.cumsum(words)])
    of = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=texts))])
    at = np.arange(len(words))
    end = np.searchsorted(sums, sums[:-1] + least, side="left")  # first end with enough words
    begin = np.searchsorted(sums, sums[1:] - least, side="right") - 1  # last start with enough words
    forward, backward = end <= of[owner + 1], begin >= of[owner]
    wide = len(words) + 1
    both = np.unique(np.concatenate([at[forward] * wide + (end - at)[forward], begin[backward] * wide + (at + 1 - begin)[backward]]))
    return both // wide, both % wide


def _lines(docs: DataFrame, least: int) -> DataFrame:
    """id, print, pos (among the lines with a word), h1, h2 (the line's hash) and the lengths of the shortest runs that start here."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = text_bytes(part.column(2))
                owner, _, starts, ends, words = split_lines(data, offsets)
                first = np.searchsorted(owner, owner, side="left")
                places, lengths = shortest_runs(words, owner, part.num_rows, least)
                of = np.searchsorted(places, np.arange(len(owner) + 1))
                row = pa.array(owner)
                yield pa.record_batch([part.column(0).take(row), part.column(1).take(row), pa.array((np.arange(len(owner)) - first).astype(np.int32)),
                                       pa.array(span_hashes(data, starts, ends).view(np.int64)), pa.array((ends - starts).astype(np.int32)),
                                       pa.ListArray.from_arrays(pa.array(of.astype(np.int32)), pa.array(lengths.astype(np.int32)))],
                                      ["id", "print", "pos", "h1", "h2", "parts"])

    return docs.select("id", "print", "text").mapInArrow(task, "id bigint, print bigint, pos int, h1 bigint, h2 int, parts array<int>")


def _ranked(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with ``rank``, their place in the global order of such keys (dense from 0)."""
    often = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    ordered = store(often.repartitionByRange(*keys).sortWithinPartitions(*keys)
                     .select(*keys, F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("at")), "rank")
    ranges = ordered.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("least"))
    base = ranges.select(F.col("range").alias("r"), "least", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("base"))
    return ordered.join(base, F.col("range") == F.col("r")).select(*keys, (F.col("base") + F.col("at") - F.col("least")).alias("rank"))


def repeated_parts(lines: DataFrame, least: int, also: tuple[str, ...] = ()) -> DataFrame:
    """id, print, pos and l of every shortest run whose lines all repeat, with the names ``a``, ``b`` of its LCP interval and
    the columns ``also`` of its first line."""
    ranked = _ranked(lines, ["h1", "h2"]).withColumnsRenamed({"h1": "k1", "h2": "k2"})
    ranks = (lines.join(ranked, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")))
             .select("id", "print", "pos", *also, "parts", "rank").repartition("id", "print").dropDuplicates(["id", "print", "pos"]))
    found, size = [], 1
    while True:
        ranks = store(ranks, "suffixes")
        here = Window.partitionBy("id", "print").orderBy("pos").rangeBetween(0, size)
        seen = ranks.withColumn("ahead", F.collect_list(F.struct("pos", "rank")).over(here))

        def rank_at(pos: Column) -> Column:  # NULL where a line between occurs once only
            return F.get(F.filter("ahead", lambda x: x["pos"] == pos), F.lit(0))["rank"]

        own = seen.select("id", "print", "pos", *also, "rank", "ahead", F.explode("parts").alias("l")).where(F.col("l").between(size, 2 * size - 1))
        found.append(own.select("id", "print", "pos", *also, "l", F.col("rank").alias("a"), rank_at(F.col("pos") + F.col("l") - size).alias("b")).where("b IS NOT NULL"))
        size *= 2
        longest = ranks.agg(F.max(F.array_max("parts"))).first()[0]
        if longest is None or longest < size:
            return reduce(DataFrame.unionByName, found)
        longer = F.filter("parts", lambda n: n >= size)
        pairs = seen.select("id", "print", "pos", *also, longer.alias("parts"), F.col("rank").alias("a"), rank_at(F.col("pos") + size // 2).alias("b")).where("b IS NOT NULL")
        order = _ranked(pairs, ["a", "b"]).withColumnsRenamed({"a": "ka", "b": "kb"})
        ranks = pairs.join(order, (F.col("a") == F.col("ka")) & (F.col("b") == F.col("kb"))).select("id", "print", "pos", *also, "parts", "rank")


def _order() -> Column:
    return F.struct(F.col("id").isNull().alias("last"), "id", "print", "pos")


def later_copies(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(id, print, gone): the runs (pos, l) of lines with a word that are later copies. ``docs``: id, print, text."""
    lines = settle(_lines(docs, least_words), "lines")
    parts = settle(repeated_parts(lines, least_words), "parts")
    first = (parts.groupBy("l", "a", "b").agg(F.min(_order()).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
             .select(F.col("l").alias("kl"), F.col("a").alias("ka"), F.col("b").alias("kb"), "first"))
    first = store(first, "first")  # the join then shuffles both sides itself, and Spark may split a run that very many documents hold
    later = parts.join(first, (F.col("l") == F.col("kl")) & (F.col("a") == F.col("ka")) & (F.col("b") == F.col("kb"))).where(_order() > F.col("first"))
    return later.groupBy("id", "print").agg(F.collect_set(F.struct("pos", "l")).alias("gone"))


def without_runs(text: str, gone: list[dict]) -> tuple[str, int]:
    """The text without the lines that the runs (pos, l) cover, and their number."""
    data = np.frombuffer(text.encode(), np.uint8)
    line = split_lines(data, np.array([0, len(data)]))[1]
    drop = set(line[np.unique(ragged(np.array([p["pos"] for p in gone]), np.array([p["l"] for p in gone])))].tolist())
    return "\n".join(s for i, s in enumerate(text.split("\n")) if i not in drop), len(drop)


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """The input with ``text_col`` freed of later copies, and last the number of lines it lost, ``removed_lines`` (bigint).

    If the input has a column of that name, the number's name gets underscores at its end.
    """
    lost = "removed_lines"
    while lost.lower() in {c.lower() for c in df.columns}:
        lost += "_"
    id_, text = F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`").cast("string")
    docs = df.select(id_.alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("print"), F.coalesce(text, F.lit("")).alias("text"))
    gone = later_copies(docs, least_words).withColumnsRenamed({"id": "k_id", "print": "k_print"})
    rest = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns) if c != text_col])
    whole = df.select(rest.alias("row"), id_.alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("print"), text.alias("text"))
    joined = whole.join(gone, F.col("id").eqNullSafe(F.col("k_id")) & (F.col("print") == F.col("k_print")), "left").select("row", "text", "gone")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, runs_ = batch.column(1), batch.column(2)
            hit = runs_.is_valid()
            left = [without_runs(t, g) for t, g in zip(texts.filter(hit).to_pylist(), runs_.filter(hit).to_pylist())]
            count = np.zeros(batch.num_rows, np.int64)
            count[hit.to_numpy(zero_copy_only=False)] = [n for _, n in left]
            if left:
                texts = pc.replace_with_mask(texts, hit, pa.array([t for t, _ in left], texts.type))
            yield pa.record_batch([batch.column(0), texts, pa.array(count)], ["row", "text", "lost"])

    done = joined.mapInArrow(task, f"row {joined.schema['row'].dataType.simpleString()}, text string, lost bigint")
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.c{i}").alias(c) for i, c in enumerate(df.columns)], F.col("lost").alias(lost))
