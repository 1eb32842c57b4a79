"""Mixing sources to target weights, by weighted fair queueing.

The documents of a source stand in a queue, shuffled by a hash, and the queue may be served ``most`` times over. A copy's virtual
finish time is the number of words its source has served with it, divided by the source's weight. All copies are sorted by finish
time over the whole table, and those before the point where the words in a row pass the budget are the mix. A source whose queue
is empty leaves its share to the others in proportion to their weights, so the words taken of each come within about a document
of its target: its weight times one common level, or ``most`` times its size where that is less.

Queues are cut into slices of the hash, about ``SLICE_ROWS`` rows of the whole table each: running sums are taken inside a slice
of a source and start from the sums of the slices before it, so a source with most of the rows is many tasks. Copies are then
dealt to ranges of finish times; only in the range where the budget ends is each copy looked at, the others count as a whole.
What returns to the driver is one level, one range and one point. All frames behind the first hold numbers only.

Cases: NULL and empty texts have no words and are never taken; a NULL source is a source of its own, the last one; rows that
repeat a document are documents of their own, which stand side by side in the queue; NULL ids are kept; equal finish times of
two sources go by the order of the sources; an empty table, or one without words, takes nothing; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabkit.llm.stored import store
from tabkit.operators.features import label_encode
from tabkit.runtime import settle

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST = 2
SLICE_ROWS = 5_000
DIGITS = 15  # hexadecimal digits of the hash that orders a queue


def _queued(df: DataFrame, id_col: str, text_col: str, source_col: str, slice_rows: int) -> DataFrame:
    """Stored (id, s, size, h, slice): s names the source, '' for NULL; h orders its queue; a slice is a range of h."""
    text, source = F.col(f"`{text_col}`").cast("string"), F.col(f"`{source_col}`").cast("string")
    ident = F.col(f"`{id_col}`").cast("bigint")
    rows = df.select(
        ident.alias("id"), F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("s"),
        F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("bigint").alias("size"),
        F.conv(F.substring(F.md5(F.concat_ws(":", F.lit("mix"), ident.cast("string"), text).cast("binary")), 1, DIGITS), 16, 10).cast("bigint").alias("h"))
    rows = settle(rows, "sized")
    slices = max(1, math.ceil(rows.count() / slice_rows))
    return rows.withColumn("slice", F.shiftright(F.shiftright("h", 4 * DIGITS - 32) * F.lit(slices).cast("bigint"), 32))


def rotating_weights(sources: DataFrame, weights: Sequence[int]) -> DataFrame:
    """The sources (s, source_size) with ``place``, their position by code points with NULL last, and a weight by turns."""
    named = sources.withColumn("name", F.when(F.col("s") != "", F.substring(F.col("s"), 2, 2**31 - 1)))
    coded = label_encode(named, ["name"], "_place")
    known = named.where("name IS NOT NULL").count()
    place = F.coalesce(F.col("name_place"), F.lit(known)).cast("bigint")
    turns = F.array(*[F.lit(int(w)).cast("bigint") for w in weights])
    return coded.select("s", "source_size", place.alias("place"), F.get(turns, (place % len(weights)).cast("int")).alias("weight"))


def fair_level(sources: DataFrame, budget: float, most: int) -> float:
    """Words per unit of weight that use up the budget when no source gives more than ``most`` times its size; infinite if none does.

    Starts without limits; sources above theirs are set to it and the rest is shared anew, until none is above. A round is one sum
    over the sources.
    """
    level = None
    while True:
        full = F.lit(False) if level is None else F.col("source_size") * most <= F.col("weight") * F.lit(level)
        given, weight = sources.agg(F.sum(F.when(full, F.col("source_size") * most)), F.sum(F.when(~full, F.col("weight")))).first()
        if not weight:
            return math.inf
        new = (budget - (given or 0)) / weight
        if level is not None and new <= level:
            return level
        level = new


def _finish(served: Column) -> Column:
    return served.cast("double") / F.col("weight").cast("double")


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = WEIGHTS,
                budget: float = BUDGET, most: int = MOST, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per input row: the id, size (words), source_size, target (of its source), taken (words, repeats counted)
    and finish (virtual time of the first copy).

    Sources weigh ``weights`` by turns in the order of their names and share ``budget`` times all words; a document is taken
    ``most`` times at most. Documents are taken whole.
    """
    if most < 1 or budget < 0 or not weights or min(weights) <= 0:
        raise ValueError("weights and most must be positive, the budget must not be negative")
    rows = _queued(df, id_col, text_col, source_col, slice_rows)
    totals = store(rows.groupBy("s", "slice").agg(F.sum("size").alias("words")), "slices")
    sources = store(rotating_weights(totals.groupBy("s").agg(F.sum("words").alias("source_size")), weights), "sources")
    total = budget * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level = fair_level(sources, total, most)

    # one row per slice of a source, with the words before it
    before = F.sum("words").over(W.partitionBy("s").orderBy("slice")) - F.col("words")
    starts = totals.select("s", "slice", before.alias("before")).join(sources, "s").select(
        F.col("s").alias("k"), F.col("slice").alias("part"), "before", "source_size", "place", "weight")
    served = F.sum("size").over(W.partitionBy("s", "slice").orderBy("h", "id", "size").rowsBetween(W.unboundedPreceding, 0))
    queue = settle(rows.withColumn("served", served).join(starts, (F.col("s") == F.col("k")) & (F.col("slice") == F.col("part")))
                   .select("id", "size", (F.col("served") + F.col("before")).alias("served"), "source_size", "place", "weight"), "queue")

    copies = queue.where("size > 0").withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(most - 1)))).select(
        _finish(F.col("served") + F.col("round") * F.col("source_size")).alias("finish"), "place", "size")
    # stored, because a range computed anew could begin elsewhere
    ranged = settle(copies.repartitionByRange("finish", "place").withColumn("range", F.spark_partition_id()), "finish")
    ends = ranged.groupBy("range").agg(F.sum("size").alias("words"))
    over = ends.withColumn("upto", F.sum("words").over(W.orderBy("range"))).where(F.col("upto") > F.lit(total)).orderBy("range").first()
    if over is None:
        taken = F.lit(most)
    else:
        inside = ranged.where(F.col("range") == over["range"])
        run = F.sum("size").over(W.orderBy("finish", "place").rowsBetween(W.unboundedPreceding, 0)) + F.lit(over["upto"] - over["words"])
        finish, place = inside.withColumn("run", run).where(F.col("run") > F.lit(total)).agg(F.min(F.struct("finish", "place"))).first()[0]
        taken = sum(((F.struct(_finish(F.col("served") + F.lit(i) * F.col("source_size")), F.col("place"))
                      < F.struct(F.lit(finish), F.lit(place).cast("bigint"))).cast("int") for i in range(most)), F.lit(0))
    target = F.least(F.col("weight") * F.lit(level), (F.col("source_size") * most).cast("double"))
    return queue.select(F.col("id").alias(id_col), "size", "source_size", target.alias("target"),
                        (F.col("size") * taken).cast("bigint").alias("taken"), _finish(F.col("served")).alias("finish"))


SQL = r"""
WITH docs AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(concat_ws(':', 'mix', doc_id, text)), 1, 15))::BIGINT AS h FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM docs GROUP BY source),
weighed AS (SELECT *, [3, 1, 2][place % 3 + 1]::BIGINT AS weight FROM sources),
filled AS (SELECT *, sum(2 * source_size) OVER o AS given, sum(weight) OVER () - sum(weight) OVER o AS rest FROM weighed
    WINDOW o AS (ORDER BY 2 * source_size / weight, place)),
levels AS (SELECT (1.5::DOUBLE * (SELECT sum(size) FROM docs) - coalesce(given, 0))::DOUBLE / rest AS level FROM
    (SELECT given, rest FROM filled WHERE rest > 0 UNION ALL SELECT 0, sum(weight) FROM weighed)),
level AS (SELECT max(level) AS level FROM levels),
queue AS (SELECT doc_id, size, source_size, place, weight, sum(size) OVER (PARTITION BY place ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS served
    FROM docs JOIN weighed ON docs.source IS NOT DISTINCT FROM weighed.source),
copies AS (SELECT doc_id, place, served, size, (served + r * source_size)::DOUBLE / weight AS finish FROM queue, (VALUES (0), (1)) v(r) WHERE size > 0),
run AS (SELECT *, sum(size) OVER (ORDER BY finish, place ROWS UNBOUNDED PRECEDING) AS run FROM copies),
taken AS (SELECT doc_id, place, served, sum(size) AS taken FROM run WHERE run <= 1.5::DOUBLE * (SELECT sum(size) FROM docs) GROUP BY ALL)
SELECT q.doc_id, q.size, q.source_size, least(q.weight * level, 2 * q.source_size)::DOUBLE AS target, coalesce(t.taken, 0)::BIGINT AS taken,
    q.served::DOUBLE / q.weight AS finish
FROM queue q CROSS JOIN level LEFT JOIN taken t ON q.doc_id IS NOT DISTINCT FROM t.doc_id AND q.place = t.place AND q.served = t.served AND q.size > 0
"""
