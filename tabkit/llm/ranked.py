"""Ranked lexical search by presence masks: the best documents for each of a stated set of items.

Terms are runs of ASCII letters, ASCII digits and characters beyond ASCII; only A to Z are put in lower case. A document's score
adds for each different term of the item its weight times a saturating share of its occurrences, in whole numbers.

Two passes read the documents. The first counts each document's terms and the occurrences of the terms that some item asks
for, and stores them (no texts); sums over it give the weights. The second scores the stored counts in blocks of documents: for an item, the
documents of a block are grouped by their presence mask, the bit set of the item's terms they hold. A mask's highest possible score is
the sum of its terms' highest values in the block. Masks are scored from the highest possible score down, and the item is finished
in this block when no mask left can reach the score that is last in the item's list.

Nothing is emitted per pair: a task returns ``top`` rows per item at most. Before that, the documents whose hash falls into one
of ``PRIMING`` parts are ranked alone; the last score of their lists is a lower bound for the whole, below which tasks return nothing and
skip masks and whole blocks. The bound only spares work, the result is the same without it. Lists are merged in two steps, so no
task sees more than ``top`` rows per item and task of the step before.

The items are the query set: they and their terms' counts are collected, in runs of about ``ITEM_BYTES`` of text, one after the
other; a run's documents are counted anew. An item alone may be longer. Counts of documents stay on the executors.

Cases: NULL texts and texts without a term are no documents and never in a list; an item without a term has no rows; repeated
items each have their list; repeated documents are each ranked; equal scores go by the id, NULL ids last; very long texts are
counted whole, each as a run of its own; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabkit.llm.text import WORD, ragged, slices, span_hashes, text_bytes, words_of
from tabkit.runtime import settle

TOP = 50
PRIMING = 16
ITEM_BYTES = 8_000_000
BLOCK = 4096  # documents
CELLS = 2_000_000  # documents x terms of an item at once
SALTS = 64
NO_ID = np.iinfo(np.int64).max


def term_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of all texts on end, and the place of each text's first."""
    data, offsets = text_bytes(texts)
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data).astype(np.uint8)
    starts, ends, first = words_of(data, offsets, WORD)
    return span_hashes(data, starts, ends), first


def count_terms(df: DataFrame, asked: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """id, n (all terms), terms (places in the sorted ``asked``) and times, for every document with a term."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, first = term_hashes(part.column(1))
                n = np.diff(first)
                place = np.searchsorted(asked, hashes)
                known = np.flatnonzero(asked[np.minimum(place, len(asked) - 1)] == hashes) if len(asked) else np.zeros(0, np.int64)
                doc = np.repeat(np.arange(len(n)), n)[known]
                pairs, times = np.unique(doc * max(1, len(asked)) + place[known], return_counts=True)
                doc, term = np.divmod(pairs, max(1, len(asked)))
                ends = np.searchsorted(doc, np.arange(len(n) + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (term, times)]
                out = pa.record_batch([part.column(0), pa.array(n.astype(np.int64)), *lists], ["id", "n", "terms", "times"])
                yield out.filter(pa.array(n > 0))

    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(task, "id bigint, n bigint, terms array<int>, times array<int>")


def masks_of(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first row of each different row of a bit matrix, and the number of every row's mask.

    Rows are packed to words of 64 bits; groups are refined word by word.
    """
    packed = np.packbits(present, axis=1)
    wide = np.zeros((len(packed), -(-packed.shape[1] // 8) * 8), np.uint8)
    wide[:, :packed.shape[1]] = packed
    words = wide.view(np.uint64)
    first, group = np.unique(words[:, 0], return_index=True, return_inverse=True)[1:]
    for i in range(1, words.shape[1]):
        values, inner = np.unique(words[:, i], return_inverse=True)
        first, group = np.unique(group * len(values) + inner, return_index=True, return_inverse=True)[1:]
    return first, group


class Lists:
    """The best documents seen so far for every item."""

    def __init__(self, items: int, top: int, least: np.ndarray) -> None:
        self.top, self.least = top, least.copy()
        self.scores, self.ids = [np.zeros(0, np.int64)] * items, [np.zeros(0, np.int64)] * items

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.least[item]
        scores, ids = np.concatenate([self.scores[item], scores[good]]), np.concatenate([self.ids[item], ids[good]])
        best = np.lexsort((ids, -scores))[:self.top]
        self.scores[item], self.ids[item] = scores[best], ids[best]
        if len(best) == self.top:
            self.least[item] = max(self.least[item], self.scores[item][-1])


def rank_block(ids: np.ndarray, doc: np.ndarray, term: np.ndarray, value: np.ndarray, items: list[np.ndarray], n_terms: int, lists: Lists) -> None:
    """Enter a block of documents into the lists. ``value`` is what a term adds to the score of a document; ``doc`` counts from 0."""
    order = np.argsort(term, kind="stable")
    doc, term, value = doc[order], term[order], value[order]
    ends = np.searchsorted(term, np.arange(n_terms + 1))
    highest = np.zeros(n_terms, np.int64)
    np.maximum.at(highest, term, value)
    for number, wanted in enumerate(items):
        wanted = wanted[highest[wanted] > 0]
        if not len(wanted) or highest[wanted].sum() < lists.least[number]:
            continue
        step = max(1, CELLS // len(wanted))
        spans = ends[wanted + 1] - ends[wanted]
        at = ragged(ends[wanted], spans)
        rows, columns, values = doc[at], np.repeat(np.arange(len(wanted)), spans), value[at]
        for begin in range(0, len(ids), step):
            here = (rows >= begin) & (rows < begin + step) if len(ids) > step else slice(None)
            table = np.zeros((min(step, len(ids) - begin), len(wanted)), np.int64)
            table[rows[here] - begin, columns[here]] = values[here]
            present = table > 0
            first, group = masks_of(present)
            bound = present[first].astype(np.float64) @ highest[wanted].astype(np.float64)  # whole numbers below 2^53, exact
            members = np.argsort(group, kind="stable")
            sizes = np.bincount(group, minlength=len(first))
            begins = np.cumsum(sizes) - sizes
            falling = np.argsort(-bound, kind="stable")
            done, chunk = 0, lists.top
            while done < len(falling) and bound[falling[done]] >= lists.least[number]:
                masks = falling[done:done + chunk]
                chosen = members[ragged(begins[masks], sizes[masks])]
                lists.add(number, table[chosen].sum(1), ids[begin:][chosen])
                done, chunk = done + len(masks), chunk * 2


def _lists(counted: DataFrame, items: list[np.ndarray], weights: np.ndarray, documents: int, terms: int, least: np.ndarray, top: int) -> DataFrame:
    """item, id, score of the best ``top`` of every item and task, none below ``least``."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(len(items), top, least)
        for whole in batches:
            for begin in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(begin, BLOCK)
                ids = batch.column(0).fill_null(NO_ID).to_numpy()
                middle = 50 + 50 * batch.column(1).to_numpy() * documents // terms
                lengths = batch.column(2).value_lengths().to_numpy()
                term, times = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in (2, 3))
                doc = np.repeat(np.arange(len(ids)), lengths)
                value = weights[term] * (1_000_000_000 * times // (1000 * times + 20 * middle[doc]))
                rank_block(ids, doc, term, value, items, len(weights), lists)
        sizes = [len(x) for x in lists.ids]
        ids = np.concatenate(lists.ids) if items else np.zeros(0, np.int64)
        scores = np.concatenate(lists.scores) if items else np.zeros(0, np.int64)
        yield pa.record_batch([pa.array(np.repeat(np.arange(len(items)), sizes)), pa.array(ids, mask=ids == NO_ID), pa.array(scores)], ["item", "id", "score"])

    found = counted.mapInArrow(task, "item bigint, id bigint, score bigint")
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    found = found.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    found = found.withColumn("rank", F.row_number().over(W.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= top)
    return found.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)


def _search(df: DataFrame, ids: list, texts: list[str], top: int, id_col: str, text_col: str) -> DataFrame:
    """item (its place), rank, id, score for one run of items."""
    hashes, first = term_hashes(pa.array(texts, pa.string()))
    asked = np.unique(hashes)
    counted = settle(count_terms(df, asked, id_col, text_col), "counted")
    documents, terms = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
    held = np.zeros(len(asked), np.int64)
    for term, n in counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect():
        held[term] = n  # one row per term of the items
    weights = np.floor(1000 * np.log((2 * documents + 2) / (2 * held + 1))).astype(np.int64)
    items = [np.unique(np.searchsorted(asked, hashes[a:b])) for a, b in zip(first[:-1], first[1:])]
    items = [x[weights[x] > 0] for x in items]
    least = np.ones(len(items), np.int64)
    primed = counted.where(F.pmod(F.xxhash64(F.lit("priming"), "id", "n"), F.lit(PRIMING)) == 0)
    primed = _lists(primed, items, weights, documents, terms or 1, least, top).where(F.col("rank") == top)
    for row in primed.select("item", "score").collect():  # one row per item
        least[row["item"]] = row["score"]
    return _lists(counted, items, weights, documents, terms or 1, least, top)


def search(df: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``top`` documents of every item with a score above 0; all if there are fewer."""
    asked = items.select(F.col(f"`{item_col}`").alias("item"), F.coalesce(F.col(f"`{item_text}`").cast("string"), F.lit("")).alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    runs = -(-size // item_bytes) or 1
    found = None
    for run in range(runs):
        own = asked if runs == 1 else asked.where(F.pmod(F.xxhash64(F.lit("run"), "item", "text"), F.lit(runs)) == run)
        rows = own.collect()
        ranked = _search(df, [r["item"] for r in rows], [r["text"] for r in rows], top, id_col, text_col)
        kind = asked.schema["item"].dataType
        names = df.sparkSession.createDataFrame([(i, r["item"]) for i, r in enumerate(rows)], f"k bigint, item_id {kind.simpleString()}")
        named = ranked.join(names, F.col("item") == F.col("k")).select(
            F.col("item_id").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
        found = named if found is None else found.unionByName(named)
    return found


SQL = r"""
WITH asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
terms AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
sums AS (SELECT count(*) AS docs, sum(n)::BIGINT AS all_terms FROM lengths),
held AS (SELECT doc_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM held, sums GROUP BY term, docs),
parts AS (SELECT term, doc_id, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // all_terms))) AS part
    FROM held JOIN weights USING (term) JOIN lengths USING (doc_id), sums),
scores AS (SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM asked JOIN parts USING (term) GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
