"""Benchmark decontamination: documents that hold a passage like a benchmark item.

Words are runs of ASCII letters, ASCII digits and characters beyond ASCII, in lower case. A document is looked at through
windows of as many words as the item has. Each window gets a SimHash: for every bit the majority over its five-word
shingles, each counted as often as it occurs; sliding sums give it for all windows of one length at once. The items' own
fingerprints lie in a multi-index: eight blocks of eight bits, of which at least one differs in ``RADIUS // 8`` bits at most
if the whole differs in ``RADIUS`` at most, so looking up the values that near in each block finds every fingerprint within
the radius. At a similarity of 0.8 a fingerprint differs in 10 +- 3 bits, so the radius of 24 leaves no such window out in
practice. Candidates are verified exactly: weighted Jaccard similarity, the sum of the lesser over the sum of the greater
counts of every shingle, 0.8 or more.

Windows without a shingle of any item have similarity 0 and are never fingerprinted; that is a lookup in a bitmap. A
document with fewer words than an item is one window. Items shorter than five words have one shingle, all their words.

The documents are read once for each block of items of about ``ITEM_WORDS`` words; a block's index is what is sent to the
tasks, so its size is bounded whatever the number of items. No document is shuffled.

Cases: NULL and empty texts and items match nothing; repeated rows and items each give their own rows; NULL ids are kept;
a passage that occurs several times in a document gives the first of its best windows; empty tables give empty results;
extra input columns are ignored by ``find_leaks`` and kept, whatever their names, by ``without_leaks``.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.llm.text import SHINGLE, WORD, shingle_hashes, slices, span_hashes, text_bytes, words_of

THRESHOLD_PERCENT = 80
RADIUS = 24
ITEM_WORDS = 200_000
_BLOCKS = 8
_BITMAP_BITS = 22


def fingerprints(bits: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the windows of ``size`` shingles, as eight bytes; ``bits``: running sums of the shingles' bits."""
    return np.packbits(2 * (bits[starts + size] - bits[starts]) > size, axis=1)


def bit_sums(hashes: np.ndarray) -> np.ndarray:
    ones = np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8), axis=1)
    return np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(ones, axis=0, dtype=np.int32)])


def similarity(a: tuple[np.ndarray, np.ndarray], hashes: np.ndarray) -> float:
    """Weighted Jaccard of counted shingles (values, counts) and a window's shingles."""
    values, counts = np.unique(hashes, return_counts=True)
    _, i, j = np.intersect1d(a[0], values, assume_unique=True, return_indices=True)
    common = np.minimum(a[1][i], counts[j]).sum()
    return float(common / (a[1].sum() + len(hashes) - common))


@dataclass
class SizeIndex:
    """Items of one shingle and window size: multi-index of their fingerprints, and their counted shingles."""
    size: int
    items: list
    prints: np.ndarray
    near: np.ndarray
    counted: list


def multi_index(prints: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """near[block, value, item]: whether the item's block differs from the value in radius // 8 bits at most."""
    differ = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :]).reshape(256, 256, 8).sum(2)
    close = differ <= radius // _BLOCKS
    return np.stack([close[:, prints[:, b]] for b in range(_BLOCKS)])


class ItemIndex:
    """All items of a block, by shingle size, then by window size."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.by_shingle: dict[int, list[SizeIndex]] = {}
        self.bitmaps: dict[int, np.ndarray] = {}
        groups: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
        for item, text in items:
            data, offsets = text_bytes(pc.utf8_lower(pa.array([text])))
            starts, ends, first = words_of(data, offsets, WORD)
            if not len(starts):
                continue
            k = min(SHINGLE, len(starts))
            hashes, _ = shingle_hashes(span_hashes(data, starts, ends), first, k)
            groups.setdefault((k, len(hashes)), []).append((item, hashes))
        for (k, size), own in sorted(groups.items()):
            prints = np.concatenate([fingerprints(bit_sums(h), np.zeros(1, np.int64), size) for _, h in own])
            index = SizeIndex(size, [i for i, _ in own], prints, multi_index(prints), [np.unique(h, return_counts=True) for _, h in own])
            self.by_shingle.setdefault(k, []).append(index)
            bitmap = self.bitmaps.setdefault(k, np.zeros(1 << _BITMAP_BITS, bool))
            for _, h in own:
                bitmap[(h >> np.uint64(64 - _BITMAP_BITS)).astype(np.int64)] = True
        self.known = {k: np.unique(np.concatenate([c[0] for index in indexes for c in index.counted])) for k, indexes in self.by_shingle.items()}

    def search(self, texts: pa.Array, percent: int) -> list[tuple[int, object, float, int, int]]:
        """(text, item, similarity, first word, words) of the best window of every item in every text."""
        data, offsets = text_bytes(pc.utf8_lower(texts))
        starts, ends, first = words_of(data, offsets, WORD)
        words = span_hashes(data, starts, ends)
        best: dict[tuple[int, int, int], tuple[float, int, int]] = {}
        for k, indexes in self.by_shingle.items():
            hashes, of = shingle_hashes(words, first, k)
            hit = np.flatnonzero(self.bitmaps[k][(hashes >> np.uint64(64 - _BITMAP_BITS)).astype(np.int64)])
            hit = hit[np.isin(hashes[hit], self.known[k])]
            if not len(hit):
                continue
            owner = np.searchsorted(of, hit, side="right") - 1
            most = indexes[-1].size
            # hits that some window could hold together are looked at together
            cut = np.flatnonzero((np.diff(owner) > 0) | (np.diff(hit) > 2 * most)) + 1
            for group in np.split(np.arange(len(hit)), cut):
                text = int(owner[group[0]])
                low, high = max(of[text], hit[group[0]] - most + 1), min(of[text + 1], hit[group[-1]] + most)
                here = hashes[low:high]
                sums, held = bit_sums(here), np.zeros(len(here) + 1, np.int64)
                held[hit[group] - low + 1] = 1
                held = np.cumsum(held)
                for index in indexes:
                    size = index.size
                    if of[text + 1] - of[text] < size:
                        if 100 * (of[text + 1] - of[text]) < percent * size:
                            continue
                        size = int(of[text + 1] - of[text])
                    at = np.flatnonzero(held[size:] > held[:-size])
                    if not len(at):
                        continue
                    prints = fingerprints(sums, at, size)
                    candidates = np.zeros((len(at), len(index.items)), bool)
                    for b in range(_BLOCKS):
                        candidates |= index.near[b][prints[:, b]]
                    which, item = np.nonzero(candidates)
                    apart = np.unpackbits(prints[which] ^ index.prints[item], axis=1).sum(1)
                    within = apart <= RADIUS
                    for w, i in zip(which[within], item[within]):
                        s = int(at[w])
                        value = similarity(index.counted[i], here[s:s + size])
                        if value * 100 >= percent - 1e-9:
                            key, place = (text, k, (index.size, i)), int(low + s - of[text])
                            if key not in best or (-value, place) < (-best[key][0], best[key][1]):
                                best[key] = (value, place, size + k - 1)
        names = {k: {x.size: x.items for x in v} for k, v in self.by_shingle.items()}
        return [(text, names[k][size][i], value, place, n) for (text, k, (size, i)), (value, place, n) in sorted(best.items())]


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", words: int = ITEM_WORDS) -> Iterator[ItemIndex]:
    """Indexes of blocks of items of about ``words`` words; one block is on the driver at a time."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    items = items.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), text.alias("text"))
    blocks = -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // (6 * words))
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block)
        yield ItemIndex([(r.id, r.text) for r in own.collect()])


def _sent(spark: SparkSession, index: ItemIndex) -> Broadcast:
    return spark.sparkContext.broadcast(cloudpickle.dumps(index))


def find_leaks(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """One row for each document and item that it holds: the id, item_id, similarity, first_word (from 0) and n_words of the window."""
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, item_id bigint, similarity double, first_word bigint, n_words bigint"
    found = df.sparkSession.createDataFrame([], schema)
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    for index in item_blocks(items):
        sent = _sent(df.sparkSession, index)

        def task(batches: Iterator[pa.RecordBatch], sent: Broadcast = sent) -> Iterator[pa.RecordBatch]:
            index = pickle.loads(sent.value)
            for batch in batches:
                for part in slices(batch, "text"):
                    rows = index.search(part.column(1), percent)
                    cells = list(zip(*rows)) or [()] * 5
                    yield pa.record_batch([part.column(0).take(pa.array(cells[0], pa.int64())), pa.array(cells[1], pa.int64()), pa.array(cells[2], pa.float64()),
                                           pa.array(cells[3], pa.int64()), pa.array(cells[4], pa.int64())], ["id", "item_id", "similarity", "first_word", "n_words"])

        found = found.unionByName(docs.mapInArrow(task, schema))
    return found.withColumnRenamed("id", id_col)


def without_leaks(df: DataFrame, items: DataFrame, text_col: str = "text", percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """The input without the documents that hold an item."""
    names, place = df.columns, df.columns.index(text_col)
    out = df.toDF(*[f"c{i}" for i in range(len(names))])
    for index in item_blocks(items):
        sent = _sent(df.sparkSession, index)

        def task(batches: Iterator[pa.RecordBatch], sent: Broadcast = sent) -> Iterator[pa.RecordBatch]:
            index = pickle.loads(sent.value)
            for batch in batches:
                for part in slices(batch, f"c{place}"):
                    stays = np.ones(part.num_rows, bool)
                    stays[[r[0] for r in index.search(part.column(place), percent)]] = False
                    yield part.filter(pa.array(stays))

        out = out.mapInArrow(task, out.schema)
    return out.toDF(*names)
