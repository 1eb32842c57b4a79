"""Token ids in a binary format: canonical length-limited Huffman coding from global counts.

``write_ids`` encodes whole texts, counts all ids, makes one code and writes two Parquet tables below a folder: ``code``
(id, length) and ``blocks``. A block holds whole documents in order of their ids: the part and block number, the id number
at which it starts within its part, the documents' ids and sizes, the code bits, and the bit offsets of every
document and of every 256th id in it. Blocks decode on their own, and the checkpoints let numpy decode all runs of 256 ids side by side by
one table of 2^16 entries. ``read_ids`` gives the documents back with their starts.

Ids are stored once by Spark before the code is known, so a lost executor repeats its own splits only. Parts are ranges
of document ids, cut at quantiles; rows of one id stay together in the part of that id, and blocks are bounded. Driver:
the counts, one number for each id of the vocabulary, and one quantile for each part.

Cases: a NULL text counts as empty; an empty text has the end id only; NULL document ids come first; rows that repeat an
id are kept and ordered by their ids; a text longer than a block is a block of its own; an empty table gives empty tables,
which read back empty; extra input columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabkit.llm.text import PieceStore, binary_array, kept_by_worker, ragged, slices, text_bytes
from tabkit.runtime import delete, scratch_path

END_ID = 0
MOST_BITS = 16  # longest code, and the width of the decoding table
CHECKPOINT = 256  # ids between two bit offsets
BLOCK_IDS = 1 << 16
DECODED_IDS = 1 << 20  # ids decoded side by side
PART_IDS = 1 << 22
MOST_PARTS = 100_000  # parts grow beyond PART_IDS ids rather than become more

# White space that keeps a text from being cut at its spaces and line ends; see Encoder.
_ODD = r"[^\S \n]|^\s|\s$|\s\s"
_SLICE = 4_000_000

# Kinds of bytes: 1 space or line end, 2 ASCII letter, 3 ASCII mark that ends a run of letters, 4 may be odd.
_KIND = np.zeros(256, np.uint8)
_KIND[[32, 10]] = 1
_KIND[[*range(65, 91), *range(97, 123)]] = 2
_KIND[[ord(c) for c in ".,;:!?*$#%&|"]] = 3
_KIND[[9, 11, 12, 13, 28, 29, 30, 31, ord("<"), 0xC2, 0xE1, 0xE2, 0xE3]] = 4


class Encoder:
    """Ids of whole texts by a byte-level BPE of the tokenizers library.

    The vocabulary's own rule ends a word at a space or line end that stands between two other characters, and between a
    letter and a mark. There the text is cut, each distinct piece is encoded once, and the ids are put together again.
    Texts with other white space or with a special token's string are encoded uncut.
    """

    def __init__(self, vocabulary: str) -> None:
        import os

        import regex
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(vocabulary)
        names = self.tokenizer.get_vocab()
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = regex.compile("|".join([_ODD, *map(regex.escape, special)]))
        line_end = names.get("Ċ", -1)
        self.opens = np.zeros(max([*names.values(), 0]) + 1, bool)
        for name, i in names.items():
            self.opens[i] = name.startswith("Ġ") or i == line_end
        self.store = PieceStore(self._learn)

    def plainly(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces without white space but for a space or line end in front; one without gets a line end, which is dropped again."""
        data, offsets = text_bytes(pieces)
        opened = _KIND[data[offsets[:-1]]] == 1
        texts = [x if o else "\n" + x for x, o in zip(pieces.to_pylist(), opened)]
        ids = self.plainly(["".join(texts)])[0]
        starts = np.flatnonzero(self.opens[ids])
        lengths = np.diff(np.append(starts, len(ids)))
        if len(starts) != len(pieces):  # a vocabulary that joins across the cuts
            each = self.plainly(texts)
            ids, lengths = np.concatenate(each), np.array([len(x) for x in each])
            starts = np.cumsum(lengths) - lengths
        keep = np.ones(len(ids), bool)
        keep[starts[~opened]] = False
        return ids[keep], lengths - ~opened

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids on end without end ids, and offsets."""
        texts = pc.fill_null(texts, "").cast(pa.string())
        data, offsets = text_bytes(texts)
        kind = _KIND[data]
        uncut = self._uncut(texts, kind, offsets)
        if uncut.all():
            each = self.plainly(texts.to_pylist())
            return np.concatenate([np.zeros(0, np.uint32), *each]), np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int64)
        if uncut.any():  # the others first, then put both together
            return self._merge(texts, uncut)
        cut = kind == 1
        cut[1:] |= (kind[1:] == 3) & (kind[:-1] == 2)
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        bounds = np.append(np.flatnonzero(cut), len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.string(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        ids, ends = self.store.ids_of(pieces)
        return ids, ends[np.searchsorted(bounds, offsets)]

    def _uncut(self, texts: pa.Array, kind: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts must be encoded whole: a look at the bytes, then at the texts that may be odd."""
        strange, space = kind == 4, kind == 1
        strange[1:] |= space[1:] & space[:-1]
        filled = np.flatnonzero(np.diff(offsets) > 0)
        strange[offsets[filled]] |= space[offsets[filled]]
        strange[offsets[filled + 1] - 1] |= space[offsets[filled + 1] - 1]
        out = np.zeros(len(texts), bool)
        for i in np.unique(np.searchsorted(offsets, np.flatnonzero(strange), side="right") - 1):
            out[i] = self.odd.search(texts[int(i)].as_py()) is not None
        return out

    def _merge(self, texts: pa.Array, uncut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = [np.zeros(0, np.uint32)] * len(texts)
        whole, rest = np.flatnonzero(uncut), np.flatnonzero(~uncut)
        for i, ids in zip(whole, self.plainly([texts[int(i)].as_py() for i in whole])):
            parts[i] = ids
        ids, offsets = self.encode(texts.take(pa.array(rest)))
        for n, i in enumerate(rest):
            parts[i] = ids[offsets[n]:offsets[n + 1]]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)


def code_lengths(counts: np.ndarray, most_bits: int = MOST_BITS) -> np.ndarray:
    """Best code lengths of at most ``most_bits`` bits for ids with these counts (package-merge); 0 for absent ids."""
    present = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(present) < 2:
        lengths[present] = 1
        return lengths
    if len(present) > 1 << most_bits:
        raise ValueError("more ids than codes")
    order = present[np.argsort(counts[present], kind="stable")]
    leaves = counts[order].astype(np.float64)
    levels, row = [], np.zeros(0)
    for _ in range(most_bits):  # each level: the leaves and the pairs of the level before, by weight
        both = np.concatenate([leaves, row])
        sort = np.argsort(both, kind="stable")
        levels.append(sort < len(leaves))
        both = both[sort]
        row = both[:len(both) // 2 * 2].reshape(-1, 2).sum(1)
    taken, bits = 2 * len(order) - 2, np.zeros(len(order), np.int64)
    for is_leaf in reversed(levels):
        own = int(is_leaf[:taken].sum())
        bits[:own] += 1
        taken = 2 * (taken - own)
    lengths[order] = bits
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes, code, last = np.zeros(len(lengths), np.int64), 0, 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    for i in order[lengths[order] > 0]:
        code <<= int(lengths[i]) - last
        last = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def pack_bits(ids: np.ndarray, sizes: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code bits of all texts, as bytes; byte offsets of the texts; bit offset of every id within its text). A text starts at an even byte."""
    bits = lengths[ids]
    sums = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])
    first = np.cumsum(sizes) - sizes
    of_text = sums[first + sizes] - sums[first]
    begin = np.concatenate([[0], np.cumsum((of_text + 15) // 16 * 16)])
    within = sums[:-1] - np.repeat(sums[first], sizes)
    at = within + np.repeat(begin[:-1], sizes)
    word = at >> 4
    wide = codes[ids].astype(np.uint32) << (32 - bits - (at & 15)).astype(np.uint32)
    out = np.zeros(int(begin[-1] >> 4) + 2, np.uint32)
    if len(ids):  # a code lies in one word of 16 bits or in two; codes never share a bit, so adding is joining
        groups = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        out[word[groups]] = np.add.reduceat(wide >> np.uint32(16), groups)
        out[word[groups] + 1] += np.add.reduceat(wide & np.uint32(0xFFFF), groups)
    return out[:int(begin[-1] >> 4)].astype(">u2").view(np.uint8), begin >> 3, within


def decoding_table(lengths: np.ndarray, most_bits: int = MOST_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Id and length for every value of the next ``most_bits`` bits."""
    ids, sizes = np.zeros(1 << most_bits, np.uint32), np.ones(1 << most_bits, np.int64)
    codes = canonical_codes(lengths)
    order = np.flatnonzero(lengths)
    order = order[np.lexsort((order, lengths[order]))]
    spans = 1 << (most_bits - lengths[order])
    begin = codes[order] << (most_bits - lengths[order])
    places = ragged(begin, spans)
    ids[places], sizes[places] = np.repeat(order, spans), np.repeat(lengths[order], spans)
    return ids, sizes


def unpack_bits(data: np.ndarray, starts: np.ndarray, counts: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Ids of runs that start at the given bits, all runs decoded side by side."""
    ids, sizes = table
    data = np.concatenate([data, np.zeros(4, np.uint8)]).astype(np.uint32)
    wide = (data[:-3] << 16) | (data[1:-2] << 8) | data[2:-1]
    out = np.zeros(int(counts.sum()), np.uint32)
    to = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    at, to, left = starts[order].astype(np.int64), to[order], counts[order]
    for step in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -step, side="left"))  # runs with more than `step` ids
        peek = (wide[at[:n] >> 3] >> (8 - (at[:n] & 7)).astype(np.uint32)) & 0xFFFF
        out[to[:n] + step] = ids[peek]
        at[:n] += sizes[peek]
    return out


def encode_texts(df: DataFrame, vocabulary: str, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 16- or 32-bit, end id included); each task adds a row with only
    ``seen``, its counts of ids: pairs of unsigned 64-bit integers (id, count)."""
    import json
    wide = max(json.loads(vocabulary)["model"]["vocab"].values(), default=0) >= 1 << 16

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_by_worker("ids", vocabulary.encode(), lambda raw: Encoder(raw.decode()))
        names, total = ["doc_id", "n_tokens", "ids", "seen"], np.zeros(len(encoder.opens) + 1, np.int64)
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                ids, offsets = encoder.encode(part.column(1))
                sizes = np.diff(offsets) + 1
                ends = np.cumsum(sizes)
                full = np.full(int(ends[-1]), END_ID, "<u4" if wide else "<u2")
                keep = np.ones(len(full), bool)
                keep[ends - 1] = False
                full[keep] = ids
                found = np.bincount(full)
                total[:len(found)] += found
                yield pa.record_batch([part.column(0), pa.array(sizes, pa.int64()), binary_array(full.view(np.uint8), np.concatenate([[0], ends]) * full.itemsize),
                                       pa.nulls(part.num_rows, pa.binary())], names)
        present = np.flatnonzero(total)
        seen = np.stack([present, total[present]], 1).astype("<u8").tobytes()
        yield pa.record_batch([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([seen], pa.binary())], names)

    source = df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return source.mapInArrow(task, "doc_id bigint, n_tokens bigint, ids binary, seen binary")


def _ids_type(n_tokens: np.ndarray, n_bytes: int) -> str:
    return "<u4" if n_bytes == 4 * int(n_tokens.sum()) else "<u2"


def _bytes(column: pa.Array) -> pa.Array:
    """Binary values as if they were texts, for the helpers on texts."""
    return column.cast(pa.large_binary()).view(pa.large_string())


def count_ids(seen: DataFrame) -> DataFrame:
    """id, n over all documents, from the tasks' counts."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i8").reshape(-1, 2)
            yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["id", "n"])

    return seen.where("seen IS NOT NULL").select("seen").mapInArrow(task, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(df: DataFrame, path: str, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
              part_ids: int = PART_IDS, block_ids: int = BLOCK_IDS) -> None:
    """Encode all texts and write ``code`` and ``blocks`` below ``path``."""
    spark = df.sparkSession
    staged = scratch_path(spark, "ids")
    encode_texts(df, Path(tokenizer_file).read_text(encoding="utf-8"), id_col, text_col).write.option("compression", "zstd").parquet(staged)
    counted = count_ids(spark.read.parquet(staged)).toPandas()  # one row for each id of the vocabulary at most
    counts = np.zeros(int(counted["id"].max()) + 1 if len(counted) else 1, np.int64)
    counts[counted["id"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    encoded = spark.read.parquet(staged).where("seen IS NULL").drop("seen")
    lengths = code_lengths(counts)
    codes = canonical_codes(lengths)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id bigint, length int").coalesce(1).write.parquet(f"{path}/code")

    parts = max(1, min(MOST_PARTS, -(-int(counts.sum()) // part_ids)))
    cuts = [i / parts for i in range(1, parts)]
    bounds = encoded.agg(F.percentile_approx("doc_id", cuts, max(10_000, 20 * parts))).first()[0] if parts > 1 else None
    bounds = np.array(sorted(set(bounds or [])), np.int64)

    def code_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.set_column(2, "ids", _bytes(batch.column(2)))
            for part in slices(batch, "ids"):
                sizes, (data, _) = part.column(1).to_numpy(), text_bytes(part.column(2))
                bits, ends, within = pack_bits(data.view(_ids_type(sizes, len(data))), sizes, codes, lengths)
                number = np.searchsorted(bounds, part.column(0).fill_null(np.iinfo(np.int64).min).to_numpy()).astype(np.int32)  # NULL ids come first
                each = -(-sizes // CHECKPOINT)
                first = np.cumsum(sizes) - sizes
                places = ragged(np.zeros(len(each), np.int64), each) * CHECKPOINT + np.repeat(first, each)
                yield pa.record_batch([pa.array(number), part.column(0), part.column(1), binary_array(bits, ends),
                                       binary_array(within[places].astype("<u8").view(np.uint8), 8 * np.concatenate([[0], np.cumsum(each)]))],
                                      ["part", "doc_id", "n_tokens", "bits", "marks"])

    coded = encoded.select("doc_id", "n_tokens", "ids").mapInArrow(code_task, "part int, doc_id bigint, n_tokens bigint, bits binary, marks binary")
    ordered = coded.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "n_tokens", "bits")

    def block_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, start, held, size = -1, 0, 0, [], 0

        def flush() -> pa.RecordBatch:
            bits, marks, at = b"".join(x[2] for x in held), [], 0
            for _, _, own, offsets in held:  # bit offsets within the block; every document starts a byte
                marks.append(np.frombuffer(offsets, "<u8") + 8 * at)
                at += len(own)
            marks = np.concatenate(marks).astype("<u8").tobytes()
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([start], pa.int64()),
                                    pa.array([[x[0] for x in held]], pa.list_(pa.int64())), pa.array([[x[1] for x in held]], pa.list_(pa.int64())),
                                    pa.array([marks], pa.binary()), pa.array([bits], pa.binary())],
                                   ["part", "block", "start", "doc_ids", "sizes", "marks", "bits"])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if held and (row[0] != part or size + row[2] > block_ids):
                    yield flush()
                    block, start, held, size = block + 1, start + size, [], 0
                if row[0] != part:
                    part, block, start = row[0], 0, 0
                held.append(row[1:])
                size += row[2]
        if held:
            yield flush()

    ordered.mapInArrow(block_task, "part int, block int, start bigint, doc_ids array<bigint>, sizes array<bigint>, marks binary, bits binary"
                       ).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    delete(spark, staged)


def read_ids(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and ``ids`` (array of bigint), or instead ``ids_crc32`` of the ids as unsigned 32-bit integers."""
    code = spark.read.parquet(f"{path}/code").toPandas()  # one row for each id of the vocabulary at most
    lengths = np.zeros(int(code["id"].max()) + 1 if len(code) else 1, np.int64)
    lengths[code["id"].to_numpy(np.int64)] = code["length"].to_numpy(np.int64)
    blocks = spark.read.parquet(f"{path}/blocks")

    def decoded(blocks: list[dict], table: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        sizes = np.array([n for b in blocks for n in b["sizes"]], np.int64)
        each = -(-sizes // CHECKPOINT)  # runs of a document
        runs = np.full(int(each.sum()), CHECKPOINT, np.int64)
        runs[np.cumsum(each) - 1] = sizes - (each - 1) * CHECKPOINT
        marks = [np.frombuffer(b["marks"], "<u8").astype(np.int64) for b in blocks]
        before = np.cumsum([0, *(len(b["bits"]) for b in blocks)])
        starts = np.concatenate([m + 8 * int(at) for m, at in zip(marks, before)])
        ids = unpack_bits(np.frombuffer(b"".join(b["bits"] for b in blocks), np.uint8), starts, runs, table)
        ends = np.cumsum(sizes)
        raw = memoryview(ids.astype("<u4").tobytes())
        last = (pa.array([zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())], pa.int64()) if digest
                else pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids, pa.int64())))
        at = np.concatenate([b["start"] + np.cumsum([0, *b["sizes"][:-1]]) for b in blocks])
        return pa.record_batch([pa.array([b["part"] for b in blocks for _ in b["sizes"]], pa.int32()), pa.array([i for b in blocks for i in b["doc_ids"]], pa.int64()),
                                pa.array(at, pa.int64()), pa.array(sizes), last], ["part", "doc_id", "at", "n_tokens", "last"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoding_table(lengths)
        held, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                block = {name: batch.column(c)[i].as_py() for c, name in enumerate(batch.schema.names)}
                held.append(block)
                size += sum(block["sizes"])
                if size >= DECODED_IDS:
                    yield decoded(held, table)
                    held, size = [], 0
        if held:
            yield decoded(held, table)

    name = "ids_crc32" if digest else "ids"
    documents = blocks.mapInArrow(task, f"part int, doc_id bigint, at bigint, n_tokens bigint, last {'bigint' if digest else 'array<bigint>'}")
    parts = blocks.groupBy(F.col("part").alias("p")).agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("n"))
    bases = parts.select("p", (F.sum("n").over(Window.orderBy("p")) - F.col("n")).alias("base"))
    return (documents.join(bases, F.col("part") == F.col("p"))
            .select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", F.col("last").alias(name)))
