"""N-gram Jaccard join: all links between texts whose sets of five-word shingles are similar to 0.8 or more.

Words are runs of ASCII letters, ASCII digits and characters beyond ASCII, in lower case, so marks and case at the edges of
sentences do not hide a copy. Equal texts are joined first, by a 128-bit hash.
Of each different text a MinHash forest is made: ``TREES`` tries, each over its own sequence of minima. Two texts meet in a
trie if their sequences share a prefix; prefixes are shortened, from ``LONGEST`` on, until the chance that a pair at the
threshold meets in some trie reaches ``RECALL``. One threshold holds for all texts, so that is one depth, 6 with these values, and only
the nodes of that depth are made; the chance to miss a pair is 5 in a million at 0.8 and falls quickly above.

Texts of low similarity meet too. So the members of a node are compared there, by sketches: one byte each of ``SKETCH`` minima. Two texts
are tied if ``LEAST_ALIKE`` of them agree, which a pair at 0.8 misses with a chance below 1 in 10^10. A task compares one member with
all and then only those that are not tied to it, so a node of copies costs little more than its size; large nodes are
compared in pairs of blocks of ``NODE_BLOCK`` sketches. Tasks return ties that connect what the pairs connect, at most a few per member.

Components of ties are clusters; within a cluster all pairs are verified exactly, by products of the texts' shingle matrices. Clusters are cut into
blocks of about 64 texts or ``BLOCK_BYTES`` by a hash, and pairs of blocks are compared in different tasks, so a cluster of any size is bounded
memory; a text travels once for each block of its cluster. Tasks return a text's number of links and the least text of its
linked group, never pairs. Components of these are the classes.

Cases: NULL and empty texts are one text without shingles, which links to nothing else; a text with fewer than five words has
one shingle of all its words; repeated rows count as copies; NULL ids are kept and come last in order; an empty table gives
an empty result; extra input columns are ignored here and kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.llm.graph import components
from tabkit.llm.stored import store
from tabkit.llm.text import SHINGLE, WORD, binary_array, mix, shingle_hashes, slices, span_hashes, text_bytes, words_of
from tabkit.runtime import settle

THRESHOLD_PERCENT = 80
TREES = 40
LONGEST = 12
RECALL = 0.99999
SKETCH = 128
LEAST_ALIKE = 70  # of SKETCH; 102 are expected at 0.8, with a deviation of 4.5
NODE_BLOCK = 1024  # sketches
SMALL_NODE = 8  # members that are compared pair by pair
BLOCK = 64  # texts
BLOCK_BYTES = 8_000_000  # of texts; one may be longer
COLUMNS = 8192  # shingles multiplied at once


def prefix_depth(threshold: float, trees: int = TREES, longest: int = LONGEST, recall: float = RECALL) -> int:
    """The longest prefix at which a pair at the threshold meets in some trie with the wanted chance."""
    depth = longest
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < recall:
        depth -= 1
    return depth


def shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts on end, with repeats, and offsets."""
    data, offsets = text_bytes(pc.utf8_lower(texts))
    starts, ends, first = words_of(data, offsets, WORD)
    return shingle_hashes(span_hashes(data, starts, ends), first, size)


def trie_nodes(hashes: np.ndarray, offsets: np.ndarray, trees: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text with shingles, one row: the names of its nodes, one in each trie, and its sketch, the last bytes of the first
    minima of the tries."""
    own = np.flatnonzero(np.diff(offsets))
    begins = offsets[:-1][own]
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    draws = np.random.Generator(np.random.PCG64(7)).integers(0, 2**32, (trees, depth, 2), dtype=np.uint32)
    out = np.zeros((len(own), trees), np.uint64)
    sketch = np.zeros((len(own), SKETCH), np.uint8)
    each = -(-SKETCH // trees)
    work = np.empty_like(short)
    for tree in range(trees):
        name = np.full(len(own), tree + 1, np.uint64)
        for level, (factor, shift) in enumerate(draws[tree]):
            np.multiply(short, factor | np.uint32(1), out=work)
            np.bitwise_xor(work, work >> np.uint32(15), out=work)
            np.multiply(work, np.uint32(0x2C1B3C6D), out=work)
            np.bitwise_xor(work, shift, out=work)
            least = np.minimum.reduceat(work, begins)
            name = mix(name ^ least.astype(np.uint64))
            if level < each and (place := level * trees + tree) < SKETCH:
                sketch[:, place] = least & np.uint32(255)
        out[:, tree] = name
    return out, sketch


def _prints(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("p1"), F.xxhash64(F.lit("second"), text).alias("p2")]


def _signed(df: DataFrame, id_col: str, text_col: str, trees: int, depth: int) -> DataFrame:
    """id, p1, p2 (the text's 128-bit hash), size (bytes), nodes and sketch, empty for texts without shingles."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, offsets = shingles(part.column(3))
                some = np.diff(offsets) > 0
                nodes, sketch = trie_nodes(hashes, offsets, trees, depth)
                ends = np.concatenate([[0], np.cumsum(some * trees)]).astype(np.int32)
                yield pa.record_batch([*part.columns[:3], pc.binary_length(part.column(3)).cast(pa.int64()),
                                       pa.ListArray.from_arrays(pa.array(ends), pa.array(nodes.view(np.int64).ravel())),
                                       binary_array(sketch.ravel(), np.concatenate([[0], np.cumsum(some * SKETCH)]))],
                                      ["id", "p1", "p2", "size", "nodes", "sketch"])

    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    docs = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), *_prints(text), text.alias("text"))
    return docs.mapInArrow(task, "id bigint, p1 bigint, p2 bigint, size bigint, nodes array<bigint>, sketch binary")


def alike(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Matrix of the pairs of sketches that agree in ``LEAST_ALIKE`` places."""
    same = np.zeros((len(one), len(other)), np.uint8)
    for column in range(SKETCH):
        same += one[:, column, None] == other[None, :, column]
    return same >= LEAST_ALIKE


def node_ties(sketches: np.ndarray) -> np.ndarray:
    """For each sketch the place of the first one it is connected to over pairs that are alike.

    One is compared with all, and then each one not tied to it with all: pairs of which both are tied to the first add nothing.
    """
    tied = alike(sketches[:1], sketches)[0]
    tied[0] = True
    rest = np.flatnonzero(~tied)
    label = np.where(tied, 0, np.arange(len(sketches)))
    if not len(rest):
        return label
    near = alike(sketches[rest], sketches)
    while True:
        new = label.copy()
        new[rest] = np.minimum(label[rest], np.where(near, label[None, :], len(label)).min(1))  # what a place hears from others
        np.minimum.at(new, np.nonzero(near)[1], np.repeat(new[rest], near.sum(1)))  # and others from it
        new[tied] = new[tied].min()
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _tied(members: DataFrame) -> DataFrame:
    """Edges (u, v) from node, a, b (blocks), t, sketch, sorted by node, a, b."""
    def ties(group: np.ndarray, t: np.ndarray, sketches: np.ndarray) -> pa.RecordBatch:
        begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
        sizes = np.diff(np.concatenate([begins, [len(group)]]))
        small = np.repeat(sizes <= SMALL_NODE, sizes)
        left, right = [], []
        for step in range(1, SMALL_NODE):
            i = np.flatnonzero((group[step:] == group[:-step]) & small[step:]) if len(group) > step else np.zeros(0, np.int64)
            i = i[(sketches[i] == sketches[i + step]).sum(1) >= LEAST_ALIKE]
            left.append(t[i])
            right.append(t[i + step])
        for begin, size in zip(begins[sizes > SMALL_NODE], sizes[sizes > SMALL_NODE]):
            label = node_ties(sketches[begin:begin + size])
            some = np.flatnonzero(label != np.arange(size))
            left.append(t[begin + some])
            right.append(t[begin + label[some]])
        u, v = np.concatenate(left), np.concatenate(right)
        return pa.record_batch([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], ["u", "v"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last group, which the next batch may go on with
        for batch in batches:
            keys = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[:3]], 1)
            t = batch.column(3).to_numpy()
            sketches = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8)
            now = (keys, t, sketches.reshape(-1, SKETCH))
            if held is not None:
                now = tuple(np.concatenate(x) for x in zip(held, now))
            keys, t, sketches = now
            if not len(t):
                continue
            group = np.concatenate([[0], np.cumsum((keys[1:] != keys[:-1]).any(1))])
            last = int(np.searchsorted(group, group[-1]))
            yield ties(group[:last], t[:last], sketches[:last])
            held = (keys[last:], t[last:], sketches[last:])
        if held is not None:
            yield ties(np.zeros(len(held[1]), np.int64), held[1], held[2])

    return members.mapInArrow(task, "u bigint, v bigint")


def linked(sets: list[np.ndarray], percent: int, left: np.ndarray | None = None) -> np.ndarray:
    """Matrix of the pairs of sets whose Jaccard similarity is ``percent`` or more; with ``left``, only pairs across the two sides."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    names, places, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[places] > 1
    owner, places = owner[shared], np.unique(places[shared], return_inverse=True)[1] if shared.any() else np.zeros(0, np.int64)
    order = np.argsort(places, kind="stable")
    owner, places = owner[order], places[order]
    common = np.zeros((len(sets), len(sets)), np.float64)
    for begin in range(0, int(places[-1]) + 1 if len(places) else 0, COLUMNS):
        a, b = np.searchsorted(places, [begin, begin + COLUMNS])
        matrix = np.zeros((len(sets), min(COLUMNS, int(places[-1]) + 1 - begin)), np.float32)
        matrix[owner[a:b], places[a:b] - begin] = 1
        common += matrix @ matrix.T  # counts below 2^24, exact
    both = sizes[:, None] + sizes[None, :]
    # |A n B| / |A u B| >= t  is  (1 + t) |A n B| >= t (|A| + |B|)
    similar = (100 + percent) * common >= percent * both
    np.fill_diagonal(similar, False)
    if left is not None:
        similar &= left[:, None] != left[None, :]
    return similar


def least_reached(similar: np.ndarray) -> np.ndarray:
    """For each row, the least row it is tied to over any number of links."""
    label = np.arange(len(similar))
    while True:
        near = np.where(similar, label[None, :], len(similar)).min(1, initial=len(similar))
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _verified(grouped: DataFrame, percent: int) -> DataFrame:
    """id, links, head (least linked id of the task) from cluster, a, b (blocks), block, id, text; sorted by cluster, a, b."""
    def compare(rows: dict[int, tuple[int, np.ndarray]], crossed: bool) -> pa.RecordBatch | None:
        if len(rows) < 2:
            return None
        ids = np.array(sorted(rows))
        side = np.array([rows[i][0] for i in ids])
        similar = linked([rows[i][1] for i in ids], percent, side if crossed else None)
        links = similar.sum(1)
        some = links > 0
        if not some.any():
            return None
        return pa.record_batch([pa.array(ids[some]), pa.array(links[some].astype(np.int64)), pa.array(ids[least_reached(similar)][some])], ["id", "links", "head"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, {}
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, offsets = shingles(part.column(5))
                for i, key in enumerate(zip(*(part.column(c).to_pylist() for c in range(5)))):
                    if key[:3] != now:
                        if now is not None and (out := compare(rows, now[1] != now[2])):
                            yield out
                        now, rows = key[:3], {}
                    rows[key[4]] = (key[3], np.unique(hashes[offsets[i]:offsets[i + 1]]))
        if now is not None and (out := compare(rows, now[1] != now[2])):
            yield out

    return grouped.mapInArrow(task, "id bigint, links bigint, head bigint")


def _paired(rows: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Each row once for every pair (a, b) of the ``blocks`` of its key that its own block, by a hash of ``t``, is one of."""
    placed = rows.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "t"), F.col("blocks")).cast("int"))
    return placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        key, F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block", *cols)


def near_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = THRESHOLD_PERCENT,
               trees: int = TREES, longest: int = LONGEST, recall: float = RECALL, block: int = BLOCK, node_block: int = NODE_BLOCK) -> tuple[DataFrame, DataFrame]:
    """Two stored frames: rows (id, p1, p2) of the input, and texts (p1, p2, first_id, copies, links, class, class_id, kept)."""
    depth = prefix_depth(percent / 100, trees, longest, recall)
    rows = settle(_signed(df, id_col, text_col, trees, depth), "signed")
    texts = rows.groupBy("p1", "p2").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("nodes").alias("nodes"),
                                         F.first("sketch").alias("sketch"), F.first("size").alias("size"))
    texts = settle(texts.withColumn("t", F.monotonically_increasing_id()), "texts")
    members = texts.select("t", F.explode("nodes").alias("node"))
    # stored, as below: the join then shuffles both sides itself, and Spark may split large keys
    shared = store(members.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("node").alias("k"), "n"), "shared")
    met = settle(members.join(shared, F.col("node") == F.col("k")).select("node", "t", F.ceil(F.col("n") / F.lit(node_block)).cast("int").alias("blocks")), "met")
    sketched = met.join(texts.select(F.col("t").alias("s_t"), "sketch"), F.col("t") == F.col("s_t"))
    ties = settle(_tied(_paired(sketched, "node", ["t", "sketch"]).select("node", "a", "b", "t", "sketch")
                        .repartition("node", "a", "b").sortWithinPartitions("node", "a", "b")).distinct(), "ties")
    clusters = settle(components(ties), "clusters")
    sized = clusters.join(texts.select("t", F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.xxhash64("first_id").alias("kd"), "size"), F.col("id") == F.col("t"))
    sized = settle(sized.select("root", "t", "k1", "k2", "kd", "size"), "sized")
    sizes = store(sized.groupBy(F.col("root").alias("k")).agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(block)), F.ceil(F.sum("size") / F.lit(BLOCK_BYTES)), F.lit(1)).cast("int").alias("blocks")), "sizes")
    placed = sized.join(sizes, F.col("root") == F.col("k")).select(F.col("root").alias("cluster"), "t", "k1", "k2", "kd", "blocks")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    source = df.select(*_prints(text), F.xxhash64(F.col(f"`{id_col}`").cast("bigint")).alias("d"), text.alias("text"))
    found = source.join(placed, (F.col("p1") == F.col("k1")) & (F.col("p2") == F.col("k2")) & (F.col("d") == F.col("kd")))
    dealt = _paired(found, "cluster", ["t", "text"]).select("cluster", "a", "b", "block", F.col("t").alias("id"), "text")
    checked = settle(_verified(dealt.repartition("cluster", "a", "b").sortWithinPartitions("cluster", "a", "b"), percent), "links")
    classes = components(checked.select(F.col("id").alias("u"), F.col("head").alias("v"))).select(F.col("id").alias("c_t"), F.col("root"))
    links = checked.groupBy(F.col("id").alias("l_t")).agg(F.sum("links").alias("links"))
    full = (texts.drop("nodes", "sketch", "size").join(links, F.col("t") == F.col("l_t"), "left").join(classes, F.col("t") == F.col("c_t"), "left")
            .select("p1", "p2", "t", "first_id", "copies", F.coalesce("links", F.lit(0).cast("bigint")).alias("links"), F.coalesce("root", "t").alias("class")))
    full = settle(full, "linked")
    least = store(full.groupBy(F.col("class").alias("k")).agg(F.min(F.struct(F.col("first_id").isNull().alias("last"), "first_id", "t")).alias("least")), "least")
    full = full.join(least, F.col("class") == F.col("k")).select(
        "p1", "p2", "first_id", "copies", "links", F.col("least.first_id").alias("class_id"), (F.col("t") == F.col("least.t")).alias("kept"))
    return rows.select("id", "p1", "p2"), settle(full, "classes")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """One row per input row: the id, class_id (the least id of the class), n_links (other texts linked to its text), n_copies
    (rows with its text) and kept, true for the text that stands for the class."""
    rows, texts = near_texts(df, id_col, text_col, **limits)
    named = texts.withColumnsRenamed({"p1": "k1", "p2": "k2"})
    return rows.join(named, (F.col("p1") == F.col("k1")) & (F.col("p2") == F.col("k2"))).select(
        F.col("id").alias(id_col), "class_id", F.col("links").alias("n_links"), F.col("copies").alias("n_copies"),
        (F.col("kept") & F.col("id").eqNullSafe(F.col("first_id"))).alias("kept"))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """The input with one row of each class: the row with the least id, of rows that repeat that id and text any one."""
    texts = near_texts(df, id_col, text_col, **limits)[1].where("kept")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = df.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)]).alias("row"), *_prints(text),
                     F.xxhash64(F.col(f"`{id_col}`").cast("bigint")).alias("d"))
    kept = texts.select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.xxhash64("first_id").alias("kd"))
    stay = rows.join(kept, (F.col("p1") == F.col("k1")) & (F.col("p2") == F.col("k2")) & (F.col("d") == F.col("kd"))).dropDuplicates(["p1", "p2", "d"])
    return stay.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(df.columns)])
