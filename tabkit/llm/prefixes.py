"""Prefix trie of conversations, by digests of blocks of turns.

Each turn is reduced to a 128-bit digest of its role and text. A prefix is named by the exclusive or of 128-bit hashes of (depth, turn
digest) over its turns, so names of prefixes are running sums, which may be taken in slices; equal names mean equal prefixes but for a
chance of 2^-128 a pair. Conversations are cut into blocks of ``BLOCK`` turns and grouped by the name of their prefix at the end of a
block: copies meet there once per block instead of once per turn. Different blocks behind one and the same prefix are siblings. Only
where a prefix has siblings are the blocks, one row for each different one, opened and grouped turn by turn; a block without siblings is
a chain of nodes that all belong to the same conversations.

A node belongs to its smallest member. The nodes of a conversation are then one stretch of its path, from the depth where it is the
smallest to its end, and stretches hang on stretches of smaller conversations. What a node's subtree holds is the rest of its stretch
plus all stretches that hang on this rest. Whole stretches are summed up over that tree by doubling: in each round a
stretch adds the sums of those twice as far below, so the rounds are the logarithm of the tree's height, also where every
conversation hangs on the one before it. Running sums along one conversation are taken in slices of ``SLICE`` turns that start from the sums of
the slices before, so a conversation with a third of all turns is many tasks; it is numbered in ranges of (conversation, turn).

The ids of the conversations that end at a node are hashed in numeric order. They are sorted over the whole table, written on end in
chunks by the tasks that hold them, and only chunks meet by node; the hash itself is a stream over them in one task, as a
SHA-256 is, with one chunk in memory.

Cases: a NULL conv_id is no conversation; NULL roles and texts are empty; NULL turns come first, and equal turns of a conversation go by
their digests, so repeated rows are turns of their own; long texts are read once, where they are hashed; an empty table has no node; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabkit.llm.stored import discard, store
from tabkit.runtime import settle

BLOCK = 4
SLICE = 1024  # turns; a multiple of BLOCK
HEAD = 9  # a conversation takes 0 to 8 turns of another
FAMILY = 5
CHUNK_BYTES = 1_000_000
NO_IDS = hashlib.sha256(b"").hexdigest()


def numbered_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Stored (conv, pos, d1, d2, bytes): the turns of every conversation in order, from 1, each by its digest and the bytes of its text."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = df.select(F.col(f"`{conv_col}`").cast("bigint").alias("conv"), F.col(f"`{turn_col}`").cast("bigint").alias("turn"),
                      F.xxhash64(role, text).alias("d1"), F.xxhash64(F.lit("second"), text, role).alias("d2"),
                      F.octet_length(text).cast("bigint").alias("bytes")).where("conv IS NOT NULL")
    order = ["turn", "d1", "d2"]  # NULL turns first
    # stored, because a range computed anew could begin elsewhere
    ranged = settle(turns.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()), "turns")
    held = ranged.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    # of each conversation that goes on in a later range, one row per range
    before = (held.withColumn("before", F.sum("n").over(W.partitionBy("conv").orderBy("part")) - F.col("n")).where("before > 0")
              .select(F.col("conv").alias("k"), F.col("part").alias("kp"), "before"))
    inside = F.row_number().over(W.partitionBy("conv", "part").orderBy(*order))
    return settle(ranged.withColumn("pos", inside).join(before, (F.col("conv") == F.col("k")) & (F.col("part") == F.col("kp")), "left")
                  .select("conv", (F.col("pos") + F.coalesce("before", F.lit(0))).cast("bigint").alias("pos"), "d1", "d2", "bytes"), "numbered")


def rebuilt(turns: DataFrame, family: int = FAMILY, head: int = HEAD) -> tuple[DataFrame, DataFrame]:
    """Stored turns (conv, depth, d1, d2, bytes) and conversations (conv, turns): every conversation opens with the first turns of the
    first of its family of ids, as many as the CRC of its own id says, in place of as many of its own."""
    own = turns.groupBy("conv").agg(F.max("pos").alias("n"))
    taken = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(head)).cast("bigint")
    all_convs = own.select("conv", "n", taken.alias("h"), (F.col("conv") - F.col("conv") % family).alias("base"))
    bases = own.select(F.col("conv").alias("b_conv"), F.col("n").alias("b_n"))
    opened = F.least("h", F.coalesce("b_n", F.lit(0)))
    convs = settle(all_convs.join(bases, F.col("base") == F.col("b_conv"), "left").select(
        "conv", "h", "base", opened.alias("opened"), (opened + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("turns")), "conversations")
    mine = convs.select(F.col("conv").alias("k"), "h", "opened")
    tails = turns.where(F.col("pos") > taken).join(mine, F.col("conv") == F.col("k")).select(
        "conv", (F.col("pos") - F.col("h") + F.col("opened")).alias("depth"), "d1", "d2", "bytes")
    heads = turns.where(F.col("pos") < head).select(F.col("conv").alias("b_conv"), "pos", "d1", "d2", "bytes")
    opens = convs.where("opened > 0").select("conv", "base", "opened").join(heads, (F.col("base") == F.col("b_conv")) & (F.col("pos") <= F.col("opened"))).select(
        "conv", F.col("pos").alias("depth"), "d1", "d2", "bytes")
    return settle(tails.unionByName(opens), "rebuilt"), convs.select("conv", "turns")


def _xor(a: str, b: str) -> Column:
    return F.col(a).bitwiseXOR(F.col(b))


def _slice_of(depth: Column) -> Column:
    return F.floor((depth - 1) / SLICE)


def block_groups(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Stored blocks, one row per different one: depth (of its last turn), p1, p2 (prefix with it), q1, q2 (prefix before it), conv
    (smallest member), n, turns (depth, x1, x2, bytes; x1, x2 the prefix from the start of the block); and ends (conv, depth, p1, p2)."""
    named = turns.select("conv", "depth", F.xxhash64("depth", "d1", "d2").alias("x1"), F.xxhash64("d2", "depth", "d1").alias("x2"), "bytes",
                         _slice_of(F.col("depth")).alias("slice"), F.floor((F.col("depth") - 1) / block).alias("block"))
    along = W.partitionBy("conv", "slice").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    within = W.partitionBy("conv", "slice", "block").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    run = named.select("conv", "slice", "block", "depth", "bytes", *[F.bit_xor(x).over(along).alias(r) for x, r in (("x1", "r1"), ("x2", "r2"))],
                       *[F.bit_xor(x).over(within).alias(x) for x in ("x1", "x2")])
    last = F.max_by(F.struct("r1", "r2", "x1", "x2"), "depth")
    blocks = settle(run.groupBy("conv", "slice", "block").agg(
        F.max("depth").alias("depth"), last.alias("last"), F.sort_array(F.collect_list(F.struct("depth", "x1", "x2", "bytes"))).alias("turns")), "blocks")
    # conversations of more than one slice: what the slices before hold
    sums = blocks.groupBy("conv", "slice").agg(F.max_by(F.struct("last.r1", "last.r2"), "depth").alias("all")).select("conv", "slice", "all.r1", "all.r2")
    earlier = W.partitionBy("conv").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    before = (sums.select(F.col("conv").alias("k"), F.col("slice").alias("ks"), F.bit_xor("r1").over(earlier).alias("s1"), F.bit_xor("r2").over(earlier).alias("s2"))
              .where("ks > 0"))
    zero = F.lit(0).cast("bigint")
    placed = blocks.join(before, (F.col("conv") == F.col("k")) & (F.col("slice") == F.col("ks")), "left").select(
        "conv", "depth", "turns", F.col("last.r1").bitwiseXOR(F.coalesce("s1", zero)).alias("p1"), F.col("last.r2").bitwiseXOR(F.coalesce("s2", zero)).alias("p2"),
        F.col("last.x1").alias("l1"), F.col("last.x2").alias("l2"))
    placed = settle(placed, "placed")
    groups = placed.groupBy("depth", "p1", "p2").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n"), F.first("turns").alias("turns"),
                                                     F.first("l1").alias("l1"), F.first("l2").alias("l2"))
    groups = settle(groups.select("depth", "p1", "p2", _xor("p1", "l1").alias("q1"), _xor("p2", "l2").alias("q2"), "conv", "n", "turns"), "groups")
    done = convs.select(F.col("conv").alias("k"), F.col("turns").alias("kt"))
    ends = (placed.select("conv", "depth", "p1", "p2").join(done, (F.col("conv") == F.col("k")) & (F.col("depth") == F.col("kt")))
            .select("conv", "depth", "p1", "p2"))
    none = convs.where("turns = 0").select("conv", zero.alias("depth"), zero.alias("p1"), zero.alias("p2"))
    return groups, ends.unionByName(none)


def trie_nodes(groups: DataFrame, convs: DataFrame) -> DataFrame:
    """Stored nodes: depth, p1, p2, u1, u2 (the parent's prefix), conv (smallest member), n, bytes (of the last text)."""
    siblings = groups.groupBy("q1", "q2", F.element_at("turns", 1)["depth"].alias("begin")).agg(F.count(F.lit(1)).alias("blocks")).select(
        F.col("q1").alias("k1"), F.col("q2").alias("k2"), "begin", "blocks")
    siblings = store(siblings, "siblings")
    told = groups.join(siblings, (F.col("q1") == F.col("k1")) & (F.col("q2") == F.col("k2")) & (F.element_at("turns", 1)["depth"] == F.col("begin")))
    opened = told.select("conv", "n", "blocks", "q1", "q2", F.posexplode("turns").alias("i", "t"), "turns").select(
        "conv", "n", "blocks", F.col("t.depth").alias("depth"), F.col("t.bytes").alias("bytes"),
        F.col("q1").bitwiseXOR(F.col("t.x1")).alias("p1"), F.col("q2").bitwiseXOR(F.col("t.x2")).alias("p2"),
        F.when(F.col("i") == 0, F.col("q1")).otherwise(F.col("q1").bitwiseXOR(F.get("turns", F.col("i") - 1)["x1"])).alias("u1"),
        F.when(F.col("i") == 0, F.col("q2")).otherwise(F.col("q2").bitwiseXOR(F.get("turns", F.col("i") - 1)["x2"])).alias("u2"))
    opened = settle(opened, "opened")
    names = ["depth", "p1", "p2", "u1", "u2", "conv", "n", "bytes"]
    chains = opened.where("blocks = 1").select(*names)
    forks = opened.where("blocks > 1").groupBy("depth", "p1", "p2").agg(
        F.first("u1").alias("u1"), F.first("u2").alias("u2"), F.min("conv").alias("conv"), F.sum("n").alias("n"), F.first("bytes").alias("bytes")).select(*names)
    zero = F.lit(0).cast("bigint")
    root = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n")).where("n > 0").select(
        zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), F.lit(None).cast("bigint").alias("u1"), F.lit(None).cast("bigint").alias("u2"), "conv", "n", zero.alias("bytes"))
    return settle(chains.unionByName(forks).unionByName(root), "nodes")


def subtree_sums(stretches: DataFrame) -> DataFrame:
    """(id, a, b) from (id, parent, a, b): the sums of a and b over each row and all below it, in rounds that double the distance."""
    now = store(stretches.select("id", F.col("parent").alias("up"), "a", "b"), "stretches")
    while True:
        below = now.where("up IS NOT NULL").groupBy("up").agg(F.sum("a").alias("more_a"), F.sum("b").alias("more_b")).withColumnRenamed("up", "k")
        higher = now.where("up IS NOT NULL").select(F.col("id").alias("h"), F.col("up").alias("higher"))
        below = store(below, "below")
        if below.isEmpty():
            discard(below)
            return now.select("id", "a", "b")
        summed = now.join(below, F.col("id") == F.col("k"), "left").select(
            "id", "up", (F.col("a") + F.coalesce("more_a", F.lit(0))).alias("a"), (F.col("b") + F.coalesce("more_b", F.lit(0))).alias("b"))
        before, now = now, store(summed.join(higher, F.col("up") == F.col("h"), "left").select("id", F.col("higher").alias("up"), "a", "b"), "stretches")
        discard(before)
        discard(below)


def ends_hashes(ends: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(depth, p1, p2, hash) of every node where a conversation ends: SHA-256 of the ids in numeric order, joined by commas."""
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, size, out, held = None, [], 0, [], 0

        def flush() -> None:
            nonlocal ids, size, held
            if ids:
                out.append((*key, ids[0], ",".join(map(str, ids)).encode()))
                held, ids, size = held + size, [], 0

        def emit() -> pa.RecordBatch:
            nonlocal out, held
            made = pa.record_batch([pa.array(c, pa.binary() if i == 4 else pa.int64()) for i, c in enumerate(zip(*out))], ["depth", "p1", "p2", "least", "ids"])
            out, held = [], 0
            return made

        for batch in batches:
            for *at, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if at != key or size >= chunk_bytes:
                    flush()
                    key = at
                ids.append(conv)
                size += 20
                if held >= chunk_bytes or len(out) >= 10_000:
                    yield emit()
        flush()
        if out:
            yield emit()

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, out = None, None, []
        for batch in batches:
            for *at, ids in zip(*(batch.column(c) for c in (0, 1, 2, 4))):
                at = [x.as_py() for x in at]
                if at == key:
                    digest.update(b",")
                else:
                    if key is not None:
                        out.append((*key, digest.hexdigest()))
                    key, digest = at, hashlib.sha256()
                digest.update(ids.as_buffer())
            if len(out) >= 10_000:
                yield pa.record_batch([pa.array(c) for c in zip(*out)], ["depth", "p1", "p2", "hash"])
                out = []
        if key is not None:
            out.append((*key, digest.hexdigest()))
        if out:
            yield pa.record_batch([pa.array(c) for c in zip(*out)], ["depth", "p1", "p2", "hash"])

    ordered = ends.select("depth", "p1", "p2", "conv").repartitionByRange("depth", "p1", "p2", "conv").sortWithinPartitions("depth", "p1", "p2", "conv")
    packed = ordered.mapInArrow(chunks, "depth bigint, p1 bigint, p2 bigint, least bigint, ids binary")
    met = packed.repartition("depth", "p1", "p2").sortWithinPartitions("depth", "p1", "p2", "least")
    return met.mapInArrow(stream, "depth bigint, p1 bigint, p2 bigint, hash string")


def prefix_trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                family: int = FAMILY, head: int = HEAD) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    turns, convs = rebuilt(numbered_turns(df, conv_col, turn_col, role_col, text_col), family, head)
    groups, ends = block_groups(turns, convs)
    nodes = trie_nodes(groups, convs)

    above = nodes.select(F.col("depth").alias("ud"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.col("conv").alias("parent"))
    told = settle(nodes.join(above, (F.col("u1") == F.col("k1")) & (F.col("u2") == F.col("k2")) & (F.col("depth") - 1 == F.col("ud")), "left").select(
        "depth", "p1", "p2", "conv", "n", "bytes", "parent"), "told")
    # first nodes of stretches, where the parent belongs to another conversation
    hung = told.where("parent <> conv").select("conv", "parent", (F.col("depth") - 1).alias("at"))
    forks = store(hung.groupBy(F.col("parent").alias("f_conv"), F.col("at").alias("f_depth")).agg(F.count(F.lit(1)).alias("branches")), "forks")
    ending = convs.select(F.col("conv").alias("c"), F.col("turns").alias("last"))
    own = told.join(ending, F.col("conv") == F.col("c")).join(forks, (F.col("conv") == F.col("f_conv")) & (F.col("depth") == F.col("f_depth")), "left").select(
        "depth", "p1", "p2", "conv", "n", "parent", ((F.col("n") - 1) * F.col("bytes")).alias("saved"),
        (F.coalesce("branches", F.lit(0)) + (F.col("depth") < F.col("last")).cast("bigint")).alias("children"))
    own = settle(own.withColumn("leaf", (F.col("children") == 0).cast("bigint")), "own")

    stretches = own.groupBy("conv").agg(F.sum("saved").alias("a"), F.sum("leaf").alias("b")).select(F.col("conv").alias("id"), "a", "b")
    hanging = hung.select(F.col("conv").alias("hc"), F.col("parent").alias("up_conv"), "at")
    below = subtree_sums(stretches.join(hanging, F.col("id") == F.col("hc"), "left").select("id", F.col("up_conv").alias("parent"), "a", "b"))
    on = (hanging.join(below, F.col("hc") == F.col("id")).groupBy(F.col("up_conv").alias("o_conv"), F.col("at").alias("o_depth"))
          .agg(F.sum("a").alias("on_a"), F.sum("b").alias("on_b")))
    weighed = own.join(store(on, "on"), (F.col("conv") == F.col("o_conv")) & (F.col("depth") == F.col("o_depth")), "left").select(
        "depth", "p1", "p2", "conv", "n", "parent", "children", F.floor(F.col("depth") / SLICE).alias("slice"),
        (F.col("saved") + F.coalesce("on_a", F.lit(0))).alias("a"), (F.col("leaf") + F.coalesce("on_b", F.lit(0))).alias("b"))
    weighed = settle(weighed, "weighed")

    # the rest of the stretch: inside the slice, and the slices behind it
    rest = W.partitionBy("conv", "slice").orderBy(F.col("depth").desc()).rowsBetween(W.unboundedPreceding, 0)
    later = W.partitionBy("conv").orderBy(F.col("slice").desc()).rowsBetween(W.unboundedPreceding, -1)
    behind = (weighed.groupBy("conv", "slice").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
              .select(F.col("conv").alias("k"), F.col("slice").alias("ks"), F.sum("a").over(later).alias("later_a"), F.sum("b").over(later).alias("later_b"))
              .where("later_a IS NOT NULL"))
    summed = weighed.select("*", F.sum("a").over(rest).alias("rest_a"), F.sum("b").over(rest).alias("rest_b")).join(
        behind, (F.col("conv") == F.col("k")) & (F.col("slice") == F.col("ks")), "left")
    hashes = ends_hashes(ends).select(F.col("depth").alias("e_depth"), F.col("p1").alias("e1"), F.col("p2").alias("e2"), "hash")
    full = summed.join(hashes, (F.col("depth") == F.col("e_depth")) & (F.col("p1") == F.col("e1")) & (F.col("p2") == F.col("e2")), "left")
    return full.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        (F.col("rest_b") + F.coalesce("later_b", F.lit(0))).alias("n_leaves"), (F.col("rest_a") + F.coalesce("later_a", F.lit(0))).alias("saved_tokens"),
        F.coalesce("hash", F.lit(NO_IDS)).alias("ends_sha256"))


SQL = r"""
WITH convs AS (SELECT conv_id AS c, conv_id - conv_id % 5 AS base, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, x: list_reduce([xor(a, x), 1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[], lambda v, k: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))) AS crc
    FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
heads AS (SELECT c, base, xor(crc, 4294967295::BIGINT) % 9 AS h FROM convs),
turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos FROM conversations WHERE conv_id IS NOT NULL),
joined AS (SELECT c, pos, role, text, 0 AS part FROM heads JOIN turns ON turns.conv_id = base AND pos <= h
    UNION ALL SELECT c, pos, role, text, 1 FROM heads JOIN turns ON turns.conv_id = c AND pos > h),
placed AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d, role, text FROM joined),
named AS (SELECT c, d, md5(string_agg(md5(role) || md5(text), '' ORDER BY d) OVER (PARTITION BY c ORDER BY d)) AS p, strlen(text) AS bytes FROM placed
    UNION ALL SELECT c, 0, '', 0 FROM heads),
lasts AS (SELECT c, max(d) AS d FROM named GROUP BY c),
ends AS (SELECT d, p, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM named JOIN lasts USING (c, d) GROUP BY d, p),
nodes AS (SELECT d, p, min(c) AS conv, count(*) AS n, min(bytes) AS bytes FROM named GROUP BY d, p),
ups AS (SELECT DISTINCT a.d, a.p, b.p AS up FROM named a JOIN named b ON a.c = b.c AND a.d = b.d + 1),
kids AS (SELECT d - 1 AS d, up AS p, count(*) AS kids FROM ups GROUP BY ALL),
full_nodes AS (SELECT nodes.*, coalesce(kids, 0) AS kids FROM nodes LEFT JOIN kids USING (d, p)),
under AS (SELECT DISTINCT a.d, a.p, b.d AS bd, b.p AS bp FROM named a JOIN named b ON a.c = b.c AND a.d <= b.d),
sums AS (SELECT u.d, u.p, sum((x.n - 1) * x.bytes) AS saved, count(*) FILTER (x.kids = 0) AS leaves FROM under u JOIN full_nodes x ON x.d = u.bd AND x.p = u.bp GROUP BY ALL)
SELECT f.conv::BIGINT AS conv_id, f.d::BIGINT AS depth, pn.conv::BIGINT AS parent_conv_id, f.n::BIGINT AS n_convs, f.kids::BIGINT AS n_children,
    s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM full_nodes f JOIN sums s ON s.d = f.d AND s.p = f.p LEFT JOIN ups ON ups.d = f.d AND ups.p = f.p
LEFT JOIN nodes pn ON pn.d = f.d - 1 AND pn.p = ups.up LEFT JOIN ends e ON e.d = f.d AND e.p = f.p
"""
