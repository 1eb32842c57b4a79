"""Prefix trie against a trie in plain Python, and the cases it has to bear."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tabkit.llm import prefixes
from tests.llm.frames import CLASHING

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def rebuild(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    return out


def brute(rows):
    convs = rebuild(rows)
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    below, leaves, kids = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            kids[path[:-1]] += 1
    for path, inside in members.items():
        saved = (len(inside) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            below[path[:d]] += saved
            leaves[path[:d]] += path not in kids
    return sorted((members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), kids[p], leaves[p], below[p],
                   hashlib.sha256(",".join(str(c) for c in members[p] if len(convs[c]) == len(p)).encode()).hexdigest()) for p in members)


def check(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = prefixes.prefix_trie(df, **how)
    assert [c for c, _ in got.dtypes] == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def random_rows(seed, convs, longest, words):
    draw = random.Random(seed)
    return [(c, t, draw.choice(("user", "assistant")), draw.choice(words)) for c in range(convs) for t in range(draw.randrange(1, longest))]


@pytest.mark.parametrize("seed,longest,words", [(1, 9, "ab"), (2, 30, "a"), (3, 6, "abcdefgh"), (4, 14, ["é🙂", "x" * 500])])
def test_against_a_trie(spark, seed, longest, words):
    check(spark, random_rows(seed, 80, longest, words))


def test_every_conversation_goes_on_where_the_last_one_ended(spark, monkeypatch):
    """Stretches hang on each other in one line; slices are short, so that paths cross them."""
    monkeypatch.setattr(prefixes, "SLICE", 8)
    rows = [(5 * c, t, "user", f"t{t}") for c in range(40) for t in range(c + 1)]
    check(spark, rows + [(5 * c + 1, t, "user", f"t{t}" if t < c else "other") for c in range(40) for t in range(20)])


def test_one_conversation_with_most_turns(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "SLICE", 64)
    rows = [(7, t, "user", f"{t % 5}") for t in range(350)] + [(15, t, "user", f"{t % 5}") for t in range(270)]
    df = spark.createDataFrame(rows + [(20, t, "user", f"{t % 5}") for t in range(3)], SCHEMA)
    assert sorted(map(tuple, prefixes.prefix_trie(df.repartition(3)).select("conv_id", "depth", "n_convs", "n_children", "saved_tokens", "n_leaves").collect())) == sorted(
        (r[0], r[1], r[3], r[4], r[6], r[5]) for r in brute(rows + [(20, t, "user", f"{t % 5}") for t in range(3)]))


def test_many_ends_at_one_node(spark):
    rows = [(c, t, "user", "same") for c in range(300) for t in range(9)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    ends = df.selectExpr("conv_id AS conv", "0L AS depth", "0L AS p1", "0L AS p2").distinct()
    want = hashlib.sha256(",".join(map(str, range(300))).encode()).hexdigest()
    assert [r.hash for r in prefixes.ends_hashes(ends, chunk_bytes=100).collect()] == [want]
    check(spark, rows)


def test_cases(spark):
    rows = [(1, None, None, None), (1, 0, "", ""), (1, 0, "", ""), (1, 3, "user", "é" * 100_000), (None, 0, "user", "lost"), (2, None, "user", "b"), (2, None, "user", "a"),
            (-3, 0, "user", "negative"), (10, 0, "user", "x"), (11, 0, "user", "x"), (12, 0, "user", "x"), (3, 0, "user", "turnless")]
    rows = [r for r in rows if r[0] is None or r[0] >= 0]
    df = spark.createDataFrame(rows, SCHEMA)
    got = prefixes.prefix_trie(df.selectExpr("*", *[f"'x' AS {c}" for c in CLASHING if c not in df.columns]))
    want = {(r[0], r[1]): r[3:7] for r in brute(rows)}
    assert {(r.conv_id, r.depth): (r.n_convs, r.n_children, r.n_leaves, r.saved_tokens) for r in got.collect()} == want
    assert prefixes.prefix_trie(df.limit(0)).count() == 0
