"""Ranked search against scoring every document, and the cases it has to bear."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tabkit.llm import ranked
from tests.llm.frames import CLASHING, SCHEMA, WORDS, edge_docs, edge_rows, empty_docs, prose

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(TERM, (text or "").translate(LOWER))


def brute(docs, items, top):
    counts = [(r[0], Counter(terms(r[1]))) for r in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n, length = len(counts), sum(x[2] for x in counts)
    held = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, size in counts:
            m = 50 + (50 * size * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, rank, None if null else i, -score) for rank, (score, null, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def corpus():
    draw = random.Random(3)
    rows = [(i, " ".join(draw.choice(WORDS[:draw.choice((4, 12, 24))]) for _ in range(draw.choice((1, 3, 20, 200)))), "en", "s", 0) for i in range(400)]
    same = rows[7][1]
    return rows + [(1000 + i, same, "en", "s", 0) for i in range(90)] + [(None, same + " Rare É", "en", "s", 0), (None, "", "en", "s", 0), (5, None, "en", "s", 0), rows[3], rows[3]]


def items():
    draw = random.Random(4)
    return [(i, " ".join(draw.choice(WORDS) for _ in range(draw.choice((1, 4, 30))))) for i in range(12)] + [
        (50, None), (51, "..."), (None, "alpha beta"), (52, "rare É alpha"), (52, "rare É alpha"), (53, "unknown"), (54, " ".join(WORDS) * 3 + " " + prose(2, 200))]


@pytest.mark.parametrize("top,block,item_bytes", [(50, 4096, 8_000_000), (3, 64, 8_000_000), (7, 33, 200)])
def test_against_brute_force(spark, monkeypatch, top, block, item_bytes):
    monkeypatch.setattr(ranked, "BLOCK", block)
    monkeypatch.setattr(ranked, "CELLS", 500 if block == 33 else 2_000_000)
    df = spark.createDataFrame(corpus(), SCHEMA).repartition(6)
    asked = spark.createDataFrame(items(), "item_id bigint, text string")
    got = ranked.search(df, asked, top=top, item_bytes=item_bytes)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=str) == brute(corpus(), items(), top)


def test_masks():
    draw = np.random.default_rng(1)
    for width in (1, 8, 63, 64, 65, 200):
        present = draw.random((300, width)) < 0.02
        first, group = ranked.masks_of(present)
        assert (present[first][group] == present).all()
        assert len(first) == len({row.tobytes() for row in present})


def test_finished_masks_are_not_scored():
    """Documents whose mask cannot reach the list are never summed up."""
    lists, seen = ranked.Lists(1, 2, np.ones(1, np.int64)), []
    enter = lists.add
    lists.add = lambda item, scores, ids: (seen.extend(ids.tolist()), enter(item, scores, ids))
    doc = np.arange(1000)
    term = np.where(doc < 4, 0, np.where(doc < 500, 1, 2))
    ranked.rank_block(doc, doc, term, np.array([90, 5, 3])[term], [np.array([0, 1, 2])], 3, lists)
    assert lists.ids[0].tolist() == [0, 1] and set(seen) == set(range(500))


def test_cases(spark):
    asked = spark.createDataFrame([(1, "one two alpha3"), (2, "日本 naïve"), (3, "")], "item_id bigint, text string")
    got = ranked.search(edge_docs(spark), asked.selectExpr("*", *[f"'x' AS {c}" for c in CLASHING]))
    assert sorted(map(tuple, got.collect()), key=str) == brute(edge_rows(), [(1, "one two alpha3"), (2, "日本 naïve")], 50)
    assert ranked.search(empty_docs(spark), asked).count() == 0
    assert ranked.search(edge_docs(spark), asked.limit(0)).count() == 0
