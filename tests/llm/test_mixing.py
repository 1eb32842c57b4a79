"""Source mixing against its definition, and the cases it has to bear."""

import math
import random
import re
from collections import defaultdict

import pytest

from tabkit.llm import mixing
from tests.llm.frames import SCHEMA, edge_docs, edge_rows, empty_docs, prose


def table(seed, n):
    draw = random.Random(seed)
    sources = ["a", "b", "B", "é", "zz", None, "", "hot"]
    return [(i if i % 31 else None, prose(i % 60, draw.choice((0, 1, 5, 40, 300))) if i % 11 else None, "en",
             "hot" if i % 3 == 0 else draw.choice(sources), 0) for i in range(n)]


def targets(rows, weights, budget, most):
    """Shares in rounds, as the rule says it: what is above its limit stops there, the rest is shared anew."""
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    open_, target, left = set(names), {}, budget * sum(sizes.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > most * sizes[s]}
        if not above:
            return {**target, **share}, sizes
        for s in above:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= above
    return target, sizes


@pytest.mark.parametrize("weights,budget,most,slice_rows", [((3, 1, 2), 1.5, 2, 50_000), ((3, 1, 2), 1.5, 2, 40), ((1, 7), 0.3, 1, 25), ((5,), 2.9, 3, 100), ((1, 2), 9.0, 2, 60)])
def test_targets_and_order(spark, weights, budget, most, slice_rows):
    rows = table(5, 500)
    want, sizes = targets(rows, weights, budget, most)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = mixing.mix_sources(df, weights=weights, budget=budget, most=most, slice_rows=slice_rows).collect()
    assert len(got) == len(rows)
    by_target = defaultdict(list)
    for r in got:
        assert r.taken in [r["size"] * k for k in range(most + 1)]
        by_target[(r.source_size, round(r.target, 6))].append(r)
    total = budget * sum(sizes.values())
    taken = sum(r.taken for r in got)
    longest = max(r["size"] for r in got)
    assert taken <= total + 1e-6 and (taken == most * sum(sizes.values()) or taken > total - longest)
    for s, size in sizes.items():
        near = by_target[(size, round(float(want[s]), 6))]
        assert near and abs(sum(r.taken for r in near) - want[s] * (len(near) / sum(r[3] == s for r in rows))) <= 2 * longest * max(1, len(near))
    # of one source no document is taken oftener than one whose finish comes before
    for rows_of in by_target.values():
        inside = sorted((r for r in rows_of if r["size"]), key=lambda r: r.finish)
        times = [r.taken // r["size"] for r in inside]
        assert max(times, default=0) - min(times, default=0) <= 1 and times == sorted(times, reverse=True)


def test_same_on_every_run_and_in_any_order(spark):
    df = spark.createDataFrame(table(9, 300), SCHEMA)
    seen = [sorted(map(str, mixing.mix_sources(d, slice_rows=30).collect())) for d in (df.repartition(7), df.coalesce(1), df.orderBy("text"))]
    assert seen[0] == seen[1] == seen[2]


def test_level(spark):
    sources = spark.createDataFrame([("a", 10, 1), ("b", 100, 1), ("c", 1000, 2)], "s string, source_size bigint, weight bigint")
    assert mixing.fair_level(sources, 40, 2) == 10.0
    assert mixing.fair_level(sources, 400, 2) == pytest.approx((400 - 20) / 3)
    assert math.isinf(mixing.fair_level(sources, 5000, 2))


def test_cases(spark):
    got = mixing.mix_sources(edge_docs(spark)).collect()
    assert len(got) == len(edge_rows())
    assert {r.taken for r in got if r["size"] == 0} == {0}
    total = sum(r["size"] for r in got)
    assert 0 < sum(r.taken for r in got) <= 1.5 * total
    empty = mixing.mix_sources(empty_docs(spark))
    assert empty.columns == ["doc_id", "size", "source_size", "target", "taken", "finish"] and empty.count() == 0
    wordless = mixing.mix_sources(edge_docs(spark, [(1, None, "en", "a", 0), (2, " ", "en", None, 0)])).collect()
    assert [(r["size"], r.target, r.taken) for r in wordless] == [(0, 0.0, 0)] * 2
    with pytest.raises(ValueError):
        mixing.mix_sources(edge_docs(spark), weights=())
