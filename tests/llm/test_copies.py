"""Line dedup, the Jaccard join and decontamination against brute force."""

import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from tabkit.llm import graph, leaks, lines, near
from tests.llm.frames import SCHEMA, WORDS, edge_docs, edge_rows, empty_docs, prose

SPACE = " \t\n\x0b\x0c\r"


def corpus():
    """Texts of few different lines, so that runs repeat within and across them, and copies of all kinds."""
    draw = random.Random(11)
    pool = [" ".join(draw.choice(WORDS) for _ in range(draw.choice((1, 2, 5, 9, 30, 55)))) for _ in range(25)]
    texts = ["\n".join(draw.choice(pool) for _ in range(draw.randrange(0, 14))) for _ in range(120)]
    texts += [prose(70, 200), prose(70, 200), " " + prose(70, 200).replace("\n", " \r\n"), "x\n" * 70, "", None]
    base = prose(71, 150).split()
    for _ in range(40):
        words = list(base)
        for _ in range(draw.randrange(0, 5)):
            words[draw.randrange(len(words))] = draw.choice(WORDS)
        texts.append(" ".join(words))
    rows = [(i if i % 17 else None, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (3, "another text with this id", "en", "s", 0)]


def order_of(rows, prints):
    return sorted({(r[0] is None, r[0] or 0, prints[r[1] or ""], r[1] or "") for r in rows})


def without_copies(rows, prints, least):
    """What stays of every (id, text): lines in a run of enough words that starts somewhere before go."""
    first, gone, kept = {}, defaultdict(set), {}
    docs = order_of(rows, prints)
    wordy = {d: [(i, x.strip(SPACE), len(re.findall(f"[^{SPACE}]+", x))) for i, x in enumerate(d[3].split("\n")) if x.strip(SPACE)] for d in docs}
    for at, d in enumerate(docs):
        own = wordy[d]
        for a in range(len(own)):
            words, run = 0, ()
            for b in range(a, len(own)):
                words, run = words + own[b][2], (*run, own[b][1])
                if words >= least and first.setdefault(run, (at, a)) != (at, a):
                    gone[d] |= {own[j][0] for j in range(a, b + 1)}
        kept[d] = ("\n".join(x for i, x in enumerate(d[3].split("\n")) if i not in gone[d]), len(gone[d]))
    return kept


@pytest.mark.parametrize("least", [50, 12, 1])
def test_line_dedup(spark, least):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    prints = {r.text or "": r.p for r in df.selectExpr("text", "xxhash64(coalesce(text, '')) AS p").collect()}
    want = without_copies(rows, prints, least)
    got = lines.dedup_lines(df, least_words=least)
    assert got.columns == [*df.columns, "removed_lines"]
    expected = Counter()
    for r in rows:
        text, lost = want[(r[0] is None, r[0] or 0, prints[r[1] or ""], r[1] or "")]
        expected[(r[0], None if r[1] is None else text, lost)] += 1
    assert Counter((r.doc_id, r.text, r.removed_lines) for r in got.collect()) == expected


def test_line_dedup_edges(spark):
    docs = edge_docs(spark)
    got = lines.dedup_lines(docs)
    assert got.columns == [*docs.columns, "removed_lines_"] and got.count() == len(edge_rows())
    assert {r.text for r in got.where("doc_id = 8 OR doc_id IS NULL").collect()} == {"", None}  # copies of document 6
    assert [r.text for r in got.where("doc_id = 6 AND n_chars = 7").collect()] == [prose(2, 120)] * 2
    assert lines.dedup_lines(empty_docs(spark)).collect() == []


def shingles(text):
    words = re.findall("[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def classes_of(rows, percent=80):
    """What the join returns for every row, counted, and the number of classes."""
    sets = {t: shingles(t) for t in {r[1] or "" for r in rows}}
    links, root = Counter(), {t: t for t in sets}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    for a, b in combinations(sets, 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    ids = defaultdict(list)
    for r in rows:
        ids[find(r[1] or "")].append((r[0] is None, r[0] or 0))
    least = {k: None if min(v)[0] else min(v)[1] for k, v in ids.items()}
    times = Counter(r[1] or "" for r in rows)
    return Counter((r[0], least[find(r[1] or "")], links[r[1] or ""], times[r[1] or ""]) for r in rows), len(ids)


@pytest.mark.parametrize("block", [64, 3])
def test_jaccard_join(spark, block):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    got = near.near_duplicates(df, block=block).collect()
    want, classes = classes_of(rows)
    assert Counter((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in got) == want
    assert near.one_of_each(df, block=block).count() == classes


def test_jaccard_join_edges(spark):
    docs = edge_docs(spark)
    got = near.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in got) == classes_of(edge_rows())[0]
    kept = near.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 5, 6, 3, 6, 9, 10, 11], key=str)
    assert near.near_duplicates(empty_docs(spark)).collect() == [] and near.one_of_each(empty_docs(spark)).collect() == []


def test_prefix_depth():
    assert near.prefix_depth(0.8) == 6 and 1 - (1 - 0.8 ** 6) ** near.TREES >= near.RECALL
    assert near.prefix_depth(0.8, trees=1) == 1


def test_linked_sets():
    draw = np.random.default_rng(2)
    sets = [np.unique(draw.integers(0, 30, draw.integers(1, 40))).astype(np.uint64) for _ in range(40)]
    got = near.linked(sets, 60)
    for i, j in combinations(range(40), 2):
        a, b = set(sets[i].tolist()), set(sets[j].tolist())
        assert got[i, j] == got[j, i] == (100 * len(a & b) >= 60 * len(a | b))


def test_components(spark):
    draw = random.Random(4)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, i) for i in range(5001, 5200)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = graph.components(spark.createDataFrame(edges, "u bigint, v bigint"))
    assert {(r.id, r.root) for r in got.collect()} == {(x, find(x)) for x in root}
    assert graph.components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


def weighted(a, b):
    return sum((a & b).values()) / sum((a | b).values())


def counted(words, size):
    return Counter(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def held_items(rows, items, percent=80):
    out = {}
    for key, text in rows:
        words = re.findall("[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())
        for item, item_text in items:
            own = re.findall("[a-z0-9\u0080-\U0010ffff]+", (item_text or "").lower())
            if not own:
                continue
            size = min(5, len(own))
            if not counted(words, size) & counted(own, size):
                continue  # every window has similarity 0
            n, best = min(len(own), len(words)), (0, 0)
            for i in range(len(words) - n + 1):
                if n >= size and n:
                    best = max(best, (weighted(counted(words[i:i + n], size), counted(own, size)), -i))
            if 100 * best[0] >= percent - 1e-9:
                out[(key, item)] = (round(best[0], 9), -best[1])
    return out


def test_decontamination(spark):
    draw = random.Random(8)
    items = [(i, prose(900 + i, n)) for i, n in enumerate((15, 15, 20, 33, 60))] + [(10, "Just four words here"), (11, "Solo"), (12, ""), (13, None), (14, "na na na na na na na na na")]
    rows = []
    for i in range(60):
        words = prose(2000 + i, 150).split()
        passage = items[i % 5][1].replace("\n", " ").split()
        for _ in range(i // 15):
            passage[draw.randrange(len(passage))] = "changed"
        words[40:40] = [w.upper() + "," if i % 2 else w for w in passage]
        rows.append((i, " ".join(words)))
    rows += [(100, items[4][1][:330]), (101, "x just FOUR words, here"), (102, "solo."), (103, "na " * 30), (104, ""), (105, None), (None, items[0][1]), (106, prose(5, 300))]
    docs, bench = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = held_items(rows, items)
    got = leaks.find_leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id): (round(r.similarity, 9), r.first_word) for r in got} == want
    hit = {k for k, _ in want}
    assert sorted(str(r.doc_id) for r in leaks.without_leaks(docs, bench).collect()) == sorted(str(k) for k, _ in rows if k not in hit)


def test_decontamination_in_blocks_and_edges(spark, monkeypatch):
    bench = spark.createDataFrame([(1, prose(2, 120)), (2, prose(3, 80)), (3, prose(4, 50))], "item_id bigint, text string")
    docs = edge_docs(spark)
    once = sorted(map(str, leaks.find_leaks(docs, bench).collect()))
    monkeypatch.setattr(leaks.item_blocks, "__defaults__", ("item_id", "text", 100))
    assert sorted(map(str, leaks.find_leaks(docs, bench).collect())) == once and len(once) == 5
    clean = leaks.without_leaks(docs, bench)
    assert clean.columns == docs.columns and clean.count() == len(edge_rows()) - 5
    none = bench.limit(0)
    assert leaks.find_leaks(docs, none).collect() == [] and leaks.without_leaks(docs, none).count() == len(edge_rows())
    assert leaks.find_leaks(empty_docs(spark), bench).collect() == [] and leaks.without_leaks(empty_docs(spark), bench).collect() == []


def test_radius_holds_similar_windows():
    """Windows at the threshold lie within the radius, and the multi-index finds all fingerprints within it."""
    draw = random.Random(9)
    rows = np.random.default_rng(3).integers(0, 256, (200, 8), dtype=np.uint8)
    index = leaks.multi_index(rows)
    for probe in rows[:50] ^ np.random.default_rng(4).integers(0, 256, (50, 8), dtype=np.uint8) & np.random.default_rng(5).integers(0, 256, (50, 8), dtype=np.uint8):
        apart = np.unpackbits(probe ^ rows, axis=1).sum(1)
        found = np.any([index[b][probe[b]] for b in range(8)], axis=0)
        assert found[apart <= leaks.RADIUS].all()
    missed = 0
    for _ in range(400):
        own = np.array([draw.getrandbits(64) for _ in range(draw.randrange(11, 60))], np.uint64)
        other = own.copy()
        for j in draw.sample(range(len(own)), len(own) // 9):
            other[j] = draw.getrandbits(64)
        prints = [leaks.fingerprints(leaks.bit_sums(x), np.zeros(1, np.int64), len(x)) for x in (own, other)]
        missed += np.unpackbits(prints[0] ^ prints[1]).sum() > leaks.RADIUS
    assert missed == 0


def test_node_ties_connect_what_alike_pairs_connect():
    draw = np.random.default_rng(8)
    for size in (2, 9, 60, 200):
        base = draw.integers(0, 256, (max(2, size // 12), near.SKETCH), np.uint8)
        sketches = base[draw.integers(0, len(base), size)].copy()
        change = draw.random(sketches.shape) < draw.choice([0.1, 0.3, 0.42], (size, 1))
        sketches[change] = draw.integers(0, 256, int(change.sum()), np.uint8)
        want = near.least_reached(near.alike(sketches, sketches))
        assert near.node_ties(sketches).tolist() == want.tolist()


def small_docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)


def ties_of(spark, texts, monkeypatch):
    found = []
    monkeypatch.setattr(near, "components", lambda edges: found.append([tuple(r) for r in edges.collect()]) or graph.components(edges))
    result = near.near_duplicates(small_docs(spark, texts), node_block=16).collect()
    return found[0], result


def test_pages_that_share_a_menu_are_no_cluster(spark, monkeypatch):
    """Texts that are alike to a third meet in nodes, and are told apart there."""
    menu = prose(1, 100).replace("\n", " ")
    texts = [menu + " " + prose(100 + i, 100).replace("\n", " ") for i in range(600)]
    sets = [set(zip(*(t.split()[i:] for i in range(5)))) for t in texts[:2]]
    assert 0.28 < len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < 0.38
    ties, result = ties_of(spark, texts, monkeypatch)
    assert ties == [] and all(r.n_links == 0 and r.class_id == r.doc_id for r in result)


def test_a_node_of_many_blocks(spark, monkeypatch):
    """Copies with small changes share most nodes; blocks of 16 sketches are compared in pairs."""
    words = prose(5, 300).split()
    draw = random.Random(6)
    texts = []
    for i in range(90):
        own = list(words)
        own[draw.randrange(300)] = f"x{i}"
        texts.append(" ".join(own))
    ties, result = ties_of(spark, texts, monkeypatch)
    assert len(ties) < 90 * 45 and all(r.class_id == 0 and r.n_links == 89 for r in result)


def test_recall_against_all_pairs(spark):
    """Links among the given documents and a copy of each with some words changed, about the threshold."""
    from pathlib import Path

    import pyarrow as pa
    path = Path("/root/testdata/sf0.01/documents.parquet")
    if not path.exists():
        pytest.skip("test tables are not here")
    draw, texts = random.Random(13), {r.text or "" for r in spark.read.parquet(str(path)).select("text").collect()}
    for text in sorted(texts):
        share = draw.uniform(0.002, 0.025)
        texts.add(re.sub(r"\S+", lambda m: f"w{draw.randrange(10**6)}" if draw.random() < share else m[0], text))
    texts = sorted(texts)
    docs = small_docs(spark, texts)
    hashes, offsets = near.shingles(pa.array(texts))
    sets = [np.unique(hashes[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
    held = [i for i, s in enumerate(sets) if len(s)]
    want = dict(zip((texts[i] for i in held), near.linked([sets[i] for i in held], 80).sum(1).tolist()))
    got = {r.text: r.n_links for r in near.near_duplicates(docs).join(docs.select("doc_id", "text"), "doc_id").collect()}
    found, all_links = sum(got[t] for t in want), sum(want.values())
    print(f"links found {found} of {all_links}, recall {found / all_links}")
    assert all_links > 1000 and found >= 0.9 * all_links and all(got[t] <= want[t] for t in want)
