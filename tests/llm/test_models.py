"""Quality and toxicity: exact sums of the field, held-out accuracy, and the cases."""

import zlib
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from tabkit.llm import quality, queries, toxicity
from tests.llm.frames import edge_docs, edge_rows, empty_docs, labels, prose


def test_forward_backward_is_exact():
    draw = np.random.default_rng(1)
    field = quality.Field(draw.normal(size=4), draw.normal(size=(2, 2)))
    numbers, of = draw.normal(size=(9, 4)), np.array([0, 3, 3, 8, 9])
    chance, joint, logs = quality.forward_backward(field, numbers, of)
    pair = 0
    for a, b, log in zip(of[:-1], of[1:], logs):
        n, total, good, pairs = b - a, 0.0, np.zeros(b - a), np.zeros((max(b - a - 1, 0), 2, 2))
        for path in product((0, 1), repeat=n):
            weight = np.exp(sum(numbers[a + i] @ field.weights for i in range(n) if path[i]) + sum(field.pairs[x, y] for x, y in zip(path, path[1:])))
            total += weight
            good += weight * np.array(path)
            for i in range(n - 1):
                pairs[i, path[i], path[i + 1]] += weight
        if n:
            assert np.allclose(chance[a:b], good / total) and np.isclose(log, np.log(total)) and np.allclose(joint[pair:pair + n - 1], pairs / total)
            pair += n - 1


def test_noisy_or():
    model = toxicity.Model(np.sort(toxicity.word_features(pa.array(["nasty"]))[0][0]), np.array([9.0]), -6.0)
    texts = ["A nasty word. A good one! Nasty nasty again", "Nothing here.\nNor here", "", None, "é nasty."]
    scores, spans = toxicity.score_texts(model, pa.array(texts))
    low, high = 1 / (1 + np.exp(6)), 1 / (1 + np.exp(-3))
    assert np.allclose(scores, [1 - (1 - high) ** 2 * (1 - low), 1 - (1 - low) ** 2, 0, 0, high])
    assert [texts[0][s["start"]:s["end"]].strip() for s in spans[0]] == ["A nasty word.", "Nasty nasty again"]
    assert [texts[4][s["start"]:s["end"]] for s in spans[4]] == [texts[4]]


@pytest.mark.parametrize("name, label, least, fold", [("op7_quality_classifier", "quality", 0.97, lambda i: zlib.crc32(str(i).encode()) % 4 == 2),
                                                      ("op5_toxicity", "toxic", 0.9, lambda i: zlib.crc32(str(i).encode()) % 5 == 0)])
def test_held_out_accuracy(spark, small, name, label, least, fold):
    folder = small.replace("sf0.001", "sf0.01")
    rows = queries.QUERIES[name](spark, folder).collect()
    known = {r.doc_id: r[label] for r in queries.labels(spark, folder).collect()}
    assert len({r.doc_id for r in rows}) == len(rows) == queries.documents(spark, folder).count()
    assert all(0 <= r.score <= 1 and r.held_out == fold(r.doc_id) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in known]
    assert np.mean([r.predicted == known[r.doc_id] for r in held]) >= least


def test_held_out_labels_are_never_learnt(spark):
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2][:40]
    docs = edge_docs(spark, [(i, prose(i, 60), "en", "a", 0) for i in range(100)] + [(i, "# $$ ## " * 30, "en", "a", 0) for i in range(100, 400)])
    known = [(i, 1 if i < 100 else 0, 0) for i in range(400)]
    wrong = [(i, 1 - q if i in held else q, t) for i, q, t in known]
    one, two = (quality.score_quality(docs, labels(spark, x)).collect() for x in (known, wrong))
    assert sorted(map(str, one)) == sorted(map(str, two))
    assert all(r.predicted == (r.doc_id < 100) for r in one)


def test_edges(spark):
    docs, rows = edge_docs(spark), edge_rows()
    marks = labels(spark, [(5, 1, 0), (6, 1, 0), (9, 0, 1), (9, 1, 0), (10, None, None), (None, 1, 1), (11, 0, 1)])
    for known in (marks, labels(spark)):
        got = quality.score_quality(docs, known)
        assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == len(rows)
        assert all(r.score == 0 for r in got.where("doc_id IN (1, 2, 3)").collect())
        kept = quality.keep_good(docs, known)
        assert kept.columns == docs.columns and kept.where("doc_id IN (1, 2, 3)").count() == 0
        got = toxicity.score_toxicity(docs, known)
        assert got.count() == len(rows) and all(r.score == 0 for r in got.where("doc_id IN (1, 2, 3)").collect())
        for f in (quality.score_quality, quality.keep_good, toxicity.score_toxicity):
            assert f(empty_docs(spark), known).collect() == []


def test_a_toxic_document_names_sentences():
    """Many sentences that are unlikely alone: the likeliest half of the exponent is named."""
    bias = float(np.log(0.12 / 0.88))
    model = toxicity.Model(np.zeros(0, np.uint64), np.zeros(0), bias)
    scores, spans = toxicity.score_texts(model, pa.array(["one two three. " * 9, "one two three.", "", None]))
    assert abs(scores[0] - (1 - 0.88 ** 9)) < 1e-9 and [len(s) for s in spans] == [5, 0, 0, 0]
    assert [s["start"] for s in spans[0]] == [0, 15, 30, 45, 60]
