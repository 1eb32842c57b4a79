"""The pipeline's stages on the smallest tables and on the cases."""

import corpus_pipeline
import pytest

from tabkit.llm import leaks, near, quality, queries
from tabkit.runtime import settle
from tests.llm.frames import edge_docs, empty_docs
from tests.llm.test_copies import classes_of, held_items


@pytest.fixture(scope="module")
def stored(spark, small):
    out = [queries.documents(spark, small)]
    for name, stage in corpus_pipeline.STAGES:
        out.append(settle(stage(spark, out[-1], small), name))
    return out


def test_each_stage_decides(spark, small, stored):
    docs, good, lined, single, clean, pieces = stored
    assert all(x.columns == docs.columns for x in stored[:-1])
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    scores = quality.score_quality(docs, queries.labels(spark, small))
    assert ids(good) == ids(scores.where("predicted = 1"))
    assert ids(lined) <= ids(good) and lined.where("length(text) <> n_chars").count() == 0
    rows = [tuple(r) for r in lined.select("doc_id", "text").collect()]
    assert ids(single) == {key[1] for key in classes_of(rows)[0]}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    held = {k for k, _ in held_items([tuple(r) for r in single.select("doc_id", "text").collect()], items)}
    assert ids(clean) == ids(single) - held
    assert ids(pieces) == ids(clean) and pieces.columns == ["doc_id", "n_pieces", "pieces"]


def test_run_is_the_stages(spark, small, stored):
    assert sorted(map(str, corpus_pipeline.run(spark, small).collect())) == sorted(map(str, stored[-1].collect()))


@pytest.mark.parametrize("make", [edge_docs, empty_docs])
def test_cases(spark, small, make):
    docs = make(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = settle(stage(spark, docs, small), name)
        assert name == "sentence_pieces" or out.columns == docs.columns
        docs = out


def test_operators_agree_with_stages(spark, small):
    docs = queries.documents(spark, small)
    kept = near.near_duplicates(docs).where("kept")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in near.one_of_each(docs).collect())
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    hit = {r.doc_id for r in leaks.find_leaks(docs, items).collect()}
    assert {r.doc_id for r in leaks.without_leaks(docs, items).collect()} == {r.doc_id for r in docs.collect()} - hit
