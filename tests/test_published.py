"""Tables that are replaced together or not at all."""

import threading

import pytest
from pyspark.sql import functions as F

from tabkit.runtime import scratch_path
from tabkit.sources import published
from tabkit.sources.published import Outdated, Publication
from tabkit.sources.staging import stage


@pytest.fixture
def shop(spark):
    return Publication(spark, scratch_path(spark, "shop"))


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n int")


def content(snapshot):
    return {name: sorted(r[0] for r in snapshot.read(name).collect()) for name in snapshot.names()}


def folders(shop):
    fs, where = shop._fs(f"{shop.path}/data")
    return {s.getPath().getName() for s in fs.listStatus(where)} if fs.exists(where) else set()


def test_versions(spark, shop):
    assert shop.versions() == [] and shop.snapshot().names() == []
    assert shop.publish({"a": numbers(spark, 1), "b": numbers(spark, 2)}) == 1
    first = shop.snapshot()
    assert shop.publish({"b": numbers(spark, 3), "c": numbers(spark)}) == 2
    assert shop.publish({}, drop=["a", "unknown"]) == 3
    assert content(shop.snapshot()) == {"b": [3], "c": []}
    assert content(shop.snapshot(2)) == {"a": [1], "b": [3], "c": []}
    assert content(first) == {"a": [1], "b": [2]}
    with pytest.raises(KeyError):
        shop.snapshot(4)
    with pytest.raises(KeyError):
        shop.read("a")


def test_a_failure_between_two_outputs_changes_nothing(spark, shop):
    shop.publish({"a": numbers(spark, 1), "b": numbers(spark, 2)})
    before = folders(shop)
    broken = numbers(spark, 5).select(F.raise_error(F.lit("no")).cast("int").alias("n"))
    with pytest.raises(Exception, match="no"):
        shop.run_step(lambda t: ({"a": numbers(spark, 9), "b": broken}, {}), ["a"], ["a", "b"])
    assert shop.versions() == [1] and content(shop.snapshot()) == {"a": [1], "b": [2]} and folders(shop) == before


def test_a_failure_at_the_switch_changes_nothing(spark, shop, monkeypatch):
    shop.publish({"a": numbers(spark, 1)})
    before = folders(shop)

    def fails(version, entries):
        raise OSError("disk")

    monkeypatch.setattr(shop, "_switched", fails)
    with pytest.raises(OSError):
        shop.publish({"a": numbers(spark, 2)})
    assert content(shop.snapshot()) == {"a": [1]} and folders(shop) == before


def test_a_step_may_replace_what_it_reads(spark, shop):
    shop.publish({"a": numbers(spark, 1, 2), "old": numbers(spark, 0)})
    got = shop.run_step(lambda t: ({"a": t["a"].select((F.col("n") * 10).alias("n"))}, {"rows": t["a"].count()}), ["a"], ["a"], drop=["old"])
    assert got == {"rows": 2} and content(shop.snapshot()) == {"a": [10, 20]}
    with pytest.raises(ValueError):
        shop.run_step(lambda t: ({}, {}), ["a"], ["a"])


def test_two_writers(spark, shop):
    """Nobody's tables are lost, and a step on outdated tables is refused."""
    shop.publish({"a": numbers(spark, 0)})

    def step(tables):
        shop.publish({"b": numbers(spark, 7)})
        return {"a": numbers(spark, 1)}, {}

    with pytest.raises(Outdated):
        shop.run_step(step, ["a"], ["a"])
    assert content(shop.snapshot()) == {"a": [0], "b": [7]}
    frames = [numbers(spark, i) for i in range(6)]
    writers = [threading.Thread(target=shop.publish, args=({f"t{i}": frames[i]},)) for i in range(6)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert content(shop.snapshot()) == {"a": [0], "b": [7], **{f"t{i}": [i] for i in range(6)}}
    assert shop.versions() == list(range(1, 9))
    assert not shop._switched(8, {})  # a version is given once


def test_retention(spark, shop):
    shop.publish({"a": numbers(spark, 1), "b": numbers(spark, 1)})
    shop.publish({"a": numbers(spark, 2)})
    shop.publish({"a": numbers(spark, 3)})
    assert shop.retain(2) == [1] and shop.versions() == [2, 3]
    assert content(shop.snapshot(2)) == {"a": [2], "b": [1]} and len(folders(shop)) == 3
    assert shop.retain(1) == [2] and content(shop.snapshot()) == {"a": [3], "b": [1]} and len(folders(shop)) == 2
    assert shop.publish({"a": numbers(spark, 4)}) == 4
    with pytest.raises(ValueError):
        shop.retain(0)
    assert published.TRIES > 1


def test_a_staged_name_never_goes(spark):
    stage(numbers(spark, 1), "always_there")
    reader = spark.table("always_there")
    assert [r.n for r in stage(numbers(spark, 2), "always_there").collect()] == [2]
    assert [r.n for r in reader.collect()] == [1]  # bound to the folder it was resolved to
    assert stage(spark.createDataFrame([("x",)], "s string"), "always_there").columns == ["s"]
    spark.sql("DROP TABLE always_there")
