"""Records that cannot be read are kept as they stand."""

import pytest
from pyspark.sql import types as T

from tabkit.sources.rescue import RAW, read_mixed_rescued, read_rescued

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("price", T.DoubleType()), T.StructField("day", T.DateType())])

FILES = {
    "csv": ("id,name,price,day\n1,a,2.5,2024-01-01\nx,b,1,2024-01-01\n3,\"c,d\",NaN,\n4,e\n5,f,1,2024-01-01,more\n\n6,g,1.5.5,2024-01-01\n7,h,1,2024-13-01\n",
            [(1, "a", 2.5), (3, "c,d", None)], ["x,b,1,2024-01-01", "4,e", "5,f,1,2024-01-01,more", "6,g,1.5.5,2024-01-01", "7,h,1,2024-13-01"]),
    "json": ('{"id":1,"name":"a","price":2.5}\n{"id":"x","name":"b"}\n{"id":3,\n{"id":4,"other":9}\n\n[1\n{"id":99999999999}\n',
             [(1, "a", 2.5), (4, None, None)], ['{"id":"x","name":"b"}', '{"id":3,', "[1", '{"id":99999999999}']),
    "xml": ("<root><row><id>1</id><name>a</name><price>2.5</price></row><row><id>x</id><name>b</name></row><row><id>4</id></row></root>",
            [(1, "a", 2.5), (4, None, None)], ["<id>x</id>"]),
}
OPTIONS = {"csv": {"header": True}, "json": {}, "xml": {"rowTag": "row"}}


def written(tmp_path, fmt):
    folder = tmp_path / fmt
    folder.mkdir()
    (folder / f"data.{fmt}").write_text(FILES[fmt][0])
    return str(folder)


@pytest.mark.parametrize("fmt", FILES)
def test_both_sides(spark, tmp_path, fmt):
    _, good, bad = FILES[fmt]
    got = read_rescued(spark, written(tmp_path, fmt), fmt, SCHEMA, **OPTIONS[fmt])
    assert got.good.columns == SCHEMA.fieldNames()
    assert sorted(tuple(r)[:3] for r in got.good.collect()) == good
    rows = got.bad.collect()
    assert all(r.file.endswith(f"data.{fmt}") for r in rows)
    if fmt == "xml":
        assert len(rows) == 1 and bad[0] in rows[0].raw
    else:
        assert sorted(r.raw for r in rows) == sorted(bad)


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_columns_in_use_do_not_decide(spark, tmp_path, fmt):
    got = read_rescued(spark, written(tmp_path, fmt), fmt, SCHEMA, **OPTIONS[fmt])
    assert got.good.count() == got.good.select("name").count() == got.good.select("id").count() == len(FILES[fmt][1])
    assert got.bad.select("raw").count() == got.bad.count() == len(FILES[fmt][2])


def test_mixed(spark, tmp_path):
    good, bad = read_mixed_rescued(spark, {fmt: written(tmp_path, fmt) for fmt in FILES}, SCHEMA)
    assert sorted((r.source_rank, r.id) for r in good.collect()) == [(0, 1), (0, 3), (1, 1), (1, 4), (2, 1), (2, 4)]
    assert [bad.where(f"source_rank = {i}").count() for i in range(3)] == [5, 4, 1]


def test_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        read_rescued(spark, str(tmp_path), "parquet", SCHEMA)
    with pytest.raises(ValueError):
        read_rescued(spark, str(tmp_path), "csv", T.StructType([T.StructField(RAW, T.StringType())]))
