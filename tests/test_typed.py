"""Metadata in its own types."""

import pytest
from pyspark.sql import functions as F

from vecframe.operators import knn
from vecframe.sources.typed import mirrored, typed_rows, value, where_metadata, with_typed_metadata

ROWS = [
    {"id": 1, "vector": [1, 0], "metadata": {"n": 3, "ok": True, "name": "x", "deep": {"a": [1]}, "none": None}},
    {"id": "b", "vector": [0.9, 0.1], "metadata": {"n": "3", "ok": 1, "name": "true"}},
    {"id": "c", "vector": [0, 1], "metadata": {"n": 3.0, "ok": False, "id": "own"}},
    {"id": 'd"}', "vector": [0, 2]},
    {"id": "e", "vector": [0, 3], "metadata": {"n": 3.5, "big": 9007199254740993, "with space": "y"}},
]


@pytest.fixture(scope="module")
def rows(spark):
    return typed_rows(spark, ROWS).persist()


@pytest.mark.parametrize("wanted,keys", [
    ({"n": 3}, "1c"), ({"n": 3.0}, "1c"), ({"n": "3"}, "b"), ({"n": 3.5}, "e"), ({"ok": True}, "1"), ({"ok": 1}, "b"), ({"ok": False}, "c"),
    ({"name": "true"}, "b"), ({"name": True}, ""), ({"none": None, "n": 3}, "1c"), ({"name": None}, "cde"), ({"big": 9007199254740993}, "e"),
    ({"big": 9007199254740992}, ""), ({"with space": "y"}, "e"), ({"deep": "x"}, ""), ({"n": 3, "ok": True}, "1"), ({"id": "own"}, "c"), ({}, "1bcde"),
])
def test_filters_compare_value_and_type(rows, wanted, keys):
    assert sorted(r.key[0] for r in where_metadata(rows, wanted).select("key").collect()) == sorted(keys)


def test_keys_are_mirrored(spark, rows):
    got = {r.key: r.id for r in rows.select("key", value("id", "string").alias("id")).collect()}
    assert got == {"1": "1", "b": "b", "c": "own", 'd"}': 'd"}', "e": "e"}
    none = spark.createDataFrame([("k", None)], "key string, text string").select("key", F.parse_json("text").alias("metadata"))
    assert mirrored(none).select(F.to_json("metadata")).first()[0] == '{"id":"k"}'
    assert mirrored(mirrored(none)).select(F.to_json("metadata")).first()[0] == '{"id":"k"}'


def test_stored_and_searched(spark, rows, tmp_path):
    rows.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    asked = spark.createDataFrame([(0, [0.0, 1.0])], "query_id int, vector array<float>")
    hits = knn.knn_join(where_metadata(stored, {"n": 3}), asked, metadata=["metadata"])
    assert [(r.key, r.n) for r in hits.orderBy("rank").select("key", value("n", "int").alias("n")).collect()] == [("c", 3), ("1", 3)]


def test_columns_become_metadata(spark):
    df = spark.createDataFrame([("a", 1, True, None)], "key string, n int, ok boolean, t string")
    typed = with_typed_metadata(df, ["n", "ok", "t"])
    assert typed.columns == ["key", "metadata"] and where_metadata(typed, {"n": 1, "ok": True, "t": None}).count() == 1


def test_bad_input(spark, rows):
    for bad in ([], [{"id": 1}], [{"vector": [1]}], [{"id": 1, "vector": [1], "metadata": {"x": float("nan")}}]):
        with pytest.raises(ValueError):
            typed_rows(spark, bad)
    for bad in ({"n": [1]}, {'a"b': 1}, {"n": float("inf")}):
        with pytest.raises(ValueError):
            where_metadata(rows, bad)
