"""Renaming columns of stored files touches the files that have them."""

import os

import pytest
from pyspark.sql import functions as F

from vecframe.operators import remap
from vecframe.sources import storage


def on_disk(folder):
    return {(n, os.stat(f"{folder}/{n}").st_mtime_ns) for n in os.listdir(folder) if n.endswith(".parquet")}


@pytest.fixture
def mixed(spark, tmp_path):
    """Two files with the old names, one that has the new key already, one without either."""
    path = str(tmp_path / "table")
    for i, schema in enumerate(["a long, v array<double>", "a long, v array<double>", "b long, v array<double>", "other long"]):
        row = (i,) if schema == "other long" else (i, [float(i)])
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(path)
    return path


def content(spark, path, key="b"):
    return sorted((r[key], r.v) for r in spark.read.option("mergeSchema", "true").parquet(path).select(key, "v").collect() if r[key] is not None)


def test_only_files_with_the_old_name_are_written(spark, mixed):
    before = on_disk(mixed)
    refused = remap.remap_files(spark, mixed, current=("a", "v"), id_field="b")
    assert not refused["success"] and "2 source files" in refused["error"] and on_disk(mixed) == before
    assert remap.remap_files(spark, mixed, current=("a", "v"), id_field="b", reprocess=True) == {"success": True, "files_rewritten": 2}
    assert content(spark, mixed) == [(0, [0.0]), (1, [1.0]), (2, [2.0])]
    assert len(before & on_disk(mixed)) == 2 and "a" not in spark.read.option("mergeSchema", "true").parquet(mixed).columns
    again = remap.remap_files(spark, mixed, current=("a", "v"), id_field="b", reprocess=True)
    assert again["files_rewritten"] == 0 and "no file" in again["warning"]


def test_both_roles_at_once(spark, mixed):
    assert remap.remap_files(spark, mixed, current=("a", "v"), id_field="b", vector_field="w", reprocess=True)["files_rewritten"] == 3
    rows = spark.read.option("mergeSchema", "true").parquet(mixed).where("b is not null").select("b", "w").collect()
    assert sorted((r.b, r.w) for r in rows) == [(0, [0.0]), (1, [1.0]), (2, [2.0])]


def test_nothing_to_do(spark, mixed):
    before = on_disk(mixed)
    assert "no-op" in remap.remap_files(spark, mixed, current=("a", "v"), id_field="a")["warning"]
    assert "no file" in remap.remap_files(spark, mixed, current=("x", "y"), id_field="z", reprocess=True)["warning"]
    with pytest.raises(ValueError):
        remap.remap_files(spark, mixed, current=("a", "v"))
    assert on_disk(mixed) == before


def test_an_exchange_cut_off_is_ended(spark, mixed, monkeypatch):
    calls = []
    plain = storage.remove

    def fail(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("lost")
        plain(*args)

    monkeypatch.setattr(storage, "remove", fail)
    with pytest.raises(OSError, match="lost"):
        remap.remap_files(spark, mixed, current=("a", "v"), id_field="b", reprocess=True)
    monkeypatch.setattr(storage, "remove", plain)
    remap.finish(spark, mixed)
    assert content(spark, mixed) == [(0, [0.0]), (1, [1.0]), (2, [2.0])]
    assert not [n for n in os.listdir(mixed) if n.startswith("_remap")]


def test_two_values_for_one_name_are_refused(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.createDataFrame([(1, 2)], "a long, b long").write.parquet(path)
    with pytest.raises(ValueError, match="both"):
        remap.remap_files(spark, path, current=("a", "v"), id_field="b", reprocess=True)
    kept = spark.read.parquet(path).select(F.sum("a"), F.sum("b")).first()
    assert tuple(kept) == (1, 2)
