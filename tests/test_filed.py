"""Changes of a table stored by source file touch their files only, and agree with the same change of a whole table."""

import os
from collections import Counter

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from vecframe.operators import filed, tables
from vecframe.operators.filed import FiledTable

SCHEMA = "key long, seq long, value double, source_file string"
FILES = ["alpha", "beta", "2024", None]


@pytest.fixture
def stored(spark, tmp_path):
    rows = [(i, 5, float(i), FILES[i % 4]) for i in range(200)]
    return FiledTable(spark, str(tmp_path / "table")).create(spark.createDataFrame(rows, SCHEMA))


def content(df):
    return Counter(tuple(r[c] for c in ("key", "seq", "value", "source_file")) for r in df.collect())


def on_disk(stored):
    """Name and time of every data file, by folder."""
    out = {}
    for folder, _, names in os.walk(stored.path):
        data = {(n, os.stat(f"{folder}/{n}").st_mtime_ns) for n in names if n.endswith(".parquet")}
        if data:
            out[os.path.basename(folder).split("=")[1]] = data
    return out


def changed(before, after):
    return {name for name in before.keys() | after.keys() if before.get(name) != after.get(name)}


def check(stored, before, wanted, touched):
    assert content(stored.read()) == content(wanted)
    assert changed(before, on_disk(stored)) == touched


def test_updates_rewrite_the_files_of_their_keys(spark, stored):
    changes = spark.createDataFrame([(4, 6, -1.0), (8, 6, -2.0), (8, 7, -3.0), (9999, 6, 0.0)], "key long, seq long, value double")
    before, whole = on_disk(stored), spark.createDataFrame(stored.read().collect(), SCHEMA)
    report = stored.update_rows(changes)
    check(stored, before, tables.update_rows(whole, changes)[0], {"alpha"})
    assert {(r.source_file, r.updated) for r in report.collect()} == {("alpha", 2), (None, 1)}


def test_deletes_rewrite_the_files_of_their_keys(spark, stored):
    ids = spark.createDataFrame([(1,), (2,), (2,), (12345,)], "key long")
    before, whole = on_disk(stored), spark.createDataFrame(stored.read().collect(), SCHEMA)
    report = stored.delete_ids(ids)
    check(stored, before, tables.delete_ids(whole, ids)[0], {"beta", "2024"})
    assert {(r.source_file, r.deleted) for r in report.collect()} == {("beta", 1), ("2024", 1)}


@pytest.mark.parametrize("name", ["beta", None])
def test_a_file_without_rows_is_gone(spark, stored, name):
    before, rows = on_disk(stored), stored.read()
    whole = spark.createDataFrame(rows.collect(), SCHEMA)
    stored.delete_ids(rows.where(F.col("source_file").eqNullSafe(F.lit(name))).select("key"))
    check(stored, before, whole.where(~F.col("source_file").eqNullSafe(F.lit(name))), {name or "__HIVE_DEFAULT_PARTITION__"})


def test_nothing_to_do_touches_nothing(spark, stored):
    before, rows = on_disk(stored), content(stored.read())
    stored.delete_ids(spark.createDataFrame([(-5,)], "key long"))
    stored.update_rows(spark.createDataFrame([], "key long, seq long, value double"))
    stored.upsert(spark.createDataFrame([(0, 1, 9.0, "alpha")], SCHEMA))  # older than the row held
    assert on_disk(stored) == before and content(stored.read()) == rows


def test_upsert_moves_a_key_between_files(spark, stored):
    rows = spark.createDataFrame([(0, 6, 1.5, "beta"), (1, 1, 2.5, "new"), (500, 1, 3.5, "new")], SCHEMA)
    before, whole = on_disk(stored), spark.createDataFrame(stored.read().collect(), SCHEMA)
    stored.upsert(rows)
    check(stored, before, tables.upsert(whole, rows), {"alpha", "beta", "new"})


def test_replacing_a_file(spark, stored):
    rows = spark.createDataFrame([(4, 9, 0.5), (1, 9, 1.5), (2, 1, 2.5), (700, 1, 3.5)], "key long, seq long, value double")
    before, whole = on_disk(stored), spark.createDataFrame(stored.read().collect(), SCHEMA)
    stored.replace_file("alpha", rows)
    check(stored, before, tables.replace_file(whole, "alpha", rows), {"alpha", "beta"})
    with pytest.raises(FileNotFoundError):
        stored.replace_file("absent", rows)


def test_deleting_a_file_leaves_the_rest(spark, stored):
    before, whole = on_disk(stored), spark.createDataFrame(stored.read().collect(), SCHEMA)
    stored.delete_file("2024")
    check(stored, before, tables.delete_file(whole, "2024"), {"2024"})
    for name, error in (("2024", FileNotFoundError), ("../x", ValueError)):
        with pytest.raises(error):
            stored.delete_file(name)


def test_a_change_scans_its_partitions_only(spark, stored):
    """The rewrite of one file reads that file's rows: the others are pruned by partition."""
    touched = spark.createDataFrame([("alpha",), (None,)], "source_file string")
    rows = stored._of_files(stored.read(), touched)
    assert "source_file" in plan_of(rows).split("PartitionFilters: [")[1].split("]")[0]
    assert {r.source_file for r in rows.collect()} == {"alpha", None}


@pytest.mark.parametrize("most", [0])
def test_very_many_files(spark, stored, monkeypatch, most):
    monkeypatch.setattr(filed, "MOST_NAMES", most)
    before, whole = on_disk(stored), spark.createDataFrame(stored.read().collect(), SCHEMA)
    ids = spark.createDataFrame([(1,), (3,)], "key long")
    stored.delete_ids(ids)
    check(stored, before, tables.delete_ids(whole, ids)[0], {"beta", "__HIVE_DEFAULT_PARTITION__"})


def test_listing_has_size_and_time(spark, stored):
    log = spark.createDataFrame([(1, 9, "upsert"), (2, 9, "delete"), (1, 10, "delete"), (3, 11, "upsert")], "key long, seq long, op string")
    listed = {r.name: r for r in stored.files(log).collect()}
    assert set(listed) == {*FILES, tables.LOG_NAME} and all(listed[f].vector_count == 50 for f in FILES)
    sizes = {name: sum(os.path.getsize(f"{stored.path}/source_file={name}/{n}") for n, _ in data) for name, data in on_disk(stored).items()}
    assert all(listed[f].size == sizes[f or "__HIVE_DEFAULT_PARTITION__"] and listed[f].modified for f in FILES)
    assert (listed[tables.LOG_NAME].vector_count, listed[tables.LOG_NAME].is_wal) == (1, True)


def test_files_are_loaded_once(spark, stored):
    files = lambda *rows: spark.createDataFrame(list(rows), "name string, size long")
    rows = spark.createDataFrame([(900, 1, 1.0, "gamma"), (901, 1, 1.0, "beta")], SCHEMA)
    actions = stored.append_files(rows, files(("alpha", 1), ("beta", 2)), files(("gamma", 3), ("beta", 2)))
    assert {(r.name, r.action) for r in actions.collect()} == {("gamma", "load"), ("beta", "skip")}
    keys = {r.key for r in stored.read().select("key").collect()}
    assert 900 in keys and 901 not in keys


def test_bad_names_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="may hold only"):
        FiledTable(spark, str(tmp_path / "bad")).create(spark.createDataFrame([(1, 1, 1.0, "a/b")], SCHEMA))
