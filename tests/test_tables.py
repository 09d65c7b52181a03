import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from vecframe.operators import tables

BASE = "key int, seq int, value double, source_file string"
LOG = "key int, seq int, op string, value double"


def content(df):
    return {r.key: (r.seq, r.value) for r in df.collect()}


def replay(base, log, upto=None):
    """Operations applied one by one in order of their sequence."""
    rows = [(seq, "upsert", key, value) for key, seq, value, _ in base] + [(seq, op, key, value) for key, seq, op, value in log]
    state = {}
    for seq, op, key, value in sorted(rows):
        if upto is not None and seq > upto:
            continue
        if op == "delete":
            state.pop(key, None)
        else:
            state[key] = (seq, value)
    return state


@pytest.mark.parametrize("seed", range(6))
def test_merge_equals_replay(spark, seed):
    rng = random.Random(seed)
    stamps = list(range(200))
    rng.shuffle(stamps)
    base = [(key, stamps.pop(), rng.random(), "f") for key in range(20)]
    log = [
        (7 if rng.random() < 0.4 else rng.randrange(30), stamps.pop(), rng.choice(["upsert", "upsert", "delete"]), rng.random())
        for _ in range(120)
    ]
    base_df, log_df = spark.createDataFrame(base, BASE), spark.createDataFrame(log, LOG)
    assert content(tables.merge_on_read(base_df, log_df, op="op")) == replay(base, log)
    assert content(tables.snapshot_at(base_df, log_df, 90, op="op")) == replay(base, log, 90)
    # Folding half of the log with its deletes marked, then the rest, comes to the same.
    half = log_df.where("seq % 2 = 0")
    folded = tables.merge_on_read(base_df, half, op="op", keep_deletes=True)
    done = tables.merge_on_read(folded, log_df.where("seq % 2 = 1"), op="op", keep_deletes=True)
    assert content(done.where("op is null or op <> 'delete'")) == replay(base, log)
    assert tables.log_net_count(log_df).first().vector_count == len(replay([], log))


@pytest.fixture
def base(spark):
    return spark.createDataFrame([(1, 0, 1.0, "a"), (2, 0, 2.0, "a"), (3, 0, 3.0, "b"), (4, 0, 4.0, None)], BASE)


def test_upsert_twice_is_upsert_once(spark, base):
    changes = spark.createDataFrame([(2, 5, 9.0, "c"), (9, 6, 9.5, "c"), (2, 4, 0.0, "c")], BASE)
    once = tables.upsert(base, changes)
    assert content(once) == {1: (0, 1.0), 2: (5, 9.0), 3: (0, 3.0), 4: (0, 4.0), 9: (6, 9.5)}
    assert content(tables.upsert(once, changes)) == content(once)
    with pytest.raises(ValueError):
        tables.upsert(base, changes.drop("key"))


def test_update_touches_known_keys_only(spark, base):
    changes = spark.createDataFrame([(1, 5, 10.0, "x"), (3, 5, 30.0, "x"), (8, 5, 80.0, "x")], BASE)
    table, report = tables.update_rows(base, changes)
    assert content(table) == {1: (5, 10.0), 2: (0, 2.0), 3: (5, 30.0), 4: (0, 4.0)}
    assert {r.key: r.source_file for r in table.collect()}[1] == "a"
    assert {r.source_file: r.updated for r in report.collect()} == {"a": 1, "b": 1, None: 1}


def test_delete_by_key(spark, base):
    ids = spark.createDataFrame([(1,), (1,), (3,), (77,)], "key int")
    table, report = tables.delete_ids(base, ids)
    assert set(content(table)) == {2, 4}
    assert {r.source_file: r.deleted for r in report.collect()} == {"a": 1, "b": 1}


def test_delete_and_replace_file(spark, base):
    assert set(content(tables.delete_file(base, "a"))) == {3, 4}
    rows = spark.createDataFrame([(20, 1, 5.0)], "key int, seq int, value double")
    assert set(content(tables.replace_file(base, "a", rows))) == {3, 4, 20}
    for change in (lambda n: tables.delete_file(base, n), lambda n: tables.replace_file(base, n, rows)):
        with pytest.raises(FileNotFoundError):
            change("zz")
        with pytest.raises(ValueError):
            change("no/slash")


def test_file_actions_and_append(spark, base):
    loaded = spark.createDataFrame([("a", 10), ("b", 20)], "name string, size long")
    incoming = spark.createDataFrame([("a", 10), ("b", 21), ("c", 5)], "name string, size long")
    actions = tables.file_actions(loaded, incoming)
    assert {r["name"]: r.action for r in actions.collect()} == {"a": "skip", "b": "conflict", "c": "load"}
    rows = spark.createDataFrame([(50, 1, 0.0, "a"), (51, 1, 0.0, "b"), (52, 1, 0.0, "c")], BASE)
    assert set(content(tables.append_new_files(base, rows, actions))) == {1, 2, 3, 4, 52}


def test_fetch_with_missing_key(spark, base):
    keys = spark.createDataFrame([(2,), (99,)], "key int")
    assert {r.key: (r.found, r.value) for r in tables.fetch(base, keys).collect()} == {2: (True, 2.0), 99: (False, None)}


def test_large_key_sets_are_not_broadcast(spark, base):
    assert "BroadcastExchange" in plan_of(base.join(tables.travelling(base.select("key")), "key", "left_anti"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = base.join(tables.travelling(base.select("key"), limit=10), "key", "left_anti")
        assert "BroadcastExchange" not in plan_of(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_newest_drops_rows_before_the_shuffle(spark):
    log = spark.range(1000).select((F.col("id") % 3).alias("key"), F.col("id").alias("seq"))
    plan = plan_of(tables.newest(log))
    assert plan.count("WindowGroupLimit") == 2
    assert {r.key: r.seq for r in tables.newest(log).collect()} == {0: 999, 1: 997, 2: 998}


def test_stats_of_an_empty_collection(spark):
    empty = spark.createDataFrame([], "key int, vector array<float>")
    row = tables.collection_stats({"none": empty}).first()
    assert (row["name"], row.vector_count, row.dimension, row.vector_bytes) == ("none", 0, None, 0)


def test_versions(spark, base, tmp_path):
    table = tables.VersionedTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.write(base) == 1
    assert table.write(table.read().where("key > 1"), high_water=4) == 2
    assert set(content(table.read())) == {2, 3, 4}
    assert table.current() == {"version": 2, "high_water": 4}


def test_keys_stay_unique_across_files(spark):
    schema = "key long, seq long, source_file string, value string"
    base = spark.createDataFrame([(1, 0, "a", "x"), (2, 0, "b", "y")], schema)
    rows = spark.createDataFrame([(2, 1, "c", "new"), (3, 0, "c", "z"), (1, 5, "d", "skipped")], schema)
    actions = spark.createDataFrame([("c", 1, "load"), ("d", 1, "skip")], "name string, size long, action string")
    grown = tables.append_new_files(base, rows, actions)
    assert sorted((r.key, r.value) for r in grown.collect()) == [(1, "x"), (2, "new"), (3, "z")]
    swapped = tables.replace_file(base, "a", spark.createDataFrame([(2, 1, "n"), (4, 0, "m")], "key long, seq long, value string"))
    assert sorted((r.key, r.source_file, r.value) for r in swapped.collect()) == [(2, "a", "n"), (4, "a", "m")]


def test_a_key_asked_twice_is_answered_twice(spark):
    table = spark.createDataFrame([(1, "x")], "key long, value string")
    asked = spark.createDataFrame([(1,), (1,), (2,)], "key long")
    assert sorted((r.key, r.found, r.value or "") for r in tables.fetch(table, asked).collect()) == [(1, True, "x"), (1, True, "x"), (2, False, "")]


def test_the_log_is_evaluated_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    base = spark.createDataFrame([(i, 0, "b") for i in range(10)], "key long, seq long, value string")
    log = spark.createDataFrame([(i, 1, "l") for i in range(5)], "key long, seq long, value string").mapInArrow(count, "key long, seq long, value string")
    assert tables.merge_on_read(base, log).count() == 10 and seen.value == 5
