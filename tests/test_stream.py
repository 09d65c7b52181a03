import os

import pytest
from conftest import plan_of

from vecframe.streaming.apply import StreamedTable

LOG = "key int, seq int, op string, value double"
OPS = [(1, 1, "upsert", 1.0), (2, 2, "upsert", 2.0), (1, 5, "delete", None), (3, 4, "upsert", 3.0), (2, 6, "upsert", 2.5), (1, 3, "upsert", 9.0)]


def content(df):
    return {r.key: (r.seq, r.value) for r in df.collect()}


def write(spark, folder, rows, name):
    spark.createDataFrame(rows, LOG).coalesce(1).write.parquet(f"{folder}/{name}")


def stream(spark, folder):
    return spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def test_stream_restart_and_fold(spark, tmp_path):
    source, target = str(tmp_path / "in"), StreamedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        target.read()
    for i, op in enumerate(OPS[:4]):
        write(spark, source, [op], f"{i}")
    target.start(stream(spark, source)).awaitTermination()
    assert content(target.read()) == {2: (2, 2.0), 3: (4, 3.0)}
    assert target.pending().first().vector_count == 2
    assert target.fold() == 1 and target.fold() is None
    assert target.pending().first().vector_count == 0
    # A new start reads only what came since; the late write of key 1 is older than its delete.
    for i, op in enumerate(OPS[4:], 4):
        write(spark, source, [op], f"{i}")
    target.start(stream(spark, source)).awaitTermination()
    assert content(target.read()) == {2: (6, 2.5), 3: (4, 3.0)}
    assert target.fold() == 2
    assert content(target.read()) == {2: (6, 2.5), 3: (4, 3.0)}


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    table = StreamedTable(spark, str(tmp_path / "t"))
    batch = spark.createDataFrame(OPS, LOG)
    table.append(batch, 0)
    before = content(table.read())
    table.append(batch, 0)
    assert content(table.read()) == before and table.log().count() == len(OPS)


def test_a_fold_does_not_move_the_base(spark, tmp_path):
    """Base and log are bucketed alike and merged in place: no exchange in the merge or its write."""
    table = StreamedTable(spark, str(tmp_path / "t"), buckets=8)
    table.append(spark.createDataFrame([(i, i, "upsert", float(i)) for i in range(500)], LOG), 0)
    table.fold()
    table.append(spark.createDataFrame([(i, 1000 + i, "delete" if i % 3 == 0 else "upsert", -1.0) for i in range(0, 700, 5)], LOG), 1)
    plan = plan_of(table.read())
    assert "Exchange" not in plan and plan.count("SelectedBucketsCount: 8 out of 8") == 2
    before = content(table.read())
    assert table.fold() == 2 and content(table.read()) == before
    folder = f"{tmp_path}/t/base/{table.base._latest()['folder']}"
    assert sum(n.endswith(".parquet") for n in os.listdir(folder)) <= 8


def test_compaction_removes_what_was_folded(spark, tmp_path):
    table = StreamedTable(spark, str(tmp_path / "t"), buckets=4)
    for i, op in enumerate(OPS):
        table.append(spark.createDataFrame([op], LOG), i)
        if i in (1, 3):
            table.fold()
    before = content(table.read())
    assert table.compact() == {"batches": 4, "versions": 1}
    assert table.batches() == [4, 5] and table.base.versions() == [2] and content(table.read()) == before
    table.append(spark.createDataFrame([(9, 9, "upsert", 9.0)], LOG), 2)  # a replay of a folded batch
    assert content(table.read()) == before
    assert table.fold() == 3 and content(table.read()) == before
    assert table.compact() == {"batches": 3, "versions": 1} and table.compact() == {"batches": 0, "versions": 0}


def test_a_batch_cut_short_is_not_read(spark, tmp_path):
    table = StreamedTable(spark, str(tmp_path / "t"))
    table.append(spark.createDataFrame(OPS, LOG), 0)
    table.append(spark.createDataFrame([(7, 7, "upsert", 7.0)], LOG), 1)
    os.remove(tmp_path / "t/log/batch_id=1/_SUCCESS")
    assert 7 not in content(table.read()) and table.batches() == [0]


def test_new_columns_of_the_log(spark, tmp_path):
    table = StreamedTable(spark, str(tmp_path / "t"))
    table.append(spark.createDataFrame(OPS, LOG), 0)
    table.fold()
    table.append(spark.createDataFrame([(3, 9, "upsert", 4.0, "x")], LOG + ", note string"), 1)
    rows = {r.key: (r.value, r.note) for r in table.read().collect()}
    assert rows == {2: (2.5, None), 3: (4.0, "x")}
