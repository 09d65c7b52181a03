import json
import os

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from vecframe.plans.corpus import validate_corpus
from vecframe.session import shared_dir
from vecframe.sources import matrices
from vecframe.sources.export import export
from vecframe.sources.files import check_files, file_listing, format_of, read_vectors, to_rows


def vectors_of(df):
    return {r.id: list(r.vector) for r in df.collect()}


@pytest.mark.parametrize("format,kind", [("fvecs", "<f4"), ("bvecs", "u1"), ("ivecs", "<i4"), ("fbin", "<f4"), ("u8bin", "u1"), ("i8bin", "i1"), ("npy", "<f8")])
def test_matrices_over_files_and_ranges(spark, tmp_path, monkeypatch, format, kind):
    monkeypatch.setattr(matrices, "RANGE_BYTES", 100)
    rows = np.arange(60).reshape(20, 3).astype(kind)
    for name, part in (("a", rows[:13]), ("b", rows[13:])):
        path = tmp_path / f"{name}.{format}"
        if format == "npy":
            np.save(path, part)
        elif format.endswith("vecs"):
            dims = np.full((len(part), 1), 3, dtype="<i4").view("u1").reshape(len(part), 4)
            np.hstack([dims, part.view("u1").reshape(len(part), -1)]).tofile(path)
        else:
            path.write_bytes(np.array(part.shape, dtype="<i4").tobytes() + part.tobytes())
    df = read_vectors(spark, str(tmp_path), format=format)
    assert vectors_of(df) == {i: list(map(float, row)) for i, row in enumerate(rows)}
    assert {r.source_file for r in df.collect()} == {f"a.{format}", f"b.{format}"}


def test_broken_matrices(spark, tmp_path):
    (tmp_path / "x.fbin").write_bytes(np.array([5, 3], dtype="<i4").tobytes() + b"\0" * 24)
    with pytest.raises(Exception, match="header says 5 rows"):
        read_vectors(spark, str(tmp_path / "x.fbin")).collect()
    (tmp_path / "y.fvecs").write_bytes(np.array([3], dtype="<i4").tobytes() + b"\0" * 11)
    with pytest.raises(Exception, match="whole rows"):
        read_vectors(spark, str(tmp_path / "y.fvecs")).collect()


def test_arrow_batches(spark, tmp_path):
    schema = pa.schema([("id", pa.int64()), ("vector", pa.list_(pa.float32(), 2)), ("tag", pa.string())])
    with pa.OSFile(str(tmp_path / "t.arrow"), "wb") as out, pa.ipc.new_file(out, schema) as writer:
        for at in range(0, 10, 4):
            ids = list(range(at, min(10, at + 4)))
            writer.write_batch(pa.RecordBatch.from_pydict({"id": ids, "vector": [[i, -i] for i in ids], "tag": ["x"] * len(ids)}, schema=schema))
    df = read_vectors(spark, str(tmp_path / "t.arrow"))
    assert vectors_of(df) == {i: [i, -i] for i in range(10)}
    assert dict(df.dtypes)["vector"] == "array<float>"


def test_csv_needs_a_schema_and_sound_vectors(spark, tmp_path):
    path = tmp_path / "v.csv"
    path.write_text('id,vector,note\n1,"[0.5, 2]","say ""hi"""\n2,,\n')
    df = read_vectors(spark, str(path), schema="id long, vector array<float>, note string")
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(1, [0.5, 2.0], 'say "hi"'), (2, None, None)]
    with pytest.raises(ValueError):
        read_vectors(spark, str(path))
    path.write_text("id,vector,note\n1,oops,x\n")
    with pytest.raises(Exception):
        read_vectors(spark, str(path), schema="id long, vector array<float>, note string").collect()


def test_formats_by_name():
    assert format_of("A.FEATHER") == "arrow" and format_of("x.json") == "json"
    for name in ("x.txt", "x", "x.h5", "x.safetensors"):
        with pytest.raises(ValueError):
            format_of(name)


def test_listing(spark, tmp_path):
    (tmp_path / "good.csv").write_text("x\n")
    listing = check_files(file_listing(spark, str(tmp_path)))
    assert [(r["name"], r["size"]) for r in listing.collect()] == [("good.csv", 2)]
    (tmp_path / "bad name.csv").write_text("x\n")
    with pytest.raises(ValueError, match="bad name"):
        check_files(file_listing(spark, str(tmp_path)))
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "none.csv").write_text("")
    with pytest.raises(ValueError, match="empty"):
        check_files(file_listing(spark, str(tmp_path / "d")))


def test_an_empty_file_among_others_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text('id,vector\n1,"[1]"\n')
    with pytest.raises(ValueError, match="empty"):
        read_vectors(spark, str(tmp_path), format="csv", schema="id long, vector array<float>")


def test_a_refused_export_leaves_no_parts(spark, tmp_path):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "id long, vector array<double>").coalesce(1)
    with pytest.raises(Exception, match="elements"):
        export(df, str(tmp_path / "out"))
    assert not list((tmp_path / "out").glob("*.parquet")) and not (tmp_path / "out/_manifest.json").exists()


def test_four_ways_in(spark):
    frame = pd.DataFrame({"key": ["a"], "vector": [[1.0, 2.0]]})
    inline = [{"id": "a", "vector": [1, 2], "metadata": {"color": "red", "n": 3}}]
    assert to_rows(spark, vectors=inline).first().asDict() == {"key": "a", "vector": [1.0, 2.0], "metadata": {"color": "red", "n": "3"}}
    assert to_rows(spark, dataframe=frame).first().vector == [1.0, 2.0]
    assert to_rows(spark, table=pa.Table.from_pandas(frame)).first().key == "a"
    for bad in ({}, {"vectors": inline, "dataframe": frame}, {"vectors": []}, {"vectors": [{"vector": [1]}]}, {"vectors": [{"id": 1}]}):
        with pytest.raises(ValueError):
            to_rows(spark, **bad)


def test_export(spark, tmp_path):
    df = spark.createDataFrame([(i, [float(i), 1.0], i * 2) for i in range(10)], "id long, vector array<double>, seq long").repartition(3)
    path = str(tmp_path / "out")
    manifest = export(df, path, seq="seq", dimension=2)
    assert manifest["vector_count"] == 10 and manifest["snapshot_high_water_seq"] == 18 and manifest["input_dim"] == 2
    stored = json.load(open(f"{path}/_manifest.json"))
    assert stored == manifest
    assert sum(p["rows"] for p in stored["parts"]) == 10
    assert all(os.path.getsize(f"{path}/{p['filename']}") == p["bytes"] for p in stored["parts"])
    assert spark.read.parquet(path).count() == 10 and dict(spark.read.parquet(path).dtypes)["vector"] == "array<float>"
    with pytest.raises(Exception, match="already exists"):
        export(df, path)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_corpus_checks(spark):
    row = ("film-00000", "t", 1940, "g", "p" * 50, [1.0])
    df = spark.createDataFrame([row, ("film-00001", "t", 1990, "g", "p" * 1001, [1.0, 2.0])], "id string, title string, year int, genre string, plot string, vector array<float>")
    got = validate_corpus(df, dimension=2, rows=(1, 5)).first().asDict()
    assert got == {"wrong_columns": 0, "row_count_outside": 0, "wrong_dimension": 1, "too_short": 1, "too_long": 1, "no_early_year": 0, "no_late_year": 1}
