import pytest
from pyspark.sql import functions as F

from vecframe.operators import schema
from vecframe.operators.vectors import coerce_vectors, l2_normalize, pair_score, vector_mean


def test_profile_prefers_unique_ids_and_long_float_arrays(spark):
    df = spark.createDataFrame(
        [("x", 5, [1, 2, 3, 4], [0.1, 0.2], "a"), ("x", 6, [1, 2, 3, 4], [0.3, 0.4], "b")],
        "group_id string, item int, codes array<int>, emb array<double>, name string",
    )
    row = schema.profile_schema(df).first()
    assert (row.state, row.id_field, row.vector_field, row.dimension, row.samples_analyzed) == ("detected", "item", "emb", 2, 2)


def test_profile_without_candidates(spark):
    df = spark.createDataFrame([("x", [0.1]), ("x", [0.2, 0.3])], "id string, v array<double>")
    row = schema.profile_schema(df).first()
    assert (row.state, row.id_field, row.vector_field, row.dimension) == ("analyzing", None, None, None)


def test_confirm(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0], "m")], "pid string, emb array<double>, tag string")
    confirmed = schema.confirm_schema(df, id_field="pid", vector_field="emb", dimension=2)
    assert confirmed.dtypes == [("key", "string"), ("vector", "array<float>"), ("tag", "string")]
    with pytest.raises(Exception, match="expected dimension 3, found 2"):
        schema.confirm_schema(df, id_field="pid", vector_field="emb", dimension=3).collect()
    for names in ({"id_field": "", "vector_field": "emb"}, {"id_field": "pid", "vector_field": ""}, {"id_field": "no", "vector_field": "emb"}):
        with pytest.raises(ValueError):
            schema.confirm_schema(df, **names)


def test_remap(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([(1, [1.0])], "id int, emb array<double>").repartition(1).write.parquet(source)
    df = spark.read.parquet(source)
    change = lambda **options: schema.remap_schema(source, str(tmp_path / "out"), df, current=("id", "emb"), **options)
    assert "warning" in change(id_field="id", reprocess=True)
    assert change(id_field="pid")["success"] is False
    assert change(id_field="pid", vector_field="v", reprocess=True) == {"success": True, "files_rewritten": 1}
    assert spark.read.parquet(str(tmp_path / "out")).columns == ["pid", "v"]
    wrong = schema.remap_schema(source, str(tmp_path / "no"), df, current=("other", "emb"), id_field="pid", reprocess=True)
    assert wrong["files_rewritten"] == 0 and "warning" in wrong
    with pytest.raises(ValueError):
        change()


def test_mirror_and_promote(spark):
    df = spark.createDataFrame(
        [("1", {"id": "mine"}), ("2", {"a": "b"}), ("3", None), ("4", {"key_original": "k4", "t": "x"}), ("5", {"key_original": "k5"})],
        "key string, metadata map<string,string>",
    )
    mirrored = {r.key: r.metadata for r in schema.mirror_id(df).collect()}
    assert mirrored["1"] == {"id": "mine"} and mirrored["2"] == {"id": "2", "a": "b"} and mirrored["3"] == {"id": "3"}
    promoted = {r.key: r.metadata for r in schema.promote_key(df).collect()}
    assert promoted == {"1": {"id": "mine"}, "2": {"a": "b"}, "3": None, "k4": {"t": "x"}, "k5": None}


def test_coerce(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "id int, v array<double>")
    assert {r.id: r.v for r in coerce_vectors(df, "v").collect()} == {1: [1.0, 2.0], 2: [0.0, 0.0]}
    ragged = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "id int, v array<double>")
    with pytest.raises(ValueError):
        coerce_vectors(ragged, "v")
    for odd in ([(1, None)], [(1, [])]):
        left = spark.createDataFrame(odd, "id int, v array<double>")
        assert coerce_vectors(left, "v").collect() == left.collect()


def test_normalize_mean_and_pair_scores(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0]), (1, [0.0, 0.0]), (2, None)], "g int, v array<double>")
    assert [r.n for r in df.select(l2_normalize(F.col("v")).alias("n")).collect()] == [pytest.approx([0.6, 0.8]), [0.0, 0.0], None]
    assert [(r.g, r.v) for r in vector_mean(df, ["g"], "v").collect()] == [(1, [1.5, 2.0])]
    pair = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0])], "a array<double>, b array<double>")
    for metric, score in (("cosine", 0.96), ("IP", 24.0), ("euclidean", 2 ** 0.5)):
        assert pair.select(pair_score(F.col("a"), F.col("b"), metric, 2)).first()[0] == pytest.approx(score)
