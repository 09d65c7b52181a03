"""Reads by key that skip row groups, and profiles that read new files only."""

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from vecframe.operators import knn, points, profiles
from vecframe.plans.queries import EMBEDDED


def scanned(df):
    """Rows that came out of the scan of Parquet files, by Spark's own metric."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    found, ahead = 0, [plan]
    while ahead:
        node = ahead.pop()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            found += node.metrics().get("numOutputRows").get().value()
        children = node.children()
        ahead += [children.apply(i) for i in range(children.size())]
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            ahead.append(node.plan())
    return found


@pytest.fixture(scope="module")
def keyed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("keyed") / "table")
    rows = spark.range(0, 200_000, 2, 4).select(F.col("id").alias("key"), F.array(*[F.rand(i).cast("float") for i in range(8)]).alias("vector"), (F.col("id") % 7).alias("label"))
    points.write_keyed(rows, path, "key", parts=8, group_bytes=64 * 1024, keys_per_group=5000)
    return path


@pytest.mark.parametrize("keys", [[10], [4, 100_000, 199_998, 77], list(range(50_000, 50_060))])
def test_fetch_reads_few_row_groups(spark, keyed, keys):
    asked = spark.createDataFrame([(k,) for k in [*keys, keys[0]]], "key long")
    got = points.fetch_stored(spark, keyed, asked, key="key")
    assert sorted((r.key, r.found) for r in got.collect()) == sorted((k, k % 2 == 0) for k in [*keys, keys[0]])
    rows = spark.read.parquet(keyed).where(points.among(F.col("key"), keys))
    assert 0 < scanned(rows) <= 100_000 / 4 and scanned(spark.read.parquet(keyed)) == 100_000
    joined = points.fetch_stored(spark, keyed, asked, key="key", most=0)
    assert sorted((r.key, r.found) for r in joined.collect()) == sorted((r.key, r.found) for r in got.collect())


def test_bloom_filters_skip_absent_keys(spark, keyed):
    """An odd key lies within the range of a row group that its Bloom filter rules out."""
    assert scanned(spark.read.parquet(keyed).where(points.among(F.col("key"), [77_777]))) == 0


def test_search_pushes_wanted_values(spark, keyed):
    table = spark.read.parquet(keyed)
    asked = table.where("key in (20, 30, 150000)").withColumn("wanted", F.col("key"))
    hits = knn.knn_join(table, asked, query_id="key", filter_on={"key": "wanted"})
    assert {(r.query_id, r.key) for r in hits.collect()} == {(k, k) for k in (20, 30, 150_000)}
    assert "In(key" in plan_of(hits) or "EqualTo(key" in plan_of(hits)
    open_one = asked.withColumn("wanted", F.when(F.col("key") > 20, F.col("key")))
    wide = knn.knn_join(table, open_one, query_id="key", filter_on={"key": "wanted"}, top_k=3)
    assert {r.query_id: r.n for r in wide.groupBy("query_id").agg(F.count("*").alias("n")).collect()} == {20: 3, 30: 1, 150_000: 1}


def test_among_of_nothing(spark):
    assert spark.range(3).where(points.among(F.col("id"), [])).count() == 0


def test_profiles_read_new_files_only(spark, tmp_path, embeddings):
    path, known = str(tmp_path / "table"), profiles.FileProfiles(spark, str(tmp_path / "known"))
    embeddings.coalesce(1).write.parquet(path)
    assert known.profile(spark.read.parquet(path)).first().pending_count == 1
    assert known.add(spark.read.parquet(path)) == 1 and known.add(spark.read.parquet(path)) == 0
    first = known.profile(spark.read.parquet(path)).first()
    assert (first.state, first.id_field, first.vector_field, first.dimension, first.samples_analyzed, first.pending_count) == ("detected", "vec_id", "embedding", 64, embeddings.count(), 0)
    # The same keys again: rows double, different values do not, so it is no key any more.
    embeddings.coalesce(1).write.mode("append").parquet(path)
    grown = spark.read.parquet(path)
    pending = [r.file_path for r in known.pending(grown).collect()]
    assert len(pending) == 1 and known.add(grown) == 1
    facts = known.known().where(F.col("file_path") == pending[0])
    assert facts.select("rows").distinct().first().rows == embeddings.count()
    both = known.profile(grown).first()
    assert (both.state, both.id_field, both.samples_analyzed, both.pending_count) == ("analyzing", None, 2 * embeddings.count(), 0)


def test_vectors_of_two_lengths_are_no_vectors(spark, tmp_path):
    path, known = str(tmp_path / "table"), profiles.FileProfiles(spark, str(tmp_path / "known"))
    for i, v in enumerate(([1.0, 2.0], [1.0])):
        spark.createDataFrame([(i, v)], "id int, v array<double>").write.mode("append").parquet(path)
        known.add(spark.read.parquet(path))
        row = known.profile(spark.read.parquet(path)).first()
        assert (row.id_field, row.vector_field) == ("id", "v" if i == 0 else None)
