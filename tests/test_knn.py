import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from vecframe.operators import knn
from vecframe.plans.queries import EMBEDDED


def rows(df):
    return sorted((r.query_id, r["rank"], r.key, round(r.score, 9)) for r in df.collect())


@pytest.mark.parametrize("metric", ["cosine", "dot_product", "euclidean"])
def test_grid_equals_scan(embeddings, metric):
    scan = knn.knn_join(embeddings, embeddings, metric=metric, **EMBEDDED)
    grid = knn.knn_join(embeddings, embeddings, metric=metric, broadcast_limit=50_000, **EMBEDDED)
    assert rows(scan) == rows(grid)


def test_grid_with_filters_and_own_k(embeddings):
    options = dict(EMBEDDED, top_k=F.col("label") + 1, filter_on={"label": "label"})
    scan = knn.knn_join(embeddings, embeddings, **options)
    grid = knn.knn_join(embeddings, embeddings, broadcast_limit=50_000, **options)
    assert rows(scan) == rows(grid)


def test_two_merge_levels_change_nothing(embeddings, monkeypatch):
    one = rows(knn.knn_join(embeddings, embeddings, **EMBEDDED))
    monkeypatch.setattr(knn, "scan_tasks", lambda df: knn.MERGE_FAN_IN + 1)
    assert one == rows(knn.knn_join(embeddings, embeddings, **EMBEDDED))


def test_corpus_is_neither_shuffled_nor_broadcast(embeddings):
    plan = plan_of(knn.knn_join(embeddings, embeddings, filter={"label": 3}, **EMBEDDED))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "BroadcastExchange" not in plan
    below = plan[plan.index("MapInArrow"):]
    assert "Exchange" not in below
    assert "PushedFilters: [IsNotNull(label), EqualTo(label,3)]" in below


def test_scan_keeps_its_splits(spark, embeddings, tmp_path):
    """Every file split is a task of its own; none are folded together."""
    embeddings.repartition(20).write.parquet(str(tmp_path / "many"))
    many = spark.read.parquet(str(tmp_path / "many"))
    assert "Coalesce" not in plan_of(knn.knn_join(many, embeddings, **EMBEDDED))


@pytest.mark.parametrize("limit", [knn.BROADCAST_LIMIT, 10])
def test_repeated_query_ids_are_refused(spark, limit):
    corpus = small_table(spark, [("a", [1.0, 0.0])])
    asked = spark.createDataFrame([(1, [5.0, 1.0]), (1, [0.0, 1.0])], "query_id int, vector array<double>")
    with pytest.raises(ValueError, match="more than once"):
        knn.knn_join(corpus, asked, broadcast_limit=limit)


def test_a_batch_survives_items_that_cannot_be_answered(spark):
    one = small_table(spark, [("a", [1.0, 0.0])])
    schema = "query_id int, vector array<double>, collection string, metric string, k int, low double"
    items = [(1, [1.0, 0.0], "one", "cosine", 1, None), (2, [1.0], "one", "cosine", 1, None), (3, [1.0, 0.0], "one", "odd", 1, None), (4, None, "one", "cosine", 1, None), (5, [1.0, 0.0], "one", "L2", 1, 0.5), (6, [1.0, 0.0], "none", "cosine", 1, None), (7, [1.0, 0.0], "one", "cosine", 0, None), (8, [1.0, 0.0], None, "cosine", 1, None)]
    asked = spark.createDataFrame(items, schema)
    got = knn.query_batch({"one": one}, asked, metric=F.col("metric"), top_k=F.col("k"), min_score=F.col("low")).collect()
    assert sorted((r.query_id, r.key) for r in got) == [(1, "a"), *((i, None) for i in range(2, 9))]


def test_merge_keeps_k_rows_per_query_before_the_shuffle(embeddings):
    plan = plan_of(knn.knn_join(embeddings, embeddings, **EMBEDDED))
    assert plan.count("WindowGroupLimit") == 2


def test_no_join_of_every_pair_in_the_grid(embeddings):
    plan = plan_of(knn.knn_join(embeddings, embeddings, broadcast_limit=50_000, **EMBEDDED))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def small_table(spark, data):
    return spark.createDataFrame(data, "key string, vector array<double>")


def test_zero_vectors_ties_and_missing_vectors(spark):
    corpus = small_table(spark, [("c", [1.0, 0.0]), ("b", [2.0, 0.0]), ("z", [0.0, 0.0]), ("n", None), ("a", [-1.0, 0.0])])
    hits = knn.knn_single(corpus, [3.0, 0.0], top_k=99).collect()
    assert [(h["rank"], h.key, h.score) for h in hits] == [(1, "b", 1.0), (2, "c", 1.0), (3, "z", 0.0), (4, "a", -1.0)]


def test_negative_scores_survive_without_a_threshold(spark):
    corpus = small_table(spark, [("a", [-5.0])])
    assert knn.knn_single(corpus, [1.0], metric="dot_product").first().score == -5.0
    assert knn.knn_single(corpus, [1.0], metric="dot_product", min_score=-1.0).count() == 0


def test_distance_bound(spark):
    corpus = small_table(spark, [("a", [0.0]), ("b", [2.0]), ("c", [5.0])])
    hits = knn.knn_single(corpus, [1.0], metric="L2", max_distance=1.0).collect()
    assert [(h.key, h.score) for h in hits] == [("a", 1.0), ("b", 1.0)]


def test_empty_corpus_and_empty_queries(spark):
    corpus, queries = small_table(spark, []), spark.createDataFrame([(1, [1.0])], "query_id long, vector array<double>")
    assert knn.knn_join(corpus, queries).count() == 0
    kept = knn.knn_join(corpus, queries, keep_empty=True).collect()
    assert [(r.query_id, r["rank"], r.key) for r in kept] == [(1, None, None)]
    assert knn.knn_join(small_table(spark, [("a", [1.0])]), queries.where("false")).count() == 0


def test_payload_and_vectors(spark):
    corpus = spark.createDataFrame([("a", [1.0, 0.0], "x", 1), ("b", [0.0, 1.0], "y", 2)], "key string, vector array<double>, tag string, score int")
    hit = knn.knn_single(corpus, [1.0, 0.0], top_k=1, metadata=True, with_vectors=True).first()
    assert hit.asDict() == {"rank": 1, "key": "a", "score": 1.0, "tag": "x", "score_meta": 1, "vector": [1.0, 0.0]}


def test_batch_with_unknown_collection(spark):
    corpus = small_table(spark, [("a", [1.0])])
    queries = spark.createDataFrame([(1, [1.0], "one"), (2, [1.0], "lost")], "query_id long, vector array<double>, collection string")
    hits = {r.query_id: r.key for r in knn.query_batch({"one": corpus}, queries).collect()}
    assert hits == {1: "a", 2: None}


@pytest.mark.parametrize(
    "options",
    [
        {"metric": "manhattan"},
        {"metric": "euclidean", "min_score": 0.5},
        {"max_distance": 0.5},
        {"top_k": 0},
        {"filter": {"key": ["a"]}},
    ],
)
def test_refused_options(spark, options):
    with pytest.raises(ValueError):
        knn.knn_single(small_table(spark, [("a", [1.0])]), [1.0], **options)


def test_refused_vectors(spark):
    corpus = small_table(spark, [("a", [1.0])])
    with pytest.raises(ValueError):
        knn.knn_single(corpus, [])
    with pytest.raises(Exception, match="dimension"):
        knn.knn_single(corpus, [1.0, 2.0]).collect()
    mixed = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "query_id long, vector array<double>")
    with pytest.raises(ValueError, match="dimension"):
        knn.knn_join(corpus, mixed)
    twice = spark.createDataFrame([(1, [1.0]), (1, [2.0])], "query_id long, vector array<double>")
    with pytest.raises(ValueError, match="more than once"):
        knn.knn_join(corpus, twice, broadcast_limit=1)
