import numpy as np
import pytest
from pyspark.sql import functions as F

from vecframe.operators import ann, knn, lsh, vectors
from vecframe.operators.evaluate import ndcg_at_k, recall_at_k, recall_per_query
from vecframe.operators.rerank import mmr
from vecframe.plans.queries import EMBEDDED


@pytest.fixture(scope="module")
def truth(embeddings):
    return knn.knn_join(embeddings, embeddings, **EMBEDDED).persist()


@pytest.fixture(scope="module")
def centroids(embeddings):
    return ann.fit_cells(embeddings, 8, vector="embedding")


@pytest.fixture(scope="module")
def celled(embeddings, centroids):
    return ann.assign_cells(embeddings, centroids, vector="embedding").persist()


def rows(df):
    return sorted((r.query_id, r["rank"], r.key, round(r.score, 9)) for r in df.collect())


def test_pca_recall_and_exact_scores(embeddings, truth):
    components = ann.fit_pca(embeddings, 48, vector="embedding")
    hits = ann.knn_pca(embeddings, embeddings, components, candidate_multiplier=20, **EMBEDDED)
    assert recall_at_k(hits, truth, 10).first().recall > 0.95
    exact = {(q, k): s for q, _, k, s in rows(truth)}
    assert all(s == exact[q, k] for q, _, k, s in rows(hits) if (q, k) in exact)


def test_pca_with_all_dimensions_is_exact(embeddings, truth):
    components = ann.fit_pca(embeddings, 64, vector="embedding")
    assert rows(ann.knn_pca(embeddings, embeddings, components, **EMBEDDED)) == rows(truth)


@pytest.mark.parametrize("limit", [knn.BROADCAST_LIMIT, 60_000])
def test_all_cells_are_exact(celled, embeddings, centroids, truth, limit):
    hits = ann.knn_ivf(celled, embeddings, centroids, nprobe=8, broadcast_limit=limit, **EMBEDDED)
    assert rows(hits) == rows(truth)


def test_few_cells_agree_on_both_layouts(celled, embeddings, centroids):
    scan = ann.knn_ivf(celled, embeddings, centroids, nprobe=2, **EMBEDDED)
    grid = ann.knn_ivf(celled, embeddings, centroids, nprobe=2, broadcast_limit=60_000, **EMBEDDED)
    assert rows(scan) == rows(grid)


def test_stored_cells_are_pruned(spark, celled, centroids, tmp_path):
    ann.write_cells(celled, str(tmp_path / "cells"), key="vec_id")
    stored = spark.read.parquet(str(tmp_path / "cells"))
    one = celled.limit(1)
    hits = ann.knn_ivf(stored, one, centroids, nprobe=1, **EMBEDDED)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan.replace("isnotnull(cell", "cell") or "PartitionFilters: [isnotnull(cell" in plan
    assert hits.first().key == one.first().vec_id


def test_a_cell_with_most_rows_is_cut(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 4)) * 0.01 + np.where(np.arange(600)[:, None] < 400, [5, 0, 0, 0], [0, 5, 0, 0])
    table = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "key long, vector array<double>")
    centroids = np.array([[5.0, 0, 0, 0], [0, 5.0, 0, 0]])
    celled = ann.assign_cells(table, centroids, metric="euclidean")
    options = {"query_id": "key", "metric": "euclidean"}
    exact = knn.knn_join(table, table, **options)
    assert rows(ann.knn_ivf(celled, table, centroids, nprobe=2, broadcast_limit=20_000, **options)) == rows(exact)


def test_recall_rises_with_cells(celled, embeddings, centroids, truth):
    recalls = [
        recall_at_k(ann.knn_ivf(celled, embeddings, centroids, nprobe=n, **EMBEDDED), truth, 10).first().recall for n in (1, 4, 8)
    ]
    assert 0 <= recalls[0] < recalls[1] < recalls[2] == 1.0


def test_tuning_small_tables_stays_exact(embeddings):
    choice, report = ann.tune_recall(embeddings, embeddings, exact_below=50_000, **EMBEDDED)
    assert choice["method"] == "exact" and report.count() == 1


def test_tuning_meets_the_target(embeddings):
    choice, report = ann.tune_recall(embeddings, embeddings, target_recall=0.9, exact_below=0, n_cells=8, **EMBEDDED)
    table = {(r.method, tuple(sorted(r.params.items()))): r for r in report.collect()}
    chosen = [r for r in table.values() if r.chosen]
    assert len(chosen) == 1 and choice["recall"] >= 0.9
    assert all(r.cost >= choice["cost"] for r in table.values() if r.recall >= 0.9)


@pytest.mark.parametrize("target", [0.49, 0.9995, 1.0])
def test_target_bounds(embeddings, target):
    with pytest.raises(ValueError):
        ann.tune_recall(embeddings, embeddings, target_recall=target, **EMBEDDED)


def test_search_by_index_name(embeddings, truth):
    assert rows(ann.search(embeddings, embeddings, **EMBEDDED)) == rows(truth)
    params = {"reduced_dimensions": 64, "candidate_multiplier": 2}
    assert rows(ann.search(embeddings, embeddings, use_index="pca", index_params=params, **EMBEDDED)) == rows(truth)
    with pytest.raises(ValueError):
        ann.search(embeddings, embeddings, index_params=params, **EMBEDDED)
    with pytest.raises(ValueError):
        ann.search(embeddings, embeddings, use_index="tree", **EMBEDDED)
    with pytest.raises(ValueError):
        ann.search(embeddings, embeddings, use_index="hnsw", index_params={"pca": 1}, **EMBEDDED)


def test_quality_measures(spark):
    truth = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "query_id int, rank int, key string")
    hits = spark.createDataFrame([(1, 1, "b"), (1, 2, "x"), (2, None, None)], "query_id int, rank int, key string")
    assert {r.query_id: r.recall for r in recall_per_query(hits, truth, 2).collect()} == {1: 0.5, 2: 0.0}
    ideal = 1 + 1 / np.log2(3)
    assert ndcg_at_k(hits, truth, 2).first().ndcg == pytest.approx(1 / ideal / 2)


def test_mmr_equals_a_plain_loop(embeddings):
    hits = knn.knn_join(embeddings, embeddings, top_k=12, with_vectors=True, **EMBEDDED)
    got = {(r.query_id, r["rank"]): r.key for r in mmr(hits, 4, trade_off=0.6).collect()}
    for query, group in hits.toPandas().groupby("query_id"):
        group = group.sort_values("rank")
        left, picked = list(group.itertuples()), []
        while len(picked) < 4:
            value = lambda h: 0.6 * h.score - 0.4 * max((float(np.dot(np.float64(h.vector), np.float64(p.vector))) for p in picked), default=0)
            best = max(left, key=value)
            left.remove(best)
            picked.append(best)
            assert got[query, len(picked)] == best.key


def test_mmr_of_distances(spark):
    hits = spark.createDataFrame([(1, i + 1, i, float(i), [1.0, float(i)]) for i in range(6)], "query_id int, rank int, key int, score double, vector array<float>")
    got = [r.key for r in mmr(hits, 3, trade_off=1.0, metric="euclidean").orderBy("rank").collect()]
    assert got == [0, 1, 2]


def test_best_places_keep_the_order_of_a_full_sort():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 5, (300, 40)).astype(float)
    for count in (1, 3, 10, 40):
        assert (vectors._best_places(values, count) == np.argsort(-values, axis=1, kind="stable")[:, :count]).all()


def test_cells_of_many_centroids_are_assigned_in_tiles(spark, embeddings):
    centroids = np.random.default_rng(2).standard_normal((20_000, 64))
    got = ann.assign_cells(embeddings, centroids, vector="embedding").select("embedding", "cell").collect()
    for r in got[:50]:
        x = np.array(r.embedding, np.float64)
        x /= np.linalg.norm(x)
        assert r.cell == np.argmax(x @ centroids.T - (centroids**2).sum(axis=1) / 2)


@pytest.mark.parametrize("k", [1, 10])
def test_hashed_search(spark, embeddings, k):
    truth = knn.knn_join(embeddings, embeddings, top_k=k, metric="euclidean", **EMBEDDED)
    hits = lsh.knn_lsh(embeddings, embeddings, top_k=k, **EMBEDDED).persist()
    assert hits.columns == truth.columns and hits.groupBy("query_id").count().where(f"count <> {k}").count() == 0
    assert recall_at_k(hits, truth, k).first().recall >= 0.9
    exact = {(r.query_id, r.key): r.score for r in knn.knn_join(embeddings, embeddings, top_k=500, metric="euclidean", **EMBEDDED).collect()}
    assert all(abs(r.score - exact[r.query_id, r.key]) < 1e-9 for r in hits.collect())


def test_hashed_search_of_lonely_queries(spark):
    """Queries far from all rows find nothing by hash and are searched exactly; equal rows rank by key."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.standard_normal((300, 6)), np.zeros((5, 6))])
    table = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "key long, vector array<float>")
    asked = table.union(spark.createDataFrame([(1000, [50.0] * 6), (1001, [-90.0] * 6)], table.schema))
    options = {"query_id": "key", "top_k": 4}
    assert rows(lsh.knn_lsh(table, asked, miss=1e-9, **options)) == rows(knn.knn_join(table, asked, metric="euclidean", **options))
    assert lsh.knn_lsh(table, asked.where("false"), **options).count() == 0


def test_chance_of_a_shared_bucket():
    rng = np.random.default_rng(1)
    for ratio in (0.5, 1.0, 2.0, 4.0):
        shift, move = rng.random(200_000), rng.standard_normal(200_000) / ratio
        assert abs((np.floor(shift + move) == 0).mean() - lsh.collision(1.0, ratio)) < 0.01
