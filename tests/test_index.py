"""Indexes kept in folders: cells, reduced vectors, pruned exact search, and the recall target kept with them."""

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from vecframe.operators import ann, cells, index, knn, tuning
from vecframe.operators.evaluate import recall_at_k
from vecframe.plans.queries import EMBEDDED

NAMES = {"key": "vec_id", "vector": "embedding"}
ASKED = {"query_id": "vec_id", "query_vector": "embedding"}


def rows(df):
    return sorted((r.query_id, r["rank"], r.key, r.score if r.score is None else round(r.score, 9)) for r in df.select("query_id", "rank", "key", "score").collect())


def frame(spark, x, **columns):
    data = [(i, [float(v) for v in row], *(c[i] for c in columns.values())) for i, row in enumerate(x)]
    return spark.createDataFrame(data, "vec_id long, embedding array<float>" + "".join(f", {c} int" for c in columns)).repartition(4)


@pytest.fixture(scope="module")
def clustered(spark):
    """Forty tight groups of unequal length and size, a zero vector, repeated vectors, and one without a vector."""
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((40, 12)) * rng.uniform(0.5, 4, (40, 1))
    x = np.concatenate([c + 0.03 * rng.standard_normal((rng.integers(10, 60), 12)) for c in centres])
    x = np.concatenate([x, np.zeros((1, 12)), x[:30]]).astype(np.float32)
    df = frame(spark, x, label=[int(v) for v in rng.integers(0, 4, len(x))])
    return df.unionByName(spark.createDataFrame([(10_000, None, 1)], df.schema)).persist()


@pytest.fixture(scope="module", params=["cosine", "dot_product", "euclidean"])
def built(request, spark, clustered, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / request.param)
    return index.build_index(clustered, path, metric=request.param, n_cells=36, **NAMES)


@pytest.fixture(scope="module")
def queries(clustered):
    return clustered.where("embedding is not null and vec_id % 3 = 0").persist()


def exact(clustered, queries, built, **options):
    return knn.knn_join(clustered, queries, metric=built.metric, **NAMES, **ASKED, **options)


@pytest.mark.parametrize("limit", [knn.BROADCAST_LIMIT, 20_000])
def test_all_cells_are_exact(clustered, queries, built, limit):
    hits = built.search(queries, nprobe=1000, broadcast_limit=limit, **ASKED)
    assert rows(hits) == rows(exact(clustered, queries, built))


@pytest.mark.parametrize("limit,options", [
    (knn.BROADCAST_LIMIT, {"filter": {"label": 2}}), (knn.BROADCAST_LIMIT, {"top_k": 700}), (20_000, {"filter_on": {"label": "label"}, "keep_empty": True}),
])
def test_pruned_search_is_exact(clustered, queries, built, limit, options):
    hits = built.exact(queries, broadcast_limit=limit, **ASKED, **options)
    assert rows(hits) == rows(exact(clustered, queries, built, **options))


def test_pruned_search_skips_most_cells(queries, built):
    _, visits = built.exact_with_visits(queries, top_k=5, **ASKED)
    seen = visits.agg(F.sum(F.col("first") + F.col("later")).alias("seen"), F.sum("cells").alias("all")).first()
    # Lengths play no part in cosine and few queries have their hits in one cell of the others.
    assert seen.seen < 0.35 * seen.all


def test_thresholds_prune_too(clustered, queries, built):
    bound = {"max_distance": 0.2} if built.metric == "euclidean" else {"min_score": 0.9}
    hits, visits = built.exact_with_visits(queries, top_k=50, **bound, **ASKED)
    assert rows(hits) == rows(exact(clustered, queries, built, top_k=50, **bound))
    assert visits.where("first + later < cells").count() > 0


def test_options_of_plain_search(clustered, queries, built):
    options = {"metadata": True, "with_vectors": True, "filter": {"label": 1}, "keep_empty": True, "top_k": F.col("label") + 1}
    by = lambda df: sorted((r.query_id, r["rank"] or 0, r.key or 0, r.label or 0, tuple(r.vector or ())) for r in df.collect())
    wanted = exact(clustered, queries, built, **options)
    for got in (built.search(queries, nprobe=1000, **ASKED, **options), built.exact(queries, **ASKED, **options)):
        assert got.columns == wanted.columns and by(got) == by(wanted)
    assert "label" not in built.search(queries, **ASKED).columns
    with pytest.raises(ValueError, match="is '.*' in this index"):
        built.search(queries, key="id", **ASKED)


def test_few_cells_have_high_recall(clustered, queries, built):
    """Also for the dot product, whose best rows are long rather than near."""
    truth = exact(clustered, queries, built)
    assert recall_at_k(built.search(queries, nprobe=8, **ASKED), truth, 10).first().recall >= 0.9


def test_augmentation_beats_plain_distance_for_dot_products(spark, tmp_path):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((1500, 8)) * rng.lognormal(0, 1, (1500, 1))
    df, asked = frame(spark, x), frame(spark, rng.standard_normal((100, 8)))
    truth = knn.knn_join(df, asked, metric="dot_product", **EMBEDDED).persist()
    built = index.build_index(df, str(tmp_path / "dot"), metric="dot_product", n_cells=36, **NAMES)
    plain = ann.fit_cells(df, 36, vector="embedding", metric="euclidean")
    by_distance = ann.knn_ivf(ann.assign_cells(df, plain, vector="embedding", metric="euclidean"), asked, plain, nprobe=12, metric="dot_product", **EMBEDDED)
    recall = lambda hits: recall_at_k(hits, truth, 10).first().recall
    found = recall(built.search(asked, nprobe=12, **ASKED))
    assert found >= 0.9 and found > recall(by_distance)


def test_assignment_is_nearest_within_the_coarse_cell(built, clustered):
    model, x = built.model, np.array([r.embedding for r in clustered.where("embedding is not null").collect()], np.float32)
    cell, gap = model.assign(x)
    p = model.space.of_rows(x)
    for i in range(len(x)):
        top = ((model.coarse - p[i]) ** 2).sum(axis=1)
        own = np.flatnonzero(model.parent == model.parent[cell[i]])
        assert top[model.parent[cell[i]]] <= top.min() + 1e-5
        away = np.sqrt(((model.fine[own] - p[i]) ** 2).sum(axis=1))
        assert abs(gap[i] - away.min()) < 1e-5 and gap[i] <= model.radius[cell[i]] + 1e-9


def test_many_cells_fit_one_worker():
    rng = np.random.default_rng(1)
    coarse = rng.standard_normal((256, 16)).astype(np.float32)
    fine = np.repeat(coarse, 256, axis=0) + 0.1 * rng.standard_normal((65_536, 16)).astype(np.float32)
    model = cells.Cells(cells.Space("euclidean", 16, 10.0), coarse, fine, np.repeat(np.arange(256, dtype=np.int32), 256))
    x = rng.standard_normal((500, 16)).astype(np.float32)
    cell, gap = model.assign(x)
    top = ((x[:, None] - coarse) ** 2).sum(axis=2).argmin(axis=1)
    for i in range(0, 500, 25):
        own = np.arange(top[i] * 256, top[i] * 256 + 256)
        assert cell[i] == own[((x[i] - fine[own]) ** 2).sum(axis=1).argmin()]
    assert model.probe(x[:3], 4).shape == (3, 4)


def test_vectors_that_are_not_finite(spark, tmp_path):
    x = np.random.default_rng(3).standard_normal((80, 3)).astype(np.float32)
    x[5, 1], x[6, 0], x[7, 2] = np.nan, np.inf, -np.inf
    df = frame(spark, x)
    asked = df.where("vec_id > 20")
    for metric in ("dot_product", "euclidean"):
        built = index.build_index(df, str(tmp_path / metric), metric=metric, n_cells=9, **NAMES)
        wanted = rows(knn.knn_join(df, asked, metric=metric, **EMBEDDED))
        assert rows(built.exact(asked, **ASKED)) == wanted == rows(built.search(asked, nprobe=99, **ASKED))


def test_no_queries_and_no_corpus(spark, built, clustered, tmp_path):
    assert built.search(clustered.where("false"), **ASKED).count() == built.exact(clustered.where("false"), **ASKED).count() == 0
    with pytest.raises(ValueError, match="no vectors"):
        index.build_index(clustered.where("false"), str(tmp_path / "none"), **NAMES)


@pytest.mark.parametrize("metric", ["cosine", "dot_product", "euclidean"])
def test_reduced_vectors_of_full_width_are_exact(clustered, queries, tmp_path, metric):
    width = 13 if metric == "dot_product" else 12
    built = index.build_index(clustered, str(tmp_path / metric), "pca", metric=metric, reduced_dimensions=width, **NAMES)
    options = {"metadata": ["label"], "filter_on": {"label": "label"}, "keep_empty": True, "top_k": F.col("label") + 2}
    queries = queries.where(F.exists("embedding", lambda x: x != 0))  # to a zero vector all rows are alike, and candidates any of them
    got = built.search(queries, candidate_multiplier=4, **ASKED, **options)
    assert rows(got) == rows(exact(clustered, queries, built, **options)) and got.columns[-1] == "label"


def test_a_second_search_fits_nothing(spark, tmp_path, monkeypatch, embeddings):
    path = str(tmp_path / "kept")
    first = rows(ann.search(embeddings, embeddings, index_path=path, index_params={"nprobe": 4, "n_cells": 16}, **EMBEDDED))
    for module, fit in ((cells, "KMeans"), (index, "PCA"), (index, "fit_two_level")):
        monkeypatch.setattr(module, fit, None)
    again = ann.search(embeddings, embeddings, index_path=path, index_params={"nprobe": 4}, **EMBEDDED)
    assert rows(again) == first


def test_a_probe_reads_its_shelves_only(spark, tmp_path, embeddings):
    built = index.build_index(embeddings, str(tmp_path / "kept"), n_cells=16, **NAMES)
    plan = plan_of(built.search(embeddings.limit(1), nprobe=1, **ASKED))
    assert "PartitionFilters: [_shelf" in plan.replace("isnotnull(_shelf#", "_shelf#") or "_shelf#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "_cell" in plan.split("PushedFilters: [")[1].split("]")[0]


def test_a_changed_corpus_is_refused(spark, tmp_path, embeddings):
    table, path = str(tmp_path / "table"), str(tmp_path / "kept")
    embeddings.write.parquet(table)
    built = index.build_index(spark.read.parquet(table), path, n_cells=4, **NAMES)
    assert index.open_index(spark, path, spark.read.parquet(table)).entry == built.entry
    embeddings.limit(3).write.mode("append").parquet(table)
    with pytest.raises(index.StaleIndex):
        index.open_index(spark, path, spark.read.parquet(table))
    with pytest.raises(index.StaleIndex):
        ann.search(spark.read.parquet(table), embeddings, index_path=path, **EMBEDDED)
    index.build_index(spark.read.parquet(table), path, n_cells=4, **NAMES)
    assert index.open_index(spark, path, spark.read.parquet(table)).entry["number"] == 2
    assert built.search(embeddings, **ASKED).count() > 0  # an index opened before stays readable
    derived = embeddings.withColumn("embedding", F.transform("embedding", lambda x: x * 2))
    index.build_index(derived, path, n_cells=4, version="seven", **NAMES)
    assert index.open_index(spark, path, version="seven").entry["number"] == 3
    with pytest.raises(index.StaleIndex):
        index.open_index(spark, path, derived)


def test_a_batch_may_name_indexes(spark, tmp_path, embeddings):
    built = index.build_index(embeddings, str(tmp_path / "kept"), n_cells=4, **NAMES)
    asked = embeddings.limit(20).withColumn("collection", F.when(F.col("vec_id") % 2 == 0, "plain").otherwise("indexed"))
    got = knn.query_batch({"plain": embeddings, "indexed": built}, asked, **EMBEDDED)
    assert got.where("rank is not null").select("query_id").distinct().count() == 20
    wanted = {r for r in rows(knn.knn_join(embeddings, asked.where("collection = 'plain'"), **EMBEDDED))}
    assert wanted <= set(rows(got))


# --- the kept recall target ---------------------------------------------------------------------


def test_confidence_needs_many_queries():
    assert tuning.confidence([1.0] * 10)[1] < 0.8 < 0.99 < tuning.confidence([1.0] * 1000)[1]
    mean, low, high = tuning.confidence([0.0, 1.0] * 50)
    assert low < mean == 0.5 < high


def test_a_target_is_tuned_once_and_again_after_drift(spark, tmp_path, embeddings, monkeypatch):
    path = str(tmp_path / "kept")
    truth = knn.knn_join(embeddings, embeddings, **EMBEDDED).persist()
    tuned = []
    plain = tuning.tune
    monkeypatch.setattr(tuning, "tune", lambda *a, **o: tuned.append(plain(*a, **o)) or tuned[-1])
    search = lambda queries: ann.search(embeddings, queries, index_path=path, target_recall=0.9, index_params={"n_cells": 16} if not tuned else None, **EMBEDDED)
    assert recall_at_k(search(embeddings), truth, 10).first().recall >= 0.9
    assert recall_at_k(search(embeddings), truth, 10).first().recall >= 0.9 and len(tuned) == 1
    far = embeddings.withColumn("embedding", F.transform("embedding", lambda x: F.abs(x)))
    search(far).count()
    assert len(tuned) == 2
    index.build_index(embeddings, path, n_cells=9, **NAMES)
    search(embeddings).count()
    assert len(tuned) == 3
    choice, measured = tuned[0]
    assert choice["method"] in ("exact", "cells") and all(m.seconds > 0 for m in measured)


def test_tuning_grows_its_sample_where_it_cannot_tell(spark, tmp_path, embeddings):
    built = index.build_index(embeddings, str(tmp_path / "kept"), n_cells=16, **NAMES)
    choice, measured = tuning.tune(built, embeddings, target_recall=0.95, first_sample=16, **ASKED)
    assert len({m.sample for m in measured}) > 1 and choice["low"] >= 0.95
    none, measured = tuning.tune(built, embeddings.where("false"), target_recall=0.95, **ASKED)
    assert none["method"] == "exact" and measured == []
