"""The grid in which many queries and rows meet: what is scored, what travels, and that results stay exact."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.feature import BucketedRandomProjectionLSHModel
from pyspark.sql import functions as F

from vecframe.operators import ann, index, knn, lsh, topk

NAMES = {"key": "id", "vector": "v", "query_id": "id", "query_vector": "v"}


def lists(m):
    return pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, m.shape[1]), pa.int32()), pa.array(m.reshape(-1)))


@pytest.fixture(scope="module")
def points(spark):
    x = np.random.default_rng(5).standard_normal((400, 8)).astype(np.float32)
    x[7] = x[11]
    return spark.createDataFrame([(i, row.tolist(), i % 3) for i, row in enumerate(x)], "id long, v array<float>, label int").repartition(4).persist()


def rows(df):
    return sorted((r.query_id, r["rank"], r.key, round(r.score, 9)) for r in df.collect())


def test_wide_batch_after_a_narrow_one_scores_few_pairs(monkeypatch):
    scored, exact = [], topk.exact_goodness
    monkeypatch.setattr(topk, "exact_goodness", lambda q, x, metric: scored.append(len(q)) or exact(q, x, metric))
    x = np.random.default_rng(3).standard_normal((4020, 8)).astype(np.float32)
    n = 50
    queries = pa.table({
        "qid": pa.array(range(n)), "qvec": lists(x[:n]), "qk": pa.array([10] * n, pa.int32()),
        "qfloor": pa.nulls(n, pa.float64()), "qmetric": pa.array([topk.EUCLIDEAN] * n, pa.int32()),
    })
    best = topk.TopK(queries, 8)
    for at, end in ((0, 20), (20, 4020)):
        best.add(pa.array(range(at, end)), lists(x[at:end]), {})
    assert sum(scored) < 50 * n
    got = best.result(pa.int64()).to_pandas()
    gaps = np.linalg.norm(x[:n, None].astype(np.float64) - x[None].astype(np.float64), axis=2)
    assert all(set(got[got.query_id == i].key) == set(np.argsort(gaps[i])[:10]) for i in range(n))


def test_copies_do_not_grow_with_the_tasks_of_a_shuffle(spark, points):
    asked = knn.query_table(points, query_id="id", query_vector="v", top_k=10, metric="cosine", min_score=None, max_distance=None, filter_on=None)
    rows_of = points.select(F.col("id").alias("key"), F.col("v").alias("vec"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1000)
    try:
        hits = knn._grid_hits(rows_of, asked, knn.measure(asked, 2000), 60_000)
        # A task sends on at most k rows per query, so hits count the columns a query travels to.
        assert hits.count() <= 400 * 10 * 60
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_routes_name_each_column_once():
    places, total = ann._columns({0: 5, 1: 5, 2: 90, 3: 5, 512: 5}, 4, 512)
    assert places[2][1] > 1 and places[512][0] > max(first + parts - 1 for c, (first, parts) in places.items() if c < 512)
    assert total == max(first + parts for first, parts in places.values())
    got = ann._routes(places).func(pa.array([[3, 0, 1, 9], [], [2]], pa.list_(pa.int32()))).to_pylist()
    assert got[1] == [] and [r["column"] for r in got[2]] == [places[2][0] + i for i in range(places[2][1])]
    assert sorted(c for r in got[0] for c in r["cells"]) == [0, 1, 3]
    assert all(len({r["column"] for r in one}) == len(one) for one in got)


@pytest.mark.parametrize("metric", ["cosine", "dot_product", "euclidean"])
def test_stored_index_is_exact_for_many_queries(points, tmp_path, metric):
    built = index.build_index(points, str(tmp_path / "i"), key="id", vector="v", metric=metric)
    truth = rows(knn.knn_join(points, points, metric=metric, top_k=5, **NAMES))
    asking = {"query_id": "id", "query_vector": "v", "top_k": 5, "broadcast_limit": 20_000}
    assert rows(built.exact(points, **asking)) == truth
    assert rows(built.search(points, nprobe=index.MOST_CELLS, **asking)) == truth


@pytest.mark.parametrize("stored", [False, True])
def test_many_candidates_are_scored_where_they_are_found(points, stored):
    components = ann.fit_pca(points, 5, vector="v")
    options = {"top_k": 4, "candidate_multiplier": 3, "min_score": 0.2, "filter_on": {"label": "label"}, **NAMES}
    if stored:
        options["reduced"] = ann.reduce_vectors(points, components, vector="v")
    many = ann.knn_pca(points, points, components, broadcast_limit=20_000, **options)
    assert rows(many) == rows(ann.knn_pca(points, points, components, **options))
    # No pair of a query and a candidate is joined to the vectors.
    assert many._jdf.queryExecution().optimizedPlan().toString().count("Join") <= 1 + stored


def test_hashing_builds_no_pairs(points, monkeypatch):
    def refused(*_):
        raise AssertionError("pairs joined")

    monkeypatch.setattr(BucketedRandomProjectionLSHModel, "approxSimilarityJoin", refused)
    truth = rows(knn.knn_join(points, points, metric="euclidean", top_k=5, **NAMES))
    assert rows(lsh.knn_lsh(points, points, top_k=5, miss=1e-9, **NAMES)) == truth


def test_grid_of_pruned_search_does_not_grow_with_the_cells(points, tmp_path, monkeypatch):
    """Queries carry no lists of the cells they look into, so neither what travels nor what is stored grows with the number of cells."""
    shapes, stored, shape, kept = [], [], knn.grid_shape, index.Index._kept
    monkeypatch.setattr(knn, "grid_shape", lambda rows, facts, limit: shapes.append(facts.bytes) or shape(rows, facts, limit))
    monkeypatch.setattr(index.Index, "_kept", lambda self, df, purpose: stored.append((purpose, kept(self, df, purpose))) or stored[-1][1])
    asking = {"query_id": "id", "query_vector": "v", "top_k": 5, "broadcast_limit": 20_000}
    truth = rows(knn.knn_join(points, points, metric="dot_product", top_k=5, **NAMES))
    late, whole = [], []
    for cells in (4, 40):
        built = index.build_index(points, str(tmp_path / str(cells)), key="id", vector="v", metric="dot_product", n_cells=cells)
        assert rows(built.exact(points, **asking)) == truth
        late.append(shapes[-1])
        assert rows(built.search(points, nprobe=index.MOST_CELLS, **asking)) == truth
        whole.append(shapes[-1])
    # At most a few queries more look into no further cell.
    assert late[1] <= late[0] * 1.05 and whole[1] == whole[0]
    visits = [df for purpose, df in stored if purpose == "later-cells"]
    assert all(df.agg(F.max(F.size("qcells"))).first()[0] <= index.FIRST_CELLS + 1 for df in visits)
    assert visits[1].agg(F.max("later")).first()[0] > 4
