"""The blocked top-k against brute force, whatever the batches, ties and odd values."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vecframe.operators import topk
from vecframe.operators.topk import COSINE, DOT, EUCLIDEAN, TopK


def brute(q, k, metric, floor, keys, x, allowed=None):
    found = []
    with np.errstate(all="ignore"):
        for i, key in enumerate(keys):
            if allowed is not None and not allowed[i]:
                continue
            a, b = q.astype(float), x[i].astype(float)
            if metric == EUCLIDEAN:
                good = -np.sqrt(((a - b) ** 2).sum())
            else:
                good = (a * b).sum()
                if metric == COSINE:
                    scale = np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())
                    good = 0.0 if scale == 0 else good / scale
            if not np.isnan(good) and good >= floor:
                found.append((-good, key))
    return [key for _, key in sorted(found)[:k]]


def lists(matrix):
    return pa.array([list(map(float, row)) for row in matrix], type=pa.list_(pa.float32()))


def run(queries, ks, metrics, floors, keys, x, batch, row_filter=None, wanted=None):
    table = {
        "qid": pa.array(range(len(queries)), type=pa.int64()),
        "qvec": lists(queries),
        "qk": pa.array(ks, type=pa.int32()),
        "qfloor": pa.array([None if np.isneginf(f) else f for f in floors], type=pa.float64()),
        "qmetric": pa.array(metrics, type=pa.int32()),
    }
    if wanted is not None:
        table["f_0"] = pa.array(wanted, type=pa.string())
    best = TopK(pa.table(table), queries.shape[1])
    keys = pa.array(keys)
    for at in range(0, len(x), batch):
        part = slice(at, at + batch)
        filters = {} if row_filter is None else {"f_0": pa.array(row_filter[part], type=pa.string())}
        best.add(keys[part], lists(x[part]), filters)
    out = best.result(keys.type).to_pydict()
    hits = [[] for _ in queries]
    for q, key in zip(out["query_id"], out["key"]):
        hits[q].append(key)
    return hits


values = st.sampled_from([0.0, 1.0, -1.0, 0.5, 2.0, -0.25, 3.0])


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_equals_brute_force(data):
    dim = data.draw(st.integers(1, 4))
    n, m = data.draw(st.integers(1, 40)), data.draw(st.integers(1, 5))
    matrix = lambda rows: np.array(
        data.draw(st.lists(st.lists(values, min_size=dim, max_size=dim), min_size=rows, max_size=rows)), dtype=np.float32
    )
    queries, x = matrix(m), matrix(n)
    draw_each = lambda strategy, count: data.draw(st.lists(strategy, min_size=count, max_size=count))
    ks, metrics = draw_each(st.integers(1, 8), m), draw_each(st.sampled_from([COSINE, DOT, EUCLIDEAN]), m)
    floors = draw_each(st.sampled_from([-np.inf, -np.inf, -0.7, 0.3, 9.0]), m)
    keys = data.draw(st.permutations([f"k{i}" for i in range(n)]))
    row_filter = draw_each(st.sampled_from(["a", "b", None]), n)
    wanted = draw_each(st.sampled_from(["a", "b", "c", None]), m)
    hits = run(queries, ks, metrics, floors, keys, x, data.draw(st.integers(1, 40)), row_filter, wanted)
    for i in range(m):
        allowed = [wanted[i] is None or f == wanted[i] for f in row_filter]
        assert set(hits[i]) == set(brute(queries[i], ks[i], metrics[i], floors[i], keys, x, allowed))


@pytest.mark.parametrize("metric", [COSINE, DOT, EUCLIDEAN])
@pytest.mark.parametrize("batch", [7, 100, 3000])
def test_large_random(metric, batch, monkeypatch):
    monkeypatch.setattr(topk, "TILE_CELLS", 5000)
    monkeypatch.setattr(topk, "BUFFER_ROWS", 50)
    rng = np.random.default_rng(3)
    x, queries = rng.normal(size=(3000, 24)).astype(np.float32), rng.normal(size=(9, 24)).astype(np.float32)
    hits = run(queries, [10] * 9, [metric] * 9, [-np.inf] * 9, list(range(3000)), x, batch)
    for i in range(9):
        assert set(hits[i]) == set(brute(queries[i], 10, metric, -np.inf, range(3000), x))


def test_a_third_of_rows_are_copies(monkeypatch):
    monkeypatch.setattr(topk, "BUFFER_ROWS", 100)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 8)).astype(np.float32)
    x[::3] = x[0]
    hits = run(x[:2], [5, 5], [COSINE, EUCLIDEAN], [-np.inf] * 2, list(range(3000)), x, 250)
    assert hits[0] == [0, 3, 6, 9, 12]
    assert set(hits[1]) == set(brute(x[1], 5, EUCLIDEAN, -np.inf, range(3000), x))


def test_nearly_equal_rows_far_from_the_origin():
    rng = np.random.default_rng(11)
    x = (1000 + rng.normal(size=(500, 16)) * 1e-2).astype(np.float32)
    for metric in (COSINE, DOT, EUCLIDEAN):
        hits = run(x[:3], [5] * 3, [metric] * 3, [-np.inf] * 3, list(range(500)), x, 64)
        for i in range(3):
            assert set(hits[i]) == set(brute(x[i], 5, metric, -np.inf, range(500), x))


def test_values_that_are_no_numbers():
    x = np.array([[1, 0], [np.nan, 0], [np.inf, 1], [0, 1], [3e38, 3e38], [0, 0]], dtype=np.float32)
    queries = np.array([[1, 1], [1, 0]], dtype=np.float32)
    for metric in (COSINE, DOT, EUCLIDEAN):
        hits = run(queries, [6, 6], [metric] * 2, [-np.inf] * 2, list(range(6)), x, 3)
        for i in range(2):
            assert set(hits[i]) == set(brute(queries[i], 6, metric, -np.inf, range(6), x))


def test_ragged_null_and_keyless_rows_are_refused():
    best = TopK(
        pa.table({"qid": [1], "qvec": lists(np.ones((1, 2))), "qk": [1], "qfloor": pa.array([None], pa.float64()), "qmetric": [0]}), 2
    )
    for vectors in ([[1.0, 2.0, 3.0]], [[1.0, None]]):
        with pytest.raises(ValueError):
            best.add(pa.array([1]), pa.array(vectors, type=pa.list_(pa.float32())), {})
    with pytest.raises(ValueError):
        best.add(pa.array([None], type=pa.int64()), lists(np.ones((1, 2))), {})
