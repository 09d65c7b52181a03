"""Balanced shards, clusters and vector codes, against brute force."""

import hashlib
import heapq
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vecframe.llm import common
from vecframe.llm.balanced_shards import Scheduler, document_shards, write_document_shards
from vecframe.llm.centroid_clusters import centroid_clusters, described_clusters
from vecframe.llm.vector_codes import assign, described_codes, reassign
from vecframe.llm.whole_vectors import packed, squares, unpacked

DOCS = "doc_id long, text string, shard string, size string, at long, copies int"
VECTORS = "vec_id long, embedding array<double>, label int, cluster string, id int, code string"


# --- shards -------------------------------------------------------------------------------------


def one_by_one(sizes, shards):
    """Loads of the shards after the largest-first rule, one group at a time."""
    heap = [(0, s) for s in range(shards)]
    for size in sorted(sizes, reverse=True):
        load, shard = heapq.heappop(heap)
        heapq.heappush(heap, (load + size, shard))
    return [load for load, _ in sorted(heap, key=lambda x: x[1])]


@given(st.lists(st.tuples(st.integers(1, 60), st.integers(1, 300)), max_size=12), st.integers(1, 9))
@settings(deadline=None, max_examples=150)
def test_runs_of_equal_sizes_are_dealt_as_one_by_one(runs, shards):
    counts = Counter()
    for size, n in runs:
        counts[size] += n
    scheduler = Scheduler(shards)
    for size in sorted(counts, reverse=True):
        assert sum(scheduler.deal(size, counts[size])) == counts[size]
    assert [load for load, _ in sorted(scheduler.heap, key=lambda x: x[1])] == one_by_one(Counter(counts).elements(), shards)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    out = ["".join(rng.choice("ab é\n") for _ in range(rng.randint(0, 60))) for _ in range(700)]
    return out + ["hot copy of a text"] * 500 + ["x" * 200_000, None, "", None]


def sharded(spark, texts, **options):
    docs = spark.createDataFrame([(i if i % 50 else None, t, "s", "z", 1, 2) for i, t in enumerate(texts)], DOCS).repartition(7)
    return document_shards(docs, **options).toPandas()


@pytest.mark.parametrize("limit", [common.BROADCAST_BYTES, 0])
def test_shards_follow_the_rule(spark, texts, limit, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", limit)  # 0: nothing fits, so the few large groups travel and the rest meets by shuffle
    got = sharded(spark, texts, shards=6)
    assert sorted(got.columns) == ["doc_id", "grown_shard", "law", "shard", "size", "slot", "text_crc32"]
    assert len(got) == len(texts) and set(got["law"]) == {"bytes"} and got["grown_shard"].isna().all()
    wanted = Counter((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for t in texts)
    assert Counter(zip(got["size"], got["text_crc32"])) == wanted
    assert got.groupby("text_crc32")["shard"].nunique().max() == 1
    groups = defaultdict(int)
    for t in texts:
        groups[t or ""] += len((t or "").encode()) + 16
    loads = got.groupby("shard")["size"].sum().reindex(range(6), fill_value=0)
    assert sorted(loads) == sorted(one_by_one(groups.values(), 6))
    for _, slots in got.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))


def test_shards_are_near_equal_and_repeat(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    one, two = (document_shards(docs, shards=5).toPandas().sort_values("doc_id").reset_index(drop=True) for _ in range(2))
    assert one.equals(two)
    loads = one.groupby("shard")["size"].sum()
    assert loads.max() <= loads.mean() * 1.05


def test_shards_of_few_rows(spark):
    empty = spark.createDataFrame([], DOCS)
    assert document_shards(empty).count() == 0
    one = document_shards(spark.createDataFrame([(None, None, "s", "z", 1, 2)], DOCS)).collect()
    assert [(r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in one] == [(None, 16, 0, 0, 0)]


def test_shards_are_written_in_slot_order(spark, texts, tmp_path):
    docs = spark.createDataFrame([(i, t, "s", "z", 1, 2) for i, t in enumerate(texts)], DOCS)
    write_document_shards(docs, str(tmp_path / "out"), shards=4, rows_per_file=100)
    back = spark.read.parquet(str(tmp_path / "out")).withColumn("file", F.input_file_name()).toPandas()
    assert dict(zip(back["doc_id"], back["text"])) == dict(enumerate(texts))
    for _, file in back.groupby("file"):
        assert list(file["slot"]) == sorted(file["slot"])
    assert (back.groupby(["shard", back["slot"] // 100])["file"].nunique() == 1).all()


# --- whole numbers ------------------------------------------------------------------------------


@given(st.lists(st.integers(-(2**40), 2**40), min_size=1, max_size=30))
def test_packing_round_trips(numbers):
    assert unpacked(packed(np.array(numbers)), len(numbers)).tolist() == numbers


@pytest.mark.parametrize("most", [5, 2**20, 2**27 - 1])
def test_squares_are_exact(most):
    rng = np.random.default_rng(most)
    x, c = rng.integers(-most, most + 1, (40, 16)), rng.integers(-most, most + 1, (9, 16))
    wanted = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, s)) for s in c] for r in x]
    assert squares(x, c).tolist() == wanted


# --- clusters -----------------------------------------------------------------------------------


def gap(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def lloyd(points, centres, rounds):
    for r in range(rounds + 1):
        best = [min((gap(p, c), i) for i, c in enumerate(centres)) for p in points]
        if r == rounds:
            return best, centres
        for i in range(len(centres)):
            own = [p for p, (_, at) in zip(points, best) if at == i]
            if own:
                centres = [*centres[:i], [sum(column) // len(own) for column in zip(*own)], *centres[i + 1 :]]
    return None


@pytest.fixture(scope="module")
def vectors():
    """Vectors of eight components on a coarse grid, so that ties are frequent, and broken ones."""
    rng = random.Random(4)
    rows = [(i, [rng.randint(-3, 3) / 4 for _ in range(8)], rng.choice([1, 2, None])) for i in range(700)]
    rows += [(i, rows[i][1], 1) for i in range(40)]  # repeated rows, and the same keys
    rows += [(900 + i, rows[0][1], 3) for i in range(400)]  # a hot vector
    rows += [(None, rows[3][1], 1), (None, rows[5][1], None)]
    nan, inf = float("nan"), float("inf")
    rows += [(2000, None, 1), (2001, [], 1), (2002, [None] + [0.0] * 7, 1), (2003, [nan] + [0.0] * 7, 1), (2004, [inf] + [0.0] * 7, 1), (2005, [0.5] * 6, 1), (2006, [0.0] * 8, None)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "c", 7, "d") for i, v, label in rows], VECTORS).repartition(5)


def test_clusters_are_brute_force(spark, vectors):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v, _ in vectors if usable(v) and len(v) == 8]
    mark = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "~"
    starts = [q for _, q in sorted(kept, key=lambda r: (mark(r[0]), r[1]))][:16]
    best, centres = lloyd([q for _, q in kept], starts, 3)
    got = described_clusters(frame(spark, vectors), dimension=8, width=3).toPandas()
    key = lambda i: -1 if i is None or i != i else int(i)
    assert Counter((key(i), c, d) for i, c, d in zip(got["vec_id"], got["cluster"], got["distance"])) == Counter((key(i), c, d) for (i, _), (d, c) in zip(kept, best))
    assert set(got["inertia"]) == {sum(d for d, _ in best)}
    for c, part in got.groupby("cluster"):
        assert set(part["cluster_inertia"]) == {sum(d for d, at in best if at == c)}
        assert set(part["centroid_sha256"]) == {hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()}


def test_clusters_of_few_rows(spark, vectors):
    assert described_clusters(frame(spark, [])).count() == 0
    assert described_clusters(frame(spark, [r for r in vectors if not usable(r[1])])).count() == 0
    found, centres = centroid_clusters(frame(spark, vectors[:3]), dimension=8)
    assert sorted(r.cluster for r in found.collect()) == [0, 1, 2] and centres.count() == 24


def test_cluster_tiles_stay_in_place(spark, vectors):
    """An update moves assignments to the tiles, not the tiles; no table is left behind."""
    from vecframe.llm import centroid_clusters as module

    whole = module.whole_numbers(frame(spark, vectors), key="vec_id", vector="embedding", scale=64).where("size(q) = 8")
    name = common.bucketed(whole.mapInArrow(module._cut(8, 4), "chunk long, block int, rows int, ids array<bigint>, data binary"), ["block", "chunk"], "tiles-test")
    try:
        near = spark.createDataFrame([], "chunk long, cluster array<int>, block int")
        plan = spark.table(name).join(near.hint("shuffle_merge"), ["block", "chunk"])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1
    finally:
        spark.sql(f"DROP TABLE {name}")
    described_clusters(frame(spark, vectors), dimension=8)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("cluster_tiles")]


# --- codes --------------------------------------------------------------------------------------


@given(st.integers(0, 2**32 - 1))
@settings(deadline=None, max_examples=60)
def test_active_entries_equal_a_full_scan(seed):
    rng = np.random.default_rng(seed)
    x, books = rng.integers(-2, 3, (60, 3, 2)), rng.integers(-2, 3, (3, 7, 2))
    moved = rng.random((3, 7)) < rng.choice([0.0, 0.3, 1.0])
    before = books.copy()
    before[moved] += rng.integers(-2, 3, before[moved].shape)
    entry, distance = reassign(x, books, (before != books).any(axis=2), *assign(x, before))
    wanted = assign(x, books)
    assert (entry == wanted[0]).all() and (distance == wanted[1]).all()


@pytest.mark.parametrize("limit", [common.BROADCAST_BYTES, 0])
def test_codes_are_brute_force(spark, vectors, limit, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
    usables = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in vectors if usable(v)]
    kept = [r for r in usables if len(r[1]) == 8]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:20]
    parts = [lloyd([q[2 * p : 2 * p + 2] for _, q, _ in kept], [q[2 * p : 2 * p + 2] for _, q, _ in first], 2) for p in range(4)]
    codes = ["".join(f"{parts[p][0][n][1]:02x}" for p in range(4)) for n in range(len(kept))]
    errors = [sum(parts[p][0][n][0] for p in range(4)) for n in range(len(kept))]
    of_label = defaultdict(int)
    for (_, _, label), e in zip(kept, errors):
        of_label[label] += e
    digest = hashlib.sha256(",".join(str(x) for p in range(4) for c in parts[p][1] for x in c).encode()).hexdigest()
    wanted = Counter((i, c, e, of_label[label], digest) for (i, _, label), c, e in zip(kept, codes, errors))
    wanted.update((i, None, None, of_label[label], digest) for i, q, label in usables if len(q) != 8)
    got = described_codes(frame(spark, vectors), parts=4, entries=20).collect()
    assert Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got) == wanted


def test_codes_of_few_rows(spark, vectors):
    assert described_codes(frame(spark, [])).count() == 0
    few = described_codes(frame(spark, vectors[:2]), parts=4).collect()
    assert sorted(r.code for r in few) == sorted(["00000000", "01010101"]) or vectors[0][1] == vectors[1][1]
    with pytest.raises(ValueError, match="equal parts"):
        described_codes(frame(spark, vectors[:2]), parts=3)


def test_components_out_of_range_are_refused(spark):
    with pytest.raises(Exception, match="too large"):
        described_codes(frame(spark, [(1, [1e30] * 8, 1)]), parts=4).count()
