"""Pairs of similar texts, lines and vectors, against brute force."""

import collections
import functools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vecframe.llm import line_dedup as line_dedup_module
from vecframe.llm import near, near_vectors as vectors
from vecframe.llm.common import components, modest_batches, number_batches, text_chunks
from vecframe.llm.line_dedup import line_dedup
from vecframe.llm.ngram_join import ngram_join
from vecframe.llm.shingles import BINS, ROUNDS, _donors, char_shingles, least_matches, signatures, word_shingles

DOCS = "doc_id long, text string, source string, rep int, draft string"


def joined(pairs, n):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def similar_pairs(sets, threshold=0.8):
    return [(a, b) for b in range(len(sets)) for a in range(b) if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9]


def word_set(text, size=5):
    words = (text or "").split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    out = []
    for _ in range(25):
        base = [word() for _ in range(rng.choice([1, 3, 5, 8, 40, 120, 400]))]
        out.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            other = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 25)):
                other[rng.randrange(len(other))] = word()
            out.append(rng.choice([" ", "  ", "\n"]).join(other))
    return out + ["", None, "   ", "é è ê ö ü", "é è ê ö ü"]


def test_ngram_join_is_brute_force(spark, texts):
    rows = [(i, t, "s", i, "x") for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in ngram_join(spark.createDataFrame(rows, DOCS)).collect()}
    sets = [word_set(t) for t in texts]
    pairs = similar_pairs(sets)
    links, root = collections.Counter(x for p in pairs for x in p), joined(pairs, len(texts))
    assert {i: (r.n_links, r.class_id) for i, r in got.items()} == {i: (links[i], root[i]) for i in range(len(texts))}
    assert all(r.kept == (r.class_id == i) for i, r in got.items())


def test_cells_cut_into_blocks_give_the_same(spark, texts, monkeypatch):
    rows = spark.createDataFrame([(i, t, "s", i, "x") for i, t in enumerate(texts)], DOCS)
    whole = sorted(ngram_join(rows).collect())
    monkeypatch.setattr(near, "BLOCK", 2)
    assert near._shared_keys.__globals__["BLOCK"] == 2
    keys = pa.RecordBatch.from_arrays([pa.array([1, 1, 1, 2, 3, 3], pa.int64()), pa.array([1, 2, 3, 4, 5, 6], pa.int64())], names=["key", "rep"])
    more = pa.RecordBatch.from_arrays([pa.array([3, 3, 4], pa.int64()), pa.array([7, 8, 9], pa.int64())], names=["key", "rep"])
    out = pa.Table.from_batches(list(near._shared_keys(iter([keys, more])))).to_pylist()
    assert [(r["rep"], r["block"]) for r in out] == [(1, 0), (2, 0), (3, 1), (5, 0), (6, 0), (7, 1), (8, 1)]
    items = rows.select(F.xxhash64("text").alias("c1"), F.xxhash64(F.lit(7), "text").alias("c2"), "text")
    shingler = functools.partial(word_shingles, size=5)
    classes = near._classes(items, shingler, 8, "t")
    least = least_matches(0.8, 1e-8, [32, 64, 96, 128])
    # Executors keep their own BLOCK, so blocks are set here by hand: every class alone in a block.
    drafts = components(near._survivors(classes, least, "t"), "t")
    found = near._verified(items, classes, drafts, shingler, 8, least, 0.8, "t")
    assert found.groupBy("rep").agg(F.sum("links")).count() > 0
    assert sorted(ngram_join(rows).collect()) == whole


def test_ngram_join_cases(spark):
    long = " ".join(str(i % 977) for i in range(30_000))
    rows = [(1, "a b c d e f", "s", 0, ""), (1, "a b c d e f", "s", 0, ""), (None, "a b c d e f", None, None, None), (2, long, "s", 0, ""), (3, long + " x", "s", 0, ""), (4, "", "s", 0, ""), (5, None, "s", 0, "")]
    got = [tuple(r) for r in ngram_join(spark.createDataFrame(rows, DOCS)).collect()]
    assert sorted(r[1:] for r in got if r[0] == 1) == [(2, 1, False), (2, 1, True)]
    assert sorted(r for r in got if r[0] != 1 and r[0] is not None) == [(2, 1, 2, True), (3, 1, 2, False), (4, 0, 4, True), (5, 0, 5, True)]
    assert [r for r in got if r[0] is None] == [(None, 2, 1, False)]
    assert ngram_join(spark.createDataFrame([], DOCS)).collect() == []


def test_ngram_join_on_a_large_group(spark):
    """1500 different texts that are all alike, and 500 copies of one: counts, with cells of several blocks."""
    rng = random.Random(1)
    base = [str(rng.randrange(10**6)) for _ in range(200)]
    rows = []
    for i in range(1500):
        words = list(base)
        words[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(words), "s", 0, ""))
    rows += [(10_000 + i, " ".join(base), "s", 0, "") for i in range(500)]
    got = ngram_join(spark.createDataFrame(rows, DOCS)).agg(F.min("n_links"), F.max("n_links"), F.max("class_id"), F.sum(F.col("kept").cast("int"))).first()
    assert tuple(got) == (1999, 1999, 0, 1)


def test_components_both_ways(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(1, 50)]
    df = spark.createDataFrame(edges, "a long, b long")
    few = sorted(map(tuple, components(df, "t").collect()))
    assert few == sorted(map(tuple, components(df, "t", few_edges=0).collect()))
    root = joined([e for e in edges], 6000)
    assert few == sorted((x, root[x]) for x in {x for e in edges if e[0] != e[1] for x in e})
    assert components(df.limit(0), "t").collect() == []


def test_signatures_estimate_similarity():
    rng = random.Random(3)
    base = [str(rng.randrange(10**9)) for _ in range(2000)]
    for share in (0.5, 0.8, 0.95):
        other = base[: int(2000 * 2 * share / (1 + share))] + [str(rng.randrange(10**9)) for _ in range(2000 - int(2000 * 2 * share / (1 + share)))]
        for _, data, bounds in text_chunks(pa.array([" ".join(base), " ".join(other)])):
            sig = signatures(*word_shingles(data, bounds, 1), 32).view(np.uint16)
        assert abs((sig[0] == sig[1]).mean() - share) < 0.08


def test_posterior_bounds():
    # Beta(k + 1, n - k + 1) by numeric integration.
    x = np.linspace(0, 1, 200_001)
    for n, least in zip([8, 32, 128], least_matches(0.8, 1e-6, [8, 32, 128]), strict=True):
        for k, keep in ((least, True), (least - 1, False)):
            if k >= 0:
                density = x**k * (1 - x) ** (n - k)
                assert (density[x >= 0.8].sum() / density.sum() >= 1e-6) == keep


def test_line_dedup_is_brute_force(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghé") for _ in range(rng.randint(1, 7)))
    pool = []
    for _ in range(25):
        line = " ".join(word() for _ in range(rng.choice([1, 2, 6, 20, 60])))
        pool += [line, line, "  " + line + " ", line + " end", line.replace("a", "b", 1), ""]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 8)))) for i in range(60)]
    rows = [(i, t, "s", 0, "") for i, t in docs] + [(7, docs[7][1], "t", 1, ""), (500, None, "s", 0, ""), (None, pool[0], "s", 0, "")]
    got = line_dedup(spark.createDataFrame(rows, DOCS)).collect()
    by_key = sorted(range(len(rows)), key=lambda x: (rows[x][0] is not None, rows[x][0] or 0, x))
    lines = [(x, n, l.strip(" ")) for x in by_key if rows[x][1] is not None for n, l in enumerate(rows[x][1].split("\n"))]
    sets = [{l[i : i + 7] for i in range(max(1, len(l) - 6))} if l else set() for _, _, l in lines]
    root = joined(similar_pairs(sets), len(lines))
    dropped = collections.defaultdict(list)
    for x, (i, n, _) in enumerate(lines):
        if root[x] != x:
            dropped[i].append(n)
    wanted = []
    for x, (i, text, *_) in enumerate(rows):
        parts = text.split("\n") if text is not None else []
        left = "\n".join(p for n, p in enumerate(parts) if n not in dropped[x]) if text is not None else None
        wanted.append((i, len(parts), len(parts) - len(dropped[x]), tuple(dropped[x]), left))
    assert collections.Counter((r.doc_id, r.n_lines, r.n_kept, tuple(r.dropped), r.text) for r in got) == collections.Counter(wanted)
    assert line_dedup(spark.createDataFrame([], DOCS)).collect() == []


def test_a_line_of_repeated_rows_stays_once(spark, monkeypatch):
    monkeypatch.setattr(line_dedup_module, "COPIES", 3)
    long = "a very long line " * 20_000
    rows = [(1, "one line of text\n\n tail", "s", 0, "")] * 11 + [(2, "one line of text", "s", 0, ""), (None, None, "s", 0, ""), (None, None, "s", 0, ""), (3, long, "s", 0, ""), (4, long, "s", 0, "")]
    got = line_dedup(spark.createDataFrame(rows, DOCS).repartition(5)).collect()
    wanted = [(1, (), rows[0][1])] + [(1, (0, 2), "")] * 10 + [(2, (0,), ""), (None, (), None), (None, (), None), (3, (), long), (4, (0,), "")]
    assert collections.Counter((r.doc_id, tuple(r.dropped), r.text) for r in got) == collections.Counter(wanted)
    assert sum(r.n_kept for r in got) == 3 + 10 + 1


def test_char_shingles_count_code_points():
    for _, data, bounds in text_chunks(pa.array(["ééé", "", "abcdefgh", None, "日本語日本語日本語"])):
        assert char_shingles(data, bounds, 7)[1].tolist() == [1, 0, 2, 0, 3]


VECTORS = "vec_id long, embedding array<float>, label int, rep int, key long"


def test_near_vectors_are_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = []
    for group in range(40):
        base = rng.standard_normal(64)
        for _ in range(rng.integers(1, 8)):
            noise = rng.standard_normal(64)
            rows.append((base + noise * np.linalg.norm(base) / np.linalg.norm(noise) * rng.uniform(0, 0.25), int(group % 3)))
    data = [(i, [float(x) for x in np.float32(v)], label, 0, 0) for i, (v, label) in enumerate(rows)]
    n = len(data)
    data += [(n, None, 1, 0, 0), (n + 1, [0.0] * 64, 1, 0, 0), (n + 2, data[0][1], None, 0, 0), (n + 3, [float("nan")] * 64, 1, 0, 0), (n + 4, data[0][1], data[0][2], 0, 0), (n + 5, [1.0, None], 1, 0, 0), (n + 6, [2.0, 1.0], 1, 0, 0), (n + 7, [4.0, 2.0], 1, 0, 0), (n + 8, [], 1, 0, 0)]
    got = {r.vec_id: r for r in vectors.near_vectors(spark.createDataFrame(data, VECTORS)).collect()}
    unit = lambda v: np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64))
    good = {i: unit(v) for i, v, label, *_ in data if v and label is not None and None not in v and np.isfinite(v).all() and any(v)}
    pairs = [(a, b) for b in good for a in good if a < b and data[a][2] == data[b][2] and len(good[a]) == len(good[b]) and good[a] @ good[b] >= 0.98]
    assert len(pairs) > 50
    links, root = collections.Counter(x for p in pairs for x in p), joined(pairs, len(data))
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in got.items()} == {i: (links[i], root[i], root[i] == i) for i in range(len(data))}
    assert vectors.near_vectors(spark.createDataFrame([], VECTORS)).collect() == []


def test_e8_points_are_nearest():
    rng = np.random.default_rng(7)
    x = rng.standard_normal((200, 8)) * 2
    points = vectors.e8_points(x)
    doubled = np.rint(2 * points).astype(int)
    assert ((doubled % 2 == doubled[:, :1] % 2).all(axis=1) & (points.sum(axis=1) % 2 == 0)).all()
    assert len(np.unique(vectors.ROOTS, axis=0)) == 240 and np.allclose((vectors.ROOTS**2).sum(axis=1), 2)
    own = ((x - points) ** 2).sum(axis=1)
    around = ((x[:, None] - points[:, None] - vectors.ROOTS[None]) ** 2).sum(axis=2).min(axis=1)
    assert (own <= around + 1e-9).all()


def test_lattice_recall(spark, small):
    """Found links of close pairs on random directions, against all pairs."""
    rng = np.random.default_rng(9)
    base = rng.standard_normal((1500, 64))
    noise = rng.standard_normal((1500, 64))
    near_ = base + noise / np.linalg.norm(noise, axis=1, keepdims=True) * np.linalg.norm(base, axis=1, keepdims=True) * 0.2
    units = [v / np.linalg.norm(v, axis=1, keepdims=True) for v in (base, near_)]
    keys = [vectors.lattice_keys(u) for u in units]
    close = (units[0] * units[1]).sum(axis=1) >= 0.98
    found = np.array([len(np.intersect1d(a, b)) > 0 for a, b in zip(*keys, strict=True)])
    assert found[close].mean() > 0.99


def test_line_dedup_reads_each_document_twice(spark):
    """Once to split it, once for the result; rows that are equal are found among the stored lines."""
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    rows = [(i, None if i == 3 else f"line number {i} of its own\n\nthe line that all have", "s", 0, "") for i in range(10)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("text", F.udf(seen).asNondeterministic()("text"))
    assert {r.doc_id: (r.n_lines, r.n_kept, r.dropped) for r in line_dedup(docs).collect()} == {i: (0, 0, []) if i == 3 else (3, 3, []) if i == 0 else (3, 2, [2]) for i in range(10)}
    assert read.value == 2 * len(rows)


def test_every_space_at_the_ends_of_lines_is_cut(spark):
    line = "one line, with \t spaces inside"
    rows = [(0, line, "s", 0, "")] + [(i, t, "s", 0, "") for i, t in enumerate([s + line for s in " \t\v\f\r"] + [line + s for s in " \t\v\f\r"] + [" \r" + line + "\t \r", "\xa0"], 1)]
    got = {r.doc_id: (r.n_lines, tuple(r.dropped)) for r in line_dedup(spark.createDataFrame(rows, DOCS), threshold=1.0).collect()}
    assert got == {i: (1, () if i in (0, len(rows) - 1) else (0,)) for i in range(len(rows))}


def test_rows_of_numbers_go_to_python_in_large_batches(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())})

    counted = lambda: [r.n for r in spark.range(0, 5000, 1, 1).mapInArrow(sizes, "n long").collect()]
    modest_batches(spark)
    with number_batches(spark):
        assert counted() == [5000]
    assert counted() == [1000] * 5
    with pytest.raises(KeyError), number_batches(spark):
        raise KeyError
    assert counted() == [1000] * 5


def test_signatures_are_those_of_plain_loops():
    rng = random.Random(9)
    texts = ["", "a", "abcdefgh", "日本語日本語日本語", "", *("".join(rng.choice("abcé ") for _ in range(n)) for n in (9, 15, 40, 300))]
    whole = pa.array(texts)
    parts = [(data, bounds) for _, data, bounds in text_chunks(whole, 16)]
    assert len(parts) > 3
    small = np.concatenate([signatures(*char_shingles(data, bounds, 7), 8) for data, bounds in parts])
    [(_, data, bounds)] = text_chunks(whole)
    hashes, counts = char_shingles(data, bounds, 7)
    assert (signatures(hashes, counts, 8) == small).all()
    wanted = np.zeros((len(texts), 2, BINS, 4), np.uint16)
    ends = np.cumsum(counts)
    for t, r in ((t, r) for t in range(len(texts)) if counts[t] for r in range(8)):
        bins = {}
        for h in hashes[ends[t] - counts[t] : ends[t]].tolist():
            x = h * int(ROUNDS[r]) % 2**64
            bins[x >> 60] = min(bins.get(x >> 60, 2**32), x >> 24 & 0xFFFFFFFF)
        for b in range(BINS):
            wanted[t, r // 4, b, r % 4] = bins[b if b in bins else next(d for d in _donors(r)[b].tolist() if d in bins)] & 0xFFFF
    assert (small.view(np.uint16).reshape(wanted.shape) == wanted).all()
