"""Pairs of texts whose shingle sets are similar, found by MinHash and verified exactly.

The steps, for ``ngram_join`` (documents, word shingles) and ``line_dedup`` (lines, characters):

1. Equal texts become one class, with its number of copies, by 128 bits of content hash.
2. Each class has a MinHash signature; every long of it is the key of a band.
3. Classes that share a band key meet in cells of bounded size (large buckets are cut into blocks, and
   each pair of blocks is a cell). A cell compares signatures step by step, drops a pair as soon as the
   posterior chance of reaching the threshold is below the tolerance, and sends on only a forest that
   joins the surviving pairs: never more rows than the cell has.
4. Components of the forests hold every surviving pair. Their members come together once more, in
   cells again, now with their shingle sets: surviving pairs are verified exactly. A cell sends on, per
   class, how many rows it links to and a forest of the verified links.
5. Components of the verified forests are the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecframe.llm.common import batch_of, components, modest_batches, number_batches, small_side, stored, text_chunks, whole_runs
from vecframe.llm.shingles import least_matches, signatures

#: Classes in a block of a cell, and bytes of shingle sets in a block of a verifying cell.
BLOCK = 1024
BLOCK_BYTES = 24 * 1024 * 1024
STEPS = 4
#: Pairs of cells of up to so many rows are looked at together, about so many pairs, or elements of their sets, at a time.
SMALL_CELL = 64
PAIRS, ELEMENTS = 500_000, 4_000_000
#: Bytes of text that are hashed and signed together: larger arrays are new memory each time, which costs more than the arithmetic.
TEXT_BYTES = 1 << 16

Shingler = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def similar_classes(items: DataFrame, shingler: Shingler, *, rounds: int, threshold: float, tolerance: float, purpose: str, counted: bool = True) -> DataFrame:
    """``items`` are rows (c1, c2, text). Gives (c1, c2, copies, links, root), one row per text with shingles.

    ``links`` counts the rows of other texts that are similar, ``root`` is a number shared by all
    classes that links join. Without ``counted`` two texts that others have joined need not be compared,
    and ``links`` only tells whether there are any.
    """
    classes = _classes(items, shingler, rounds, purpose)
    modest_batches(items.sparkSession)
    wide = 16 * (rounds // 4)
    least = least_matches(threshold, tolerance, [4 * wide * (i + 1) // STEPS for i in range(STEPS)])
    with number_batches(items.sparkSession):
        drafts = components(_survivors(classes, least, purpose), f"{purpose}-drafts")
    found = stored(_verified(items, classes, drafts, shingler, rounds, least, threshold, purpose, counted), f"{purpose}-verified")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    with number_batches(items.sparkSession):
        roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), f"{purpose}-links")
    known = links.join(roots, links.rep == roots.node, "left").select("rep", "links", F.coalesce("root", "rep").alias("root"))
    return (
        classes.select("c1", "c2", "copies", "rep")
        .join(stored(known, f"{purpose}-known"), "rep", "left")
        .select("c1", "c2", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "rep").alias("root"))
    )


def _classes(items: DataFrame, shingler: Shingler, rounds: int, purpose: str) -> DataFrame:
    wide = 16 * (rounds // 4)
    schema = pa.schema([("c1", pa.int64()), ("c2", pa.int64()), ("n", pa.int64()), *((f"s{i}", pa.int64()) for i in range(wide))])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, bounds in text_chunks(batch.column("text"), TEXT_BYTES):
                hashes, counts = shingler(data, bounds)
                some = counts > 0
                part = batch.slice(row, len(counts)).filter(pa.array(some))
                yield batch_of(schema, part.column("c1"), part.column("c2"), counts[some], *signatures(hashes, counts, rounds)[some].T)

    signed = items.select("c1", "c2", "text").mapInArrow(sign, ", ".join(f"{f.name} long" for f in schema))
    same = signed.groupBy("c1", "c2").agg(F.count("*").alias("copies"), F.max("n").alias("n"), *(F.max(f"s{i}").alias(f"s{i}") for i in range(wide)))
    return stored(same.withColumn("rep", F.monotonically_increasing_id()), f"{purpose}-classes")


def _survivors(classes: DataFrame, least: list[int], purpose: str) -> DataFrame:
    """Edges (a, b) that join the pairs which share a band key and survive the comparison of signatures."""
    sig = [c for c in classes.columns if c[0] == "s"]
    keys = classes.select("rep", F.posexplode(F.array(*sig)).alias("band", "value")).select(F.xxhash64("band", "value").alias("key"), "rep")
    members = keys.repartition("key").sortWithinPartitions("key").mapInArrow(_shared_keys, "key long, rep long, block int")
    members = stored(members.dropDuplicates(["key", "rep"]), f"{purpose}-members")
    last = members.where("block > 0").groupBy("key").agg(F.max("block").alias("last"))
    cells = (
        members.join(last, "key", "left")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("last", F.lit(0)))))
        .select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("cell"), (F.col("block") > F.col("other")).cast("int").alias("side"), (F.col("block") != F.col("other")).alias("mixed"), "rep")
        .join(classes.select("rep", F.array(*sig).alias("sig")), "rep")
    )
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in whole_runs(batches, "cell"):
            rep, side, mixed = (rows.column(c).to_numpy() for c in ("rep", "side", "mixed"))
            values = _values(rows.column("sig"), len(sig))
            together = [_pairs_alike(values, a, b, least) for a, b in _small_pairs(bounds, side, mixed)]
            edges = [np.stack([rep, rep[_labels(len(rep), together)]])]
            for start, end in _large_cells(bounds):
                forest = Forest(end - start)
                for i in range(start, end - 1):
                    others = _partners(i, end, side, mixed)
                    near = _alike(values, i, others[forest.apart(i - start, others - start)], least)
                    forest.join(i - start, near - start)
                edges.append(np.stack([rep[start:end], rep[start + forest.label]]))
            both = np.concatenate(edges, axis=1)
            yield batch_of(schema, *both[:, both[0] != both[1]])

    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(compare, "a long, b long")


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of keys that several classes have, in blocks.

    A key's members are named by a sum of hashes of them, so that bands with the same members make one
    bucket. A longer run than BLOCK keeps its own key, and passes through in pieces.
    """
    from vecframe.llm.shingles import mix

    schema = pa.schema([("key", pa.int64()), ("rep", pa.int64()), ("block", pa.int32())])
    held_key, held, place = None, np.zeros(0, np.int64), 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, reps = (batch.column(c).to_numpy() for c in ("key", "rep"))
        if held_key is not None:
            keys, reps = np.concatenate((np.full(len(held), held_key), keys)), np.concatenate((held, reps))
        cut = int(np.searchsorted(keys, keys[-1]))
        if place and cut:  # the long run that began in earlier batches ends here
            end = int(np.searchsorted(keys, keys[0], "right"))
            yield batch_of(schema, keys[:end], reps[:end], (place + np.arange(end)) // BLOCK)
            keys, reps, cut, place = keys[end:], reps[end:], cut - end, 0
        starts = np.flatnonzero(np.concatenate(([True], keys[1:cut] != keys[: cut - 1]))) if cut else np.zeros(0, int)
        if cut:
            sizes = np.diff(np.append(starts, cut))
            many = np.repeat(sizes > 1, sizes)
            name = np.repeat(np.add.reduceat(mix(reps[:cut].astype(np.uint64)), starts), sizes).view(np.int64)
            at = np.arange(cut) - np.repeat(starts, sizes)
            name = np.where(np.repeat(sizes > BLOCK, sizes), keys[:cut], name)
            yield batch_of(schema, name[many], reps[:cut][many], at[many] // BLOCK)
        held_key, held = keys[-1], reps[cut:]
        if len(held) > BLOCK:
            yield batch_of(schema, keys[cut:], held, (place + np.arange(len(held))) // BLOCK)
            place, held = place + len(held), held[:0]
    if len(held) > 1 or place and len(held):
        yield batch_of(schema, np.full(len(held), held_key), held, (place + np.arange(len(held))) // BLOCK)


def _verified(items, classes, drafts, shingler, rounds, least, threshold, purpose, counted=True) -> DataFrame:
    """Rows (rep, links, root) of each verifying cell; ``root`` is the smallest class its links reach there."""
    drafted = stored(drafts.join(classes, drafts.node == classes.rep).select("rep", F.col("root").alias("draft"), "c1", "c2", "copies", "n"), f"{purpose}-drafted")
    blocks = drafted.groupBy("draft").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") * 8 / BLOCK_BYTES)).cast("int").alias("blocks"))
    wanted = stored(drafted.join(blocks, "draft").drop("n"), f"{purpose}-wanted")
    texts = items.select("c1", "c2", "text").join(small_side(wanted, 56), ["c1", "c2"]).select("rep", "draft", "copies", "blocks", "text")
    cells = (
        texts.mapInArrow(_once_per_task, texts.schema)
        .withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select(F.xxhash64("draft", F.least("block", "other"), F.greatest("block", "other")).alias("cell"), (F.col("block") > F.col("other")).cast("int").alias("side"), (F.col("block") != F.col("other")).alias("mixed"), "rep", "copies", "text")
    )
    schema = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in whole_runs(batches, "cell"):
            rep = rows.column("rep").to_numpy()
            # A class's text can come from several tasks.
            first = np.flatnonzero(np.concatenate(([True], (rep[1:] != rep[:-1]) | (rows.column("cell").to_numpy()[1:] != rows.column("cell").to_numpy()[:-1]))))
            bounds, rows = np.searchsorted(first, bounds), rows.take(pa.array(first))
            hashes, counts = zip(*[shingler(data, ends) for _, data, ends in text_chunks(rows.column("text").combine_chunks(), TEXT_BYTES)], strict=True)
            values = np.concatenate([signatures(h, n, rounds) for h, n in zip(hashes, counts, strict=True)]).view(np.uint16)
            hashes, counts = np.concatenate(hashes), np.concatenate(counts)
            offsets = np.concatenate(([0], np.cumsum(counts)))
            rep, side, mixed, copies = (rows.column(c).to_numpy() for c in ("rep", "side", "mixed", "copies"))
            links, linked = np.zeros(len(rep), np.int64), []
            for a, b in _small_pairs(bounds, side, mixed):
                a, b = _verify_pairs(*_pairs_alike(values, a, b, least), hashes, counts, threshold)
                np.add.at(links, a, copies[b])
                np.add.at(links, b, copies[a])
                linked.append((a, b))
            root = rep[_labels(len(rep), linked)]
            for start, end in _large_cells(bounds):
                cell = slice(start, end)
                sets = [hashes[a:b] for a, b in zip(offsets[start:end], offsets[start + 1 : end + 1], strict=True)]
                links[cell], label = _verify_cell(sets, values[cell], side[cell], mixed[cell], copies[cell], least, threshold, counted)
                root[cell] = rep[start + label]
            yield batch_of(schema, rep, links, root)

    return cells.repartition("cell").sortWithinPartitions("cell", "rep").mapInArrow(verify, "rep long, links long, root long")


def _once_per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    for batch in batches:
        yield batch.take(pa.array([i for i, r in enumerate(batch.column("rep").to_numpy().tolist()) if not (r in seen or seen.add(r))], pa.int64()))


def _distinct(values: np.ndarray) -> np.ndarray:
    """The different values, sorted. ``np.unique`` hashes them first, which takes many times as long."""
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


def _verify_pairs(a: np.ndarray, b: np.ndarray, hashes: np.ndarray, counts: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs of rows (a, b) whose sets of hashes reach the threshold. ``hashes`` are the rows' own, ``counts`` of each."""
    if not len(a):
        return a, b
    used = np.zeros(len(counts), bool)
    used[a] = used[b] = True
    wanted = hashes[np.repeat(used, counts)]
    order = np.argsort(wanted)
    ranks = wanted[order]
    place = np.empty(len(wanted), np.int64)
    place[order] = np.cumsum(np.concatenate(([False], ranks[1:] != ranks[:-1])))
    names = place[order[-1]] + 1
    # A number per row and different hash: sorted, so that a row's are together and any can be looked up.
    members = _distinct(np.repeat(np.flatnonzero(used), counts[used]) * names + place)
    first = np.searchsorted(members, np.arange(len(counts) + 1) * names)
    sizes = np.diff(first)
    less, more = np.where(sizes[a] <= sizes[b], a, b), np.where(sizes[a] <= sizes[b], b, a)
    ends, at, shared = np.cumsum(sizes[less]), 0, np.zeros(len(a), np.int64)
    while at < len(a):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + ELEMENTS)))
        many = sizes[less[at:to]]
        starts = np.cumsum(many) - many
        own = members[np.repeat(first[less[at:to]] - starts, many) + np.arange(many.sum())]
        wanted = own + np.repeat((more[at:to] - less[at:to]) * names, many)
        found = members[np.minimum(np.searchsorted(members, wanted), len(members) - 1)] == wanted
        shared[at:to] = np.add.reduceat(found, starts, dtype=np.int64)
        at = to
    similar = shared >= threshold * (sizes[a] + sizes[b] - shared) - 1e-9
    return a[similar], b[similar]


def _verify_cell(sets, values, side, mixed, copies, least, threshold, counted) -> tuple[np.ndarray, np.ndarray]:
    """How many rows each member links to, and the labels of the components of these links."""
    n = len(sets)
    links, forest, unique = np.zeros(n, np.int64), Forest(n), {}
    for i in range(n - 1):
        others = _partners(i, n, side, mixed)
        others = _alike(values, i, others if counted else others[forest.apart(i, others)], least)
        if len(others):
            unique |= {j: _distinct(sets[j]) for j in (i, *others.tolist()) if j not in unique}
            shared = _shared(unique, i, others)
            sizes = np.array([len(unique[j]) for j in others.tolist()])
            others = others[shared >= threshold * (len(unique[i]) + sizes - shared) - 1e-9]
            links[i] += copies[others].sum()
            links[others] += copies[i]
            forest.join(i, others)
    return links, forest.label


def _shared(unique: dict[int, np.ndarray], i: int, others: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of set i with each of the others, looked up together."""
    own = unique[i]
    both = np.concatenate([unique[j] for j in others.tolist()])
    at = np.minimum(np.searchsorted(own, both), len(own) - 1)
    return np.add.reduceat(own[at] == both, np.cumsum([0, *(len(unique[j]) for j in others.tolist()[:-1])]), dtype=np.int64)


class Forest:
    """Labels of the components of a cell; a label is the place of the component's first member."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def apart(self, i: int, others: np.ndarray) -> np.ndarray:
        """Which of ``others`` nothing has joined with i."""
        return self.label[others] != self.label[i]

    def join(self, i: int, others: np.ndarray) -> None:
        if len(others):
            old = _distinct(np.append(self.label[others], self.label[i]))
            if len(old) > 1:
                self.label[np.isin(self.label, old)] = old[0]


def _values(column: pa.ChunkedArray, wide: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(-1, wide).view(np.uint16)


def _partners(i: int, end: int, side: np.ndarray, mixed: np.ndarray) -> np.ndarray:
    later = np.arange(i + 1, end)
    return later[side[i + 1 : end] != side[i]] if mixed[i] else later


def _small_pairs(bounds: np.ndarray, side: np.ndarray, mixed: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows (a, b), a before b, to compare in cells of at most SMALL_CELL rows, about PAIRS at a time."""
    sizes = np.diff(bounds)
    for size in np.unique(sizes[(sizes > 1) & (sizes <= SMALL_CELL)]).tolist():
        i, j = np.triu_indices(size, 1)
        starts, step = bounds[:-1][sizes == size], max(1, PAIRS // len(i))
        for at in range(0, len(starts), step):
            a, b = ((starts[at : at + step, None] + x).ravel() for x in (i, j))
            meet = ~mixed[a] | (side[a] != side[b])
            yield a[meet], b[meet]


def _large_cells(bounds: np.ndarray) -> list[tuple[int, int]]:
    return [(start, end) for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True) if end - start > SMALL_CELL]


def _labels(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n rows the first row of its component by the pairs."""
    label = np.arange(n)
    if not pairs:
        return label
    a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
    while True:
        low, before = np.minimum(label[a], label[b]), label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def _pairs_alike(values: np.ndarray, a: np.ndarray, b: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of rows (a, b) those that no step of the comparison has dropped."""
    step = values.shape[1] // len(least)
    equal = np.zeros(len(a), np.int64)
    for s, need in enumerate(least):
        equal += np.count_nonzero(values[a, s * step : (s + 1) * step] == values[b, s * step : (s + 1) * step], axis=1)
        keep = equal >= need
        a, b, equal = a[keep], b[keep], equal[keep]
    return a, b


def _alike(values: np.ndarray, i: int, others: np.ndarray, least: list[int]) -> np.ndarray:
    """Those of ``others`` that no step of the comparison has dropped."""
    step = values.shape[1] // len(least)
    equal = np.zeros(len(others), np.int64)
    for s, need in enumerate(least):
        at = slice(s * step, (s + 1) * step)
        equal += np.count_nonzero(values[others, at] == values[i, at], axis=1)
        keep = equal >= need
        if not keep.all():
            others, equal = others[keep], equal[keep]
        if not len(others):
            break
    return others
