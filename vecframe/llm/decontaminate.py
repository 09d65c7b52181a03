"""Documents that hold passages of a benchmark, words replaced included, found by spaced seeds."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecframe.llm.common import batch_of, join_counted, modest_batches, stored, text_chunks
from vecframe.llm.shingles import PLACES, ROUNDS, mix, span_hashes, word_spans

WINDOW = 13
SIMILARITY = 0.8
LEAST_WORDS = 5
#: Words of benchmark text that one task cuts into windows.
BLOCK_WORDS = 1_000_000
#: The filter has BITS_PER_SEED bits for each seed, but never more bytes than FILTER_BYTES: with more seeds it lets more through.
BITS_PER_SEED = 32
FILTER_BYTES = 32 * 1024 * 1024
PROBES = 3
#: Windows in one batch handed on.
BATCH_WINDOWS = 20_000
WINDOW_FIELDS = [("length", pa.int32()), ("w1", pa.int64()), ("w2", pa.int64()), ("words", pa.list_(pa.int64()))]


def seed_masks(window: int, misses: int) -> list[tuple[int, ...]]:
    """Fixed sets of places such that any ``misses`` places leave one set untouched.

    The window is cut into ``misses + 2`` pieces; two of them are clean, and each mask is a pair.
    """
    pieces = np.array_split(np.arange(window), misses + 2)
    return [tuple(int(p) for p in np.concatenate(pair)) for pair in combinations([p for p in pieces if len(p)], 2)] if misses else [tuple(range(window))]


def misses_of(length: int, similarity: float) -> int:
    """How many words of a window of ``length`` words may be replaced."""
    return length - math.ceil(similarity * length - 1e-9)


def window_seeds(place: Callable[[int], np.ndarray], length: int, similarity: float) -> Iterator[np.ndarray]:
    """For each mask the seeds of windows of ``length`` words; ``place(p)`` are the words at place ``p`` of all windows."""
    for number, mask in enumerate(seed_masks(length, misses_of(length, similarity))):
        total = place(mask[0]) * PLACES[0]
        for k, p in enumerate(mask[1:], 1):
            total = total + place(p) * PLACES[k]
        yield mix(total + np.uint64(length << 32 | number))


def window_keys(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of hash of each row of words."""
    length = windows.shape[1]
    return tuple(mix((windows * factors[:length]).sum(axis=1, dtype=np.uint64) + np.uint64(length)).view(np.int64) for factors in (PLACES, ROUNDS))


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", window: int = WINDOW, similarity: float = SIMILARITY, least_words: int = LEAST_WORDS, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row (key, contaminated, n_items, items, starts, ends, and the columns to ``carry``) per document.

    A document holds an item if a window of ``window`` words of the item (the whole item, if shorter)
    meets as many words of the document of which a share of ``similarity`` or more are equal, place
    by place; a short item may so have to occur as it is. ``items`` are the keys of the items, in order and each once; ``starts`` and ``ends``
    are the word ranges covered, joined where they overlap.

    Words are runs other than space and 09 to 0D, in lower case. Items of fewer than ``least_words``
    words match nothing (with 1, every item that has a word can match); null and empty texts match nothing. Rows with equal
    keys, or equal throughout, are rows of their own. A null item key is listed as null, first.
    Empty tables: no documents give no rows, no items give clean documents. Other columns are not read.

    Every window with up to ``window * (1 - similarity)`` replaced words shares a seed, so nothing is
    missed. A bit filter of all seeds, of bounded size, goes to the tasks; documents stay in place, and only their
    windows that pass it are written. The different ones among these meet the different windows of the benchmark by a
    join on the seed, which compares their words, and the windows found lead back to rows and items by joins.
    """
    spark = docs.sparkSession
    modest_batches(spark)
    rows = docs.select(
        F.col(key).alias("id"),
        *[F.col(c).alias(f"carried_{c}") for c in carry],
        F.lower(F.coalesce(F.col(text), F.lit(""))).alias("text"),
    )
    items = _item_windows(benchmark.select(F.col(item_key).alias("item"), F.lower(F.coalesce(F.col(item_text), F.lit(""))).alias("text")), window, least_words)
    wanted = stored(items.groupBy("w1", "w2").agg(F.any_value("length").alias("length"), F.any_value("words").alias("words")), "leak-item-windows")
    sizes = {r.length: r.n for r in wanted.groupBy("length").agg(F.count("*").alias("n")).collect()}
    bits = _filter_bits(sum(n * len(seed_masks(k, misses_of(k, similarity))) for k, n in sizes.items()))
    shared = spark.sparkContext.broadcast((sorted(sizes), _filter(wanted, bits, similarity), bits))

    fields = [f for f in rows.schema.fields if f.name != "text"]
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["at array<int>", "length array<int>", "spot array<int>", "words array<long>"])
    scanned = stored(rows.mapInArrow(_scan(shared, similarity), ddl).withColumn("row", F.monotonically_increasing_id()), "leak-scanned")
    passed = scanned.where(F.size("at") > 0).select("row", "at", "length", "spot", "words")
    seen = stored(_different_windows(passed, window).groupBy("w1", "w2").agg(F.sum("copies").alias("copies"), F.any_value("length").alias("length"), F.any_value("words").alias("words")), "leak-windows")
    pairs = stored(_pairs(seen, wanted, window, similarity), "leak-pairs")

    live = stored(pairs.select("w1", "w2", "copies").distinct(), "leak-live")
    found = stored(join_counted(_occurrences(passed), live, ["w1", "w2"]).select("row", "at", (F.col("at") + F.col("length")).alias("end"), "w1", "w2"), "leak-found")
    owners = items.select(F.col("w1").alias("i1"), F.col("w2").alias("i2"), "item").distinct()
    named = stored(pairs.join(owners, ["i1", "i2"]).select("w1", "w2", "copies", "item").distinct(), "leak-named")
    held = join_counted(found.select("row", "w1", "w2"), named, ["w1", "w2"]).select("row", "item").distinct()
    listed = held.groupBy("row").agg(F.transform(F.sort_array(F.collect_list(F.struct("item"))), lambda s: s.item).alias("items"))
    leaks = listed.join(_covered(found), "row")

    out = scanned.select("row", "id", *[f"carried_{c}" for c in carry]).join(leaks, "row", "left")
    full = [F.coalesce(c, F.array().cast(leaks.schema[c].dataType)).alias(c) for c in ("items", "starts", "ends")]
    out = out.select("id", *full, *[f"carried_{c}" for c in carry])
    return out.select(F.col("id").alias(key), (F.size("items") > 0).alias("contaminated"), F.size("items").cast("long").alias("n_items"), "items", "starts", "ends", *[F.col(f"carried_{c}").alias(c) for c in carry])


def _window_batches(words: np.ndarray, begins: np.ndarray, length: int, width: int) -> Iterator[tuple[np.ndarray, list]]:
    """Of the windows at ``begins`` in ``words``, some at a time: their numbers, and the arrays of WINDOW_FIELDS; words are padded to ``width``."""
    for start in range(0, len(begins), BATCH_WINDOWS):
        some = np.arange(start, min(start + BATCH_WINDOWS, len(begins)))
        taken = words[begins[some][:, None] + np.arange(length)]
        padded = np.zeros((len(some), width), np.int64)
        padded[:, :length] = taken.view(np.int64)
        offsets = np.arange(len(some) + 1, dtype=np.int32) * width
        yield some, [np.full(len(some), length, np.int32), *window_keys(taken), pa.ListArray.from_arrays(offsets, padded.ravel())]


def _item_windows(items: DataFrame, window: int, least_words: int) -> DataFrame:
    """Rows (item, length, w1, w2, words) of all windows of the items that have words enough."""
    total = items.agg(F.sum(F.size(F.split("text", r"[\x20\x09-\x0D]+")))).first()[0] or 0

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, bounds in text_chunks(batch.column("text")):
                starts, ends, text = word_spans(data, bounds)
                words = span_hashes(data, starts, ends)
                sizes = np.bincount(text, minlength=len(bounds) - 1)
                firsts = np.cumsum(sizes) - sizes
                lengths = np.minimum(sizes, window)
                for length in np.unique(lengths[sizes >= max(1, least_words)]).tolist():
                    of = np.flatnonzero((lengths == length) & (sizes >= least_words))
                    counts = sizes[of] - length + 1
                    owner = np.repeat(of, counts)
                    begins = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + firsts[owner]
                    for some, columns in _window_batches(words, begins, length, window):
                        item = batch.column("item").take(pa.array(row + owner[some]))
                        schema = pa.schema([("item", item.type), *WINDOW_FIELDS])
                        yield batch_of(schema, item, *columns)

    ddl = f"item {items.schema['item'].dataType.simpleString()}, length int, w1 long, w2 long, words array<long>"
    return stored(items.repartition(max(1, math.ceil(total / BLOCK_WORDS))).mapInArrow(cut, ddl), "leak-items")


def _filter_bits(seeds: int) -> int:
    """The filter's size as a power of two."""
    return max(10, min((8 * FILTER_BYTES).bit_length() - 1, (BITS_PER_SEED * seeds).bit_length()))


def _probes(seeds: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for k in range(PROBES):
        yield (seeds * ROUNDS[k]) >> np.uint64(64 - bits)


def _filter(windows: DataFrame, bits: int, similarity: float) -> np.ndarray:
    """The bits of all seeds of the windows, set in Spark; what comes to the driver has the filter's fixed size."""
    schema = pa.schema([("slot", pa.int64()), ("set", pa.int64())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << (bits - 6), np.uint64)
        for _, _, seeds, _ in _seeds_of(batches, similarity):
            for at in _probes(seeds, bits):
                np.bitwise_or.at(table, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
        slots = np.flatnonzero(table)
        for some in np.array_split(slots, len(slots) // 100_000 + 1):
            yield batch_of(schema, some, table[some].view(np.int64))

    set_bits = windows.mapInArrow(mark, "slot long, set long").groupBy("slot").agg(F.bit_or("set").alias("set")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[set_bits["slot"].to_numpy()] = set_bits["set"].to_numpy().view(np.uint64)
    return out


def _seeds_of(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, int]]:
    """For batches of windows of one width: the batch, the numbers of the windows of one length, their seeds by one mask, and the length."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = batch.column("length").to_numpy()
        words = batch.column("words").flatten().to_numpy().view(np.uint64).reshape(batch.num_rows, -1)
        for length in np.unique(lengths).tolist():
            of = np.flatnonzero(lengths == length)
            own = words[of]
            for seeds in window_seeds(lambda p, own=own: own[:, p], length, similarity):
                yield batch, of, seeds, length


def _scan(shared, similarity: float):
    """Windows of documents that pass the filter: where they begin, their lengths, and the words they cover, each once, with each window's first among them."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, table, bits = shared.value
        for batch in batches:
            for row, data, bounds in text_chunks(batch.column("text")):
                begins, ends, text = word_spans(data, bounds)
                words = span_hashes(data, begins, ends)
                found = [_passing(words, text, length, table, bits, similarity) for length in lengths]
                at = np.concatenate([np.zeros(0, np.int64), *found])
                length = np.concatenate([np.zeros(0, np.int64), *[np.full(len(f), k) for f, k in zip(found, lengths, strict=True)]])
                order = np.argsort(at, kind="stable")
                at, length = at[order], length[order]
                steps = np.zeros(len(words) + 1, np.int64)
                np.add.at(steps, at, 1)
                np.add.at(steps, at + length, -1)
                covered = np.flatnonzero(np.cumsum(steps[:-1]))
                texts = len(bounds) - 1
                many, few = np.bincount(text[covered], minlength=texts), np.bincount(text[at], minlength=texts)
                first = np.searchsorted(text, text[at])
                spot = np.searchsorted(covered, at) - (np.cumsum(many) - many)[text[at]]
                part = batch.slice(row, texts)
                lists = [_lists(few, (at - first).astype(np.int32)), _lists(few, length.astype(np.int32)), _lists(few, spot.astype(np.int32)), _lists(many, words[covered].view(np.int64))]
                rest = [(n, part.column(n)) for n in part.schema.names if n != "text"]
                yield pa.RecordBatch.from_arrays([c for _, c in rest] + lists, names=[n for n, _ in rest] + ["at", "length", "spot", "words"])

    return scan


def _passing(words: np.ndarray, text: np.ndarray, length: int, table: np.ndarray, bits: int, similarity: float) -> np.ndarray:
    """Where windows of ``length`` words of one text begin that share a seed with the filter."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    inside = text[length - 1 :] == text[:n]
    hit = np.zeros(n, bool)
    for seeds in window_seeds(lambda p: words[p : p + n], length, similarity):
        at = np.flatnonzero(inside & ~hit)
        seeds = seeds[at]
        for k in range(PROBES):
            slot = (seeds * ROUNDS[k]) >> np.uint64(64 - bits)
            good = (table[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)
            at, seeds = at[good], seeds[good]
        hit[at] = True
    return np.flatnonzero(hit)


def _lists(counts: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(counts))).astype(np.int32), values)


def _expanded(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of rows of windows that passed, for each length: length, all words, where in them windows begin, numbers of the windows, numbers of their rows."""
    at, words = batch.column("at"), batch.column("words")
    owner = np.repeat(np.arange(batch.num_rows), at.value_lengths().to_numpy())
    many = words.value_lengths().to_numpy()
    first = (np.cumsum(many) - many)[owner] + batch.column("spot").flatten().to_numpy()
    lengths = batch.column("length").flatten().to_numpy()
    flat = words.flatten().to_numpy().view(np.uint64)
    for length in np.unique(lengths).tolist():
        of = np.flatnonzero(lengths == length)
        yield length, flat, first[of], of, owner[of]


def _different_windows(passed: DataFrame, window: int) -> DataFrame:
    """Rows (copies, length, w1, w2, words): the windows that passed, counted within a batch."""
    schema = pa.schema([("copies", pa.int64()), *WINDOW_FIELDS])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, flat, first, _, _ in _expanded(batch):
                for _, (lengths, w1, w2, words) in _window_batches(flat, first, length, window):
                    _, one, counts = np.unique(np.stack([w1, w2]), axis=1, return_index=True, return_counts=True)
                    yield batch_of(schema, counts, lengths[one], w1[one], w2[one], words.take(pa.array(one)))

    return passed.mapInArrow(windows, "copies long, length int, w1 long, w2 long, words array<long>")


def _occurrences(passed: DataFrame) -> DataFrame:
    """Rows (row, at, length, w1, w2) of all windows that passed."""
    schema = pa.schema([("row", pa.int64()), ("at", pa.int32()), *WINDOW_FIELDS[:3]])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at = batch.column("row").to_numpy(), batch.column("at").flatten().to_numpy()
            for length, flat, first, of, owner in _expanded(batch):
                for some, (lengths, w1, w2, _) in _window_batches(flat, first, length, length):
                    yield batch_of(schema, rows[owner[some]], at[of[some]], lengths, w1, w2)

    return passed.mapInArrow(windows, "row long, at int, length int, w1 long, w2 long")


def _seeded(windows: DataFrame, similarity: float, kept: list[str]) -> DataFrame:
    """Rows (seed, allowed, and the columns ``kept``): each window once for each mask; ``allowed`` is how many words may differ."""

    def seeds_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, of, seeds, length in _seeds_of(batches, similarity):
            taken = batch.take(pa.array(of))
            allowed = np.full(len(of), misses_of(length, similarity), np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(seeds.view(np.int64)), pa.array(allowed), *[taken.column(c) for c in kept]], names=["seed", "allowed", *kept])

    types = ", ".join(f"{c} {windows.schema[c].dataType.simpleString()}" for c in kept)
    return windows.mapInArrow(seeds_of, f"seed long, allowed int, {types}")


def _pairs(seen: DataFrame, wanted: DataFrame, window: int, similarity: float) -> DataFrame:
    """Rows (w1, w2, copies, i1, i2): windows of documents and of items that share a seed and have words enough in common."""
    theirs = _seeded(wanted, similarity, ["w1", "w2", "words"]).select("seed", F.col("w1").alias("i1"), F.col("w2").alias("i2"), F.col("words").alias("item_words"))
    mine = _seeded(seen, similarity, ["w1", "w2", "copies", "words"])
    differ: Column = F.lit(0)
    for place in range(window):
        differ = differ + (F.get("words", F.lit(place)) != F.get("item_words", F.lit(place))).cast("int")
    return mine.join(theirs, (mine.seed == theirs.seed) & (differ <= F.col("allowed"))).select("w1", "w2", "copies", "i1", "i2").distinct()


def _covered(found: DataFrame) -> DataFrame:
    """Rows (row, starts, ends): the ranges of words that windows cover, joined where they meet."""
    order = Window.partitionBy("row").orderBy("at", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = found.select("row", "at", "end", F.coalesce(F.col("at") > reached, F.lit(True)).cast("int").alias("opens"))
    ranges = opened.withColumn("part", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))).groupBy("row", "part").agg(F.min("at").alias("at"), F.max("end").alias("end"))
    both = ranges.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "end"))).alias("both"))
    return both.select("row", F.transform("both", lambda s: s.at).alias("starts"), F.transform("both", lambda s: s.end).alias("ends"))
