"""Vectors compressed to one code byte per part, with codebooks trained by Lloyd's algorithm over active entries."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecframe.llm.common import batch_of, join_counted, stored
from vecframe.llm.whole_vectors import CHUNK, matrix, packed, squares, unpacked, whole_numbers

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2


def assign(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, distance) of the nearest entry of each part, the first of equal ones; x is (rows, parts, width), books (parts, entries, width)."""
    every = [squares(x[:, p], books[p]) for p in range(x.shape[1])]
    return np.stack([d.argmin(axis=1) for d in every], axis=1), np.stack([d.min(axis=1) for d in every], axis=1)


def reassign(x: np.ndarray, books: np.ndarray, moved: np.ndarray, entry: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same as ``assign``, from the entry and distance before the entries marked in ``moved`` (parts, entries) did.

    A part whose entry stayed keeps its exact distance, and so do all other entries that stayed, which were no better: only moved entries
    are compared with it. A part whose entry moved is compared with all.
    """
    entry, distance = entry.copy(), distance.copy()
    for p in range(x.shape[1]):
        active = np.flatnonzero(moved[p])
        if not len(active):
            continue
        lost = moved[p][entry[:, p]]
        again = np.flatnonzero(lost)
        if len(again):
            every = squares(x[again, p], books[p])
            entry[again, p], distance[again, p] = every.argmin(axis=1), every.min(axis=1)
        stay = np.flatnonzero(~lost)
        if len(stay):
            some = squares(x[stay, p], books[p][active])
            best, near = active[some.argmin(axis=1)], some.min(axis=1)
            closer = (near < distance[stay, p]) | (near == distance[stay, p]) & (best < entry[stay, p])
            entry[stay[closer], p], distance[stay[closer], p] = best[closer], near[closer]
    return entry, distance


def vector_codes(
    rows: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES,
    rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """Rows (id, label, code, error) and the codebooks (parts, entries, width); ``code`` has two hex digits a part.

    Vectors that are null, empty or hold null or non-finite components go. Components become floor(``scale`` x component), and
    vectors are cut into ``parts`` equal consecutive parts. The codebook of a part starts as that part of the vectors with the smallest keys (of equal keys the smaller
    vector; null keys last), fewer vectors give fewer entries. The length is that of the first of these vectors and must be a multiple of ``parts``;
    vectors of other lengths have a null code and error. An empty table gives no rows. Other columns are not read.

    Chunks of rows are stored with their codes and exact distances, which each round reads and writes again in place, without
    a shuffle. The codebooks, entries x length numbers, travel to the tasks, and their sums, as many a task, come back.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code byte names at most 256 entries")
    whole = whole_numbers(rows, key=key, vector=vector, scale=scale, carry={"label": F.col(label)})
    smallest = lambda rows: [r.q for r in rows.orderBy(F.asc_nulls_last("id"), "q").select("q").limit(entries).collect()]
    id_type, label_type = (whole.schema[c].dataType.simpleString() for c in ("id", "label"))
    first = smallest(whole)
    if not first:
        return whole.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).where("false"), np.zeros((parts, 0, 0), np.int64)
    dimension = len(first[0])
    if dimension % parts:
        raise ValueError(f"vectors of {dimension} components cannot be cut into {parts} equal parts")
    if any(len(q) != dimension for q in first):
        first = smallest(whole.where(F.size("q") == dimension))
    books = np.array(first, np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)
    schema = f"rows int, ids array<{id_type}>, labels array<{label_type}>, data binary, codes binary, errors binary"
    state = stored(whole.mapInArrow(_first_codes(books), schema), "codes")
    for _ in range(rounds):
        books, moved = _updated(state, books)
        state = stored(state.mapInArrow(_next_codes(books, moved), schema), "codes")
    return state.mapInArrow(_named(parts), f"id {id_type}, label {label_type}, code string, error long"), books


def _first_codes(books: np.ndarray):
    """Rows (id, label, q) as chunks with their first codes; vectors of other lengths make chunks without data."""
    parts, _, width = books.shape

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = np.diff(batch.column("q").offsets.to_numpy()) == parts * width
            for right in (True, False):
                rows = batch.filter(pa.array(fits == right))
                for at in range(0, rows.num_rows, CHUNK):
                    piece = rows.slice(at, CHUNK)
                    body = [None, None, None]
                    if right:
                        x = matrix(piece.column("q"), parts * width).astype(np.int64)
                        entry, distance = assign(x.reshape(-1, parts, width), books)
                        body = [packed(x), entry.astype(np.uint8).tobytes(), packed(distance)]
                    yield _chunk(piece.num_rows, _list(piece.column("id")), _list(piece.column("label")), body)

    return code


def _list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _chunk(rows: int, ids: pa.Array, labels: pa.Array, body: list[bytes | None]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([rows], pa.int32()), ids, labels, *[pa.array([b], pa.binary()) for b in body]], names=["rows", "ids", "labels", "data", "codes", "errors"])


def _chunks(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """(chunk, numbers, entries, distances) of each chunk; of those without data the chunk and nulls."""
    for batch in batches:
        for i in range(batch.num_rows):
            one = batch.slice(i, 1)
            n, data, codes, errors = (one.column(c)[0].as_py() for c in ("rows", "data", "codes", "errors"))
            if data is None:
                yield one, None, None, None
            else:
                entry = np.frombuffer(codes, np.uint8).reshape(n, parts).astype(np.int64)
                yield one, data, entry, unpacked(errors, n, parts)


def _numbers(data: bytes, n: int, books: np.ndarray) -> np.ndarray:
    parts, _, width = books.shape
    return unpacked(data, n, parts, width)


def _next_codes(books: np.ndarray, moved: np.ndarray):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, data, entry, distance in _chunks(batches, len(books)):
            if data is None:
                yield one
                continue
            entry, distance = reassign(_numbers(data, len(entry), books), books, moved, entry, distance)
            yield _chunk(len(entry), one.column("ids"), one.column("labels"), [data, entry.astype(np.uint8).tobytes(), packed(distance)])

    return code


def _updated(state: DataFrame, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codebooks with each used entry replaced by the floor of the mean of its parts, and which entries that changed."""
    parts, entries, width = books.shape
    schema = pa.schema([("slot", pa.int32()), ("total", pa.int64()), ("n", pa.int64())])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros(books.size, np.int64), np.zeros(parts * entries, np.int64)
        for _, data, entry, _ in _chunks(batches, parts):
            if data is not None:
                cell = np.arange(parts) * entries + entry
                counts += np.bincount(cell.ravel(), minlength=len(counts))
                slot = cell[:, :, None] * width + np.arange(width)
                # Sums of one chunk are whole numbers below 2^53, which doubles hold exactly.
                totals += np.bincount(slot.ravel(), weights=_numbers(data, len(entry), books).ravel(), minlength=len(totals)).astype(np.int64)
        n = np.repeat(counts, width)
        used = np.flatnonzero(n)
        yield batch_of(schema, used, totals[used], n[used])

    sums = state.select("rows", "data", "codes", "errors").mapInArrow(add_up, "slot int, total long, n long")
    means = np.array(sums.groupBy("slot").agg(F.expr("(sum(total) - pmod(sum(total), sum(n))) div sum(n)").alias("mean")).collect(), np.int64).reshape(-1, 2)
    new = books.copy().reshape(-1)
    new[means[:, 0]] = means[:, 1]
    new = new.reshape(books.shape)
    return new, (new != books).any(axis=2)


def _named(parts: int):
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, data, entry, distance in _chunks(batches, parts):
            n = one.column("rows")[0].as_py()
            code = error = pa.nulls(n)
            if data is not None:
                digits = entry.astype(np.uint8).tobytes().hex()
                code = pa.array([digits[i : i + 2 * parts] for i in range(0, len(digits), 2 * parts)])
                error = pa.array(distance.sum(axis=1))
            yield pa.RecordBatch.from_arrays([one.column("ids").flatten(), one.column("labels").flatten(), code.cast(pa.string()), error.cast(pa.int64())], names=["id", "label", "code", "error"])

    return name


def described_codes(rows: DataFrame, *, key: str = "vec_id", **options) -> DataFrame:
    """Rows (key, code, error, label_error, codebooks_sha256); see ``vector_codes``. Null labels are one label; a label's error is the sum of its rows' that have one."""
    found, books = vector_codes(rows, key=key, **options)
    coded = stored(found.select(F.col("id"), F.struct("label").alias("same"), "code", "error"), "coded")
    sums = stored(coded.groupBy("same").agg(F.sum("error").alias("label_error"), F.count("*").alias("copies")), "label-errors")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return join_counted(coded, sums, ["same"]).select(F.col("id").alias(key), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
