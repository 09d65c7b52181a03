"""Vectors of equal label that point nearly the same way, found by E8 lattice hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecframe.llm.common import batch_of, components, stored, whole_runs
from vecframe.llm.near import BLOCK, Forest, _shared_keys
from vecframe.llm.shingles import mix, random_odd

COSINE = 0.98
TABLES = 10
#: Lattice points of 8 projections that make one cell, cells next to its own that a vector also enters, and the size of a cell.
POINTS = 2
PROBES = 4
SCALE = 2.0
SEED = 8


def e8_roots() -> np.ndarray:
    """The 240 shortest vectors of E8: (±1, ±1, 0...) in any places, and (±1/2)^8 with an even number of minus signs."""
    unit = np.eye(8)
    pairs = [a * unit[i] + b * unit[j] for i in range(8) for j in range(i) for a in (1, -1) for b in (1, -1)]
    signs = 1 - 2 * ((np.arange(256)[:, None] >> np.arange(8)) & 1)
    return np.concatenate([np.array(pairs), signs[(signs < 0).sum(1) % 2 == 0] / 2])


ROOTS = e8_roots()


def _even(x: np.ndarray) -> np.ndarray:
    """The nearest point of D8, whole numbers with an even sum: round, and where the sum is odd round the worst place the other way."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(1) % 2)
    gap = x[odd] - near[odd]
    worst = np.abs(gap).argmax(1)
    near[odd, worst] += np.where(gap[np.arange(len(odd)), worst] < 0, -1, 1)
    return near


def e8_points(x: np.ndarray) -> np.ndarray:
    """The nearest point of E8 to each row of 8 numbers: D8, or D8 moved by one half."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1))[:, None], whole, half)


def lattice_keys(units: np.ndarray, tables: int = TABLES, points: int = POINTS, probes: int = PROBES, scale: float = SCALE) -> np.ndarray:
    """Cell keys of each vector, of shape (vectors, tables x (1 + probes)): the own cell and the nearest of its neighbours."""
    rng = np.random.default_rng([SEED, units.shape[1]])
    out = np.zeros((len(units), tables, 1 + probes), np.uint64)
    places, marks = random_odd(8 * points, SEED), random_odd(tables, SEED + 1)
    for t in range(tables):
        x = units @ (rng.standard_normal((units.shape[1], 8 * points)) / scale)
        homes = [e8_points(x[:, 8 * p : 8 * p + 8]) for p in range(points)]
        sums = [((2 * h).astype(np.int64).view(np.uint64) * places[8 * p : 8 * p + 8]).sum(1, dtype=np.uint64) for p, h in enumerate(homes)]
        own = sum(sums[1:], sums[0])
        moves, costs = [], []
        for p, h in enumerate(homes):
            gain = (x[:, 8 * p : 8 * p + 8] - h) @ ROOTS.T  # the distance to a neighbour grows by 2 - 2 gain
            best = np.argpartition(-gain, probes, axis=1)[:, :probes]
            costs.append(np.take_along_axis(-gain, best, axis=1))
            moves.append(((2 * ROOTS).astype(np.int64).view(np.uint64) * places[8 * p : 8 * p + 8]).sum(1, dtype=np.uint64)[best])
        costs, moves = np.concatenate(costs, axis=1), np.concatenate(moves, axis=1)
        nearest = np.argpartition(costs, probes - 1, axis=1)[:, :probes] if probes else np.zeros((len(units), 0), int)
        out[:, t, 0] = own
        out[:, t, 1:] = own[:, None] + np.take_along_axis(moves, nearest, axis=1)
        out[:, t] = mix(out[:, t] + marks[t])
    return out.reshape(len(units), -1)


def near_vectors(rows: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """One row (key, n_links, component_id, kept) per vector.

    Two vectors of equal label are linked if their cosine, in double precision, is ``cosine`` or more. ``n_links``
    counts the others linked directly, ``component_id`` is the smallest key that links reach, ``kept`` is true where that is the vector's own.

    Vectors that are null, empty, zero or hold null, NaN or infinite elements, and vectors with a null label, link
    with nothing. Vectors of different length never link. Equal vectors of a label are one class, compared once.
    Rows with equal keys are vectors of their own. A null key ranks after all others. An empty table gives no rows. Other columns are not read.

    Found links are exact. A link is missed only where no cell of any table is shared and no chain of found
    links joins the pair.
    """
    read = rows.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    valid = "label is not null and size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(vector, x -> x <> 0)"
    keyed = read.withColumn("valid", F.coalesce(F.expr(valid), F.lit(False))).withColumns({"k1": F.xxhash64("label", "vector"), "k2": F.xxhash64(F.lit(7), "vector", "label")})
    same = keyed.where("valid").groupBy("k1", "k2").agg(F.count("*").alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    classes = stored(same.withColumn("rep", F.monotonically_increasing_id()), "near-vectors-classes")

    def hash_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for picked, units in _by_length(batch.column("vector")):
                keys = lattice_keys(units, tables=tables, probes=probes)
                schema = pa.schema([("rep", pa.int64()), ("label", batch.schema.field("label").type), ("cell", pa.int64())])
                wide = keys.shape[1]
                at = pa.array(np.repeat(picked, wide))
                yield batch_of(schema, batch.column("rep").take(at), batch.column("label").take(at), (keys + np.uint64(units.shape[1])).view(np.int64).ravel())

    cells = classes.select("rep", "label", "vector").mapInArrow(hash_cells, f"rep long, label {dict(classes.dtypes)['label']}, cell long")
    keys = cells.select(F.xxhash64("label", "cell").alias("key"), "rep")
    members = stored(keys.repartition("key").sortWithinPartitions("key").mapInArrow(_shared_keys, "key long, rep long, block int").dropDuplicates(["key", "rep"]), "near-vectors-members")
    last = members.where("block > 0").groupBy("key").agg((F.max("block") + 1).alias("blocks"))
    drafts = components(_in_cells(members.join(last, "key", "left"), classes, cosine).where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")), "near-vectors-drafts")
    drafted = stored(drafts.select(F.col("node").alias("rep"), F.col("root").alias("key")), "near-vectors-drafted")
    blocks = drafted.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = drafted.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    links = _in_cells(placed, classes, cosine).groupBy("rep").agg(F.sum("links").alias("links"))
    known = stored(classes.select("k1", "k2", "rep", "copies").join(drafted.withColumnRenamed("key", "root"), "rep", "left").join(links, "rep", "left"), "near-vectors-known")
    each = stored(keyed.select("id", "valid", "k1", "k2"), "near-vectors-rows").join(known.withColumn("valid", F.lit(True)), ["valid", "k1", "k2"], "left")
    grouped = each.withColumn("group", F.coalesce("root", "rep"))
    firsts = grouped.where("group is not null").groupBy("group").agg(F.min("id").alias("first"))
    return grouped.join(firsts, "group", "left").select(
        F.col("id").alias(key),
        F.coalesce(F.coalesce("links", F.lit(0)) + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("first", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("first", "id")).alias("kept"),
    )


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors) for each length of vectors."""
    sizes = np.diff(column.offsets.to_numpy())
    for size in np.unique(sizes):
        picked = np.flatnonzero(sizes == size)
        x = column.take(pa.array(picked)).flatten().to_numpy().reshape(len(picked), size)
        x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares stay finite
        yield picked, x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _in_cells(members: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    """Rows (rep, links, root) of cells that compare all their members; ``members`` are (key, rep, block, blocks)."""
    cells = (
        members.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
        .select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("cell"), F.when(F.col("block") != F.col("other"), (F.col("block") > F.col("other")).cast("int")).otherwise(-1).alias("side"), "rep")
        .join(classes.select("rep", "copies", "vector"), "rep")
    )
    schema = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in whole_runs(batches, "cell"):
            rep, side, copies = (rows.column(c).to_numpy() for c in ("rep", "side", "copies"))
            out = []
            for start, end in zip(bounds[:-1], bounds[1:], strict=True):
                links, forest = np.zeros(end - start, np.int64), Forest(end - start)
                for picked, units in _by_length(rows.column("vector").slice(start, end - start).combine_chunks()):
                    own, other = (picked, picked) if side[start] < 0 else (picked[side[start + picked] == 0], picked[side[start + picked] == 1])
                    at = np.searchsorted(picked, own), np.searchsorted(picked, other)
                    near = units[at[0]] @ units[at[1]].T >= cosine
                    if side[start] < 0:
                        np.fill_diagonal(near, False)
                    else:
                        links[other] += copies[start + own] @ near
                    links[own] += near @ copies[start + other]
                    for i in np.flatnonzero(near.any(axis=1)):
                        forest.join(own[i], other[near[i]])
                out.append(np.stack([rep[start:end], links, rep[start + forest.label]]))
            yield batch_of(schema, *np.concatenate(out, axis=1))

    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(compare, "rep long, links long, root long")
