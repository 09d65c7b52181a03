"""Lloyd's algorithm on whole-number vectors, with vectors and centroids cut into blocks of dimensions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecframe.llm.common import batch_of, bucketed, stored, whole_runs
from vecframe.llm.whole_vectors import CHUNK, matrix, packed, squares, unpacked, whole_numbers

SCALE = 64
DIMENSION = 64
CLUSTERS = 16
ROUNDS = 3
#: Dimensions of one block; a block's task knows its own slice of the centroids only.
WIDTH = 16
SEED = 1


def centroid_clusters(
    rows: DataFrame, *, key: str = "vec_id", vector: str = "embedding", dimension: int = DIMENSION, clusters: int = CLUSTERS,
    rounds: int = ROUNDS, scale: int = SCALE, width: int = WIDTH, seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """Rows (id, cluster, distance) and the centroids as rows (cluster, pos, value), after ``rounds`` rounds of Lloyd's algorithm.

    Vectors of other lengths than ``dimension``, null ones and ones with null or non-finite components go. Components become
    floor(``scale`` x component). Centroids start as the vectors with the smallest sha256 of ``seed:key``; of equal keys the
    smaller vector, null keys last; fewer vectors than ``clusters`` give fewer centroids. An empty table gives no rows. Other columns are not read.

    Vectors are stored as tiles: a chunk of rows by a block of ``width`` dimensions. Tasks over tiles compute exact partial
    distances against their slice of the centroids; those of a chunk are added over the blocks and give each row its nearest centroid
    (of equal ones the first). Assignments go back to the tiles, which are bucketed and stay where they are, and each block's
    slice is updated from its own sums. Every step is stored. What is broadcast is the slices, clusters x dimension numbers.
    """
    spark = rows.sparkSession
    whole = whole_numbers(rows, key=key, vector=vector, scale=scale).where(F.size("q") == dimension)
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = whole.select(mark.alias("mark"), "q").orderBy(F.asc_nulls_last("mark"), "q").limit(clusters)
    # At most ``clusters`` rows, numbered in one task.
    numbered = first.coalesce(1).sortWithinPartitions(F.asc_nulls_last("mark"), "q").withColumn("cluster", F.monotonically_increasing_id().cast("int"))
    centres = stored(numbered.select("cluster", F.posexplode("q").alias("pos", "value")), "cluster-centres")
    if centres.isEmpty():
        return whole.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).where("false"), centres
    id_type = whole.schema["id"].dataType.simpleString()
    tiles = bucketed(whole.mapInArrow(_cut(dimension, width), f"chunk long, block int, rows int, ids array<{id_type}>, data binary"), ["block", "chunk"], "cluster-tiles")
    try:
        for _ in range(rounds):
            near = _nearest(spark.table(tiles), centres, width)
            centres = _updated(spark.table(tiles), near, centres, width)
        near = _nearest(spark.table(tiles), centres, width).withColumn("block", F.lit(0))
        named = near.join(spark.table(tiles).select("block", "chunk", "ids"), ["block", "chunk"])
        found = stored(named.select(F.inline(F.arrays_zip(F.col("ids").alias("id"), "cluster", "distance"))), "cluster-rows")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {tiles}")
    return found, centres


def _cut(dimension: int, width: int):
    """Rows (id, q) as tiles; the keys of a chunk go with its first block."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                piece = batch.slice(at, CHUNK)
                x, n = matrix(piece.column("q"), dimension), piece.num_rows
                blocks = range(0, dimension, width)
                ids = pa.ListArray.from_arrays(pa.array([0, n] + [n] * (len(blocks) - 1), pa.int32()), piece.column("id"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(blocks)), pa.array(range(len(blocks)), pa.int32()), pa.array([n] * len(blocks), pa.int32()), ids, pa.array([packed(x[:, b : b + width]) for b in blocks], pa.binary())],
                    names=["chunk", "block", "rows", "ids", "data"],
                )
                number += 1

    return cut


def _slices(centres: DataFrame, width: int) -> DataFrame:
    """Centroids by block of dimensions: rows (block, slice), the slice centroid by centroid."""
    numbers = F.transform(F.array_sort(F.collect_list(F.struct("cluster", "pos", "value"))), lambda x: x["value"])
    return centres.groupBy(F.expr(f"cast(pos div {width} as int)").alias("block")).agg(F.max("cluster").alias("last"), numbers.alias("slice"))


def _nearest(tiles: DataFrame, centres: DataFrame, width: int) -> DataFrame:
    """Stored rows (chunk, cluster, distance), with arrays over the rows of the chunk."""
    partial_schema = pa.schema([("chunk", pa.int64()), ("rows", pa.int32()), ("last", pa.int32()), ("data", pa.binary())])
    near_schema = pa.schema([("chunk", pa.int64()), ("cluster", pa.list_(pa.int32())), ("distance", pa.list_(pa.int64()))])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk, rows, data, last, part = (batch.column(c) for c in ("chunk", "rows", "data", "last", "slice"))
            out = []
            for n, body, k, centre in zip(rows.to_pylist(), data.to_pylist(), last.to_pylist(), part, strict=True):
                c = centre.values.to_numpy().astype(np.int64).reshape(k + 1, -1)
                out.append(packed(squares(unpacked(body, n, c.shape[1]), c)))
            yield batch_of(partial_schema, chunk, rows, last, out)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_runs(batches, "chunk"):
            chunk, rows, last, data = (table.column(c).to_pylist() for c in ("chunk", "rows", "last", "data"))
            cluster, distance = [], []
            for start, end in zip(bounds[:-1], bounds[1:], strict=True):
                sums = sum(unpacked(data[i], rows[i], last[i] + 1) for i in range(start, end))
                cluster.append(sums.argmin(axis=1))
                distance.append(sums.min(axis=1))
            yield batch_of(near_schema, [chunk[i] for i in bounds[:-1]], cluster, distance)

    cut = tiles.select("block", "chunk", "rows", "data").join(F.broadcast(_slices(centres, width)), "block")
    partials = cut.mapInArrow(partial, "chunk long, rows int, last int, data binary")
    return stored(partials.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(add, "chunk long, cluster array<int>, distance array<long>"), "cluster-nearest")


def _updated(tiles: DataFrame, near: DataFrame, centres: DataFrame, width: int) -> DataFrame:
    """Stored centroids with each number replaced by the floor of the mean of its rows; a centroid without rows stays."""
    dimension = centres.agg(F.max("pos")).first()[0] + 1
    schema = pa.schema([("cluster", pa.int32()), ("pos", pa.int32()), ("total", pa.int64()), ("n", pa.int64())])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}  # at most blocks x clusters: sums of the block's numbers, and the count
        for batch in batches:
            for block, n, data, cluster in zip(batch.column("block").to_pylist(), batch.column("rows").to_pylist(), batch.column("data").to_pylist(), batch.column("cluster"), strict=True):
                of = cluster.values.to_numpy()
                x = np.column_stack([unpacked(data, n, min(width, dimension - block * width)), np.ones(n, np.int64)])
                order = np.argsort(of, kind="stable")
                groups, starts = np.unique(of[order], return_index=True)
                for c, total in zip(groups.tolist(), np.add.reduceat(x[order], starts, axis=0), strict=True):
                    held[block, c] = held[block, c] + total if (block, c) in held else total
        rows = [(c, block * width + i, int(v), int(sums[-1])) for (block, c), sums in held.items() for i, v in enumerate(sums[:-1])]
        yield batch_of(schema, *zip(*rows, strict=True)) if rows else batch_of(schema, [], [], [], [])

    everywhere = near.select("chunk", "cluster", F.explode(F.sequence(F.lit(0), F.lit((dimension - 1) // width))).alias("block"))
    sums = tiles.select("block", "chunk", "rows", "data").join(everywhere, ["block", "chunk"]).select("block", "rows", "data", "cluster").mapInArrow(add_up, "cluster int, pos int, total long, n long")
    means = sums.groupBy("cluster", "pos").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    floor = F.expr("cast((total - pmod(total, n)) div n as int)")
    return stored(centres.join(F.broadcast(means.select("cluster", "pos", floor.alias("mean"))), ["cluster", "pos"], "left").select("cluster", "pos", F.coalesce("mean", "value").alias("value")), "cluster-centres")


def described_clusters(rows: DataFrame, *, key: str = "vec_id", **options) -> DataFrame:
    """Rows (key, cluster, distance, cluster_inertia, inertia, centroid_sha256); see ``centroid_clusters``."""
    found, centres = centroid_clusters(rows, key=key, **options)
    numbers = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"].cast("string")), ",")
    marks = centres.groupBy("cluster").agg(F.sha2(numbers, 256).alias("centroid_sha256"))
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = found.agg(F.sum("distance")).first()[0]
    facts = stored(marks.join(sums, "cluster"), "cluster-facts")  # a row per cluster
    return found.join(F.broadcast(facts), "cluster").select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", F.lit(whole).cast("long").alias("inertia"), "centroid_sha256")
