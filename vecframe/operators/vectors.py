"""Whole-column vector jobs: coercion, normalisation, grouped means, projection and cell lookup."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecframe.operators.metrics import NORM_FLOOR, metric_name
from vecframe.operators.topk import METRIC_CODES, exact_goodness, to_matrix

FLOATS = T.ArrayType(T.FloatType())
GROUPS_HELD = 10_000
# Row times centroid products held at once when cells are assigned, 8 bytes each.
CELL_TILE = 4_000_000


def _lists(matrix: np.ndarray, value_type: pa.DataType) -> pa.Array:
    """A matrix as one Arrow list array."""
    n, width = matrix.shape
    offsets = pa.array(np.arange(0, (n + 1) * width, width) if width else np.zeros(n + 1), type=pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix).reshape(-1), type=value_type))


def coerce_vectors(df: DataFrame, vector: str = "vector") -> DataFrame:
    """The vector column as ``array<float>`` of one length; a null vector becomes a zero vector.

    The dimension is measured in one aggregate over the column; ragged vectors are refused. When
    every vector is null or empty the column is left as it is.
    """
    size = F.size(F.col(vector))
    row = df.where(F.col(vector).isNotNull()).agg(F.min(size).alias("low"), F.max(size).alias("high")).first()
    if row.high is None or row.high == 0:
        return df
    if row.low != row.high:
        raise ValueError(f"column {vector!r} holds vectors of {row.low} to {row.high} elements")
    zero = F.array_repeat(F.lit(0.0).cast("float"), row.high)
    return df.withColumn(vector, F.coalesce(F.col(vector).cast(FLOATS), zero))


@F.arrow_udf(FLOATS)
def _to_unit(vectors: pa.Array) -> pa.Array:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(vectors.offsets.to_numpy())
    row = np.repeat(np.arange(len(vectors)), sizes)
    length = np.sqrt(np.bincount(row, weights=flat * flat, minlength=len(vectors)))
    scaled = (flat / np.maximum(length, NORM_FLOOR)[row]).astype(np.float32)
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), type=pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(scaled), mask=vectors.is_null() if vectors.null_count else None)


def l2_normalize(column: Column) -> Column:
    """Unit length, with the norm floored at 1e-9 so that a zero vector stays zero; null stays null."""
    return _to_unit(column.cast(FLOATS))


def normalize_vectors(df: DataFrame, vector: str = "vector") -> DataFrame:
    return df.withColumn(vector, l2_normalize(F.col(vector)))


def vector_mean(df: DataFrame, by: list[str], vector: str = "vector") -> DataFrame:
    """Element-wise mean per group, as ``array<double>``.

    Tasks add up whole vectors, so what is shuffled is one vector sum per group and task, however
    large a group is.
    """
    rows = df.where(F.col(vector).isNotNull()).select(*by, F.col(vector).cast(FLOATS).alias("_vector"))
    fields = [rows.schema[c] for c in by]
    schema = T.StructType([*fields, T.StructField("_sums", T.ArrayType(T.DoubleType())), T.StructField("_n", T.LongType())])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            held.append(_group_sums(pa.Table.from_batches([batch]), by, "_vector"))
            # Joined once in a while, so that a task holds each group about once.
            if sum(len(t) for t in held) > 2 * GROUPS_HELD:
                held = [_join_sums(held, by)]
                if len(held[0]) > GROUPS_HELD:
                    yield from held.pop().to_batches()
        if held:
            yield from _join_sums(held, by).to_batches()

    sums = rows.mapInArrow(add_up, schema).select(*by, "_n", F.posexplode("_sums").alias("_pos", "_x"))
    means = sums.groupBy(*by, "_pos").agg((F.sum("_x") / F.sum("_n")).alias("_mean"))
    packed = means.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_pos", "_mean"))).alias("_all"))
    return packed.select(*by, F.col("_all._mean").alias(vector))


def _group_sums(rows: pa.Table, by: list[str], vector: str, counts: np.ndarray | None = None) -> pa.Table:
    lists = rows.column(vector).combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    dim = len(lists[0])
    if (np.diff(lists.offsets.to_numpy()) != dim).any():
        raise ValueError("vectors differ in dimension")
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    groups = rows.select(by).to_pandas().groupby(by, dropna=False, sort=False).ngroup().to_numpy()
    order = np.argsort(groups, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(groups[order]) != 0])
    n = np.ones(len(groups), dtype=np.int64) if counts is None else counts
    return pa.table(
        [
            *rows.select(by).take(pa.array(order[starts])).columns,
            _lists(np.add.reduceat(x[order], starts, axis=0), pa.float64()),
            pa.array(np.add.reduceat(n[order], starts)),
        ],
        names=[*by, "_sums", "_n"],
    )


def _join_sums(parts: list[pa.Table], by: list[str]) -> pa.Table:
    whole = pa.concat_tables(parts)
    return _group_sums(whole, by, "_sums", whole.column("_n").to_numpy())


def project(column: Column, components: np.ndarray, unit: bool) -> Column:
    """Coordinates of each vector along ``components`` (dimension x reduced), optionally unit-scaled first."""
    dim = components.shape[0]

    @F.arrow_udf(FLOATS)
    def along(vectors: pa.Array) -> pa.Array:
        x = to_matrix(vectors, dim).astype(np.float64)
        return _lists((_unit(x) if unit else x) @ components, pa.float32())

    return along(column.cast(FLOATS))


def nearest_cells(column: Column, centroids: np.ndarray, count: int, unit: bool) -> Column:
    """The ``count`` nearest centroids of each vector, nearest first, as ``array<int>``."""
    dim = centroids.shape[1]
    half = (centroids**2).sum(axis=1) / 2
    tile = max(1, CELL_TILE // len(centroids))

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def nearest(vectors: pa.Array) -> pa.Array:
        x = to_matrix(vectors, dim).astype(np.float64)
        if unit:
            x = _unit(x)
        out = np.empty((len(x), min(count, len(centroids))), dtype=np.int32)
        for at in range(0, len(x), tile):
            closeness = x[at : at + tile] @ centroids.T
            closeness -= half
            out[at : at + tile] = _best_places(closeness, count)
        return _lists(out, pa.int32())

    return nearest(column.cast(FLOATS))


def _best_places(values: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` largest values of each row, largest first, equal ones by place."""
    if count == 1:
        return values.argmax(axis=1)[:, None]
    if count < values.shape[1]:
        # Values equal to the last one taken may have come from a later place; those rows are sorted whole.
        some = np.argpartition(-values, count - 1, axis=1)[:, :count]
        some.sort(axis=1)
        taken = np.take_along_axis(values, some, axis=1)
        best = np.take_along_axis(some, np.argsort(-taken, axis=1, kind="stable"), axis=1)
        tied = np.flatnonzero((values >= taken.min(axis=1)[:, None]).sum(axis=1) > count)
        best[tied] = np.argsort(-values[tied], axis=1, kind="stable")[:, :count]
        return best
    return np.argsort(-values, axis=1, kind="stable")


def pair_goodness(a: Column, b: Column, metric_code: Column, dim: int) -> Column:
    """Exact scores of aligned vectors in Arrow batches, larger is better; metric per row."""

    @F.arrow_udf(T.DoubleType())
    def score(left: pa.Array, right: pa.Array, codes: pa.Array) -> pa.Array:
        left, right = to_matrix(left, dim), to_matrix(right, dim)
        codes = codes.to_numpy(zero_copy_only=False)
        out = np.empty(len(codes))
        for code in np.unique(codes):
            of_metric = codes == code
            out[of_metric] = exact_goodness(left[of_metric], right[of_metric], int(code))
        return pa.array(out)

    # Declared so that a filter on the score does not compute it a second time.
    return score.asNondeterministic()(a.cast(FLOATS), b.cast(FLOATS), metric_code)


def pair_score(a: Column, b: Column, metric: str, dim: int) -> Column:
    """Score of two vector columns of one row: a similarity, or the distance for euclidean."""
    metric = metric_name(metric)
    goodness = pair_goodness(a, b, F.lit(METRIC_CODES[metric]), dim)
    return F.abs(goodness) if metric == "euclidean" else goodness


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.sqrt((x**2).sum(axis=1, keepdims=True))
    return np.divide(x, length, out=np.zeros_like(x), where=length != 0)
