"""Two-level cells of vectors: a coarse model, and within each coarse cell a finer one."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecframe.operators.metrics import metric_name
from vecframe.operators.topk import to_matrix
from vecframe.operators.vectors import CELL_TILE, FLOATS, _best_places, _lists, _unit

MOST_CELLS = 65_536
ROWS_PER_CELL = 256
#: The cell of vectors with an element that is not finite; a search looks into it whatever it probes.
ODD = -1
#: A bound is widened by so much of the largest score, for rounding.
SLACK = 1e-7


@dataclass
class Space:
    """Where nearer means better, so that cells and bounds by distance serve every metric.

    Unit vectors for cosine; vectors as they are for euclidean; for the dot product one more coordinate that
    makes all rows as long as the longest, and is 0 for queries, which are scaled to that length too: nearer then means a larger product.
    """

    metric: str
    dim: int
    longest: float = 0.0

    @property
    def width(self) -> int:
        return self.dim + (self.metric == "dot_product")

    def of_rows(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        if self.metric == "cosine":
            return _unit(x)
        if self.metric == "dot_product":
            return np.column_stack([x, np.sqrt(np.maximum(self.longest**2 - (x * x).sum(axis=1), 0))])
        return x

    def of_queries(self, q: np.ndarray) -> np.ndarray:
        q = q.astype(np.float64)
        if self.metric == "dot_product":
            return np.column_stack([_unit(q) * self.longest, np.zeros(len(q))])
        return _unit(q) if self.metric == "cosine" else q

    def best(self, q: np.ndarray, gap: np.ndarray) -> np.ndarray:
        """The best score, larger is better, that a row at a distance of ``gap`` or more from its query may have; q is (queries, dim)."""
        long = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))[:, None]
        if self.metric == "cosine":
            return 1 - gap**2 / 2 + SLACK
        if self.metric == "dot_product":
            cosine = 1 - (gap / self.longest) ** 2 / 2 if self.longest else 0 * gap
            return long * self.longest * (cosine + SLACK)
        return -gap + SLACK * (long + self.longest)


def measured_space(corpus: DataFrame, vector: str, metric: str) -> tuple[Space, int]:
    """The space of a corpus, and how many vectors it has; vectors of different lengths are refused."""
    length = _length(F.col(vector).cast(FLOATS))
    rows = corpus.where(F.col(vector).isNotNull()).select(F.size(vector).alias("n"), length.alias("length"))
    finite = F.when(F.abs("length") < float("inf"), F.col("length"))
    facts = rows.agg(F.count("*").alias("rows"), F.min("n").alias("low"), F.max("n").alias("high"), F.max(finite).alias("longest")).first()
    if not facts.rows:
        raise ValueError("there are no vectors to index")
    if facts.low != facts.high:
        raise ValueError(f"vectors differ in dimension: {facts.low} to {facts.high}")
    return Space(metric_name(metric), facts.low, facts.longest or 0.0), facts.rows


@F.arrow_udf(T.DoubleType())
def _length(vectors: pa.Array) -> pa.Array:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    owner = np.repeat(np.arange(len(vectors)), np.diff(vectors.offsets.to_numpy()))
    return pa.array(np.sqrt(np.bincount(owner, weights=flat * flat, minlength=len(vectors))))


def in_space(column: Column, space: Space) -> Column:
    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def move(vectors: pa.Array) -> pa.Array:
        return _lists(space.of_rows(to_matrix(vectors, space.dim)), pa.float64())

    # Declared so that a filter on the result does not compute it a second time.
    return move.asNondeterministic()(column.cast(FLOATS))


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The place of the nearest centre, the first of equal ones."""
    half = (centres.astype(np.float64) ** 2).sum(axis=1) / 2
    tile = max(1, CELL_TILE // len(centres))
    out = np.empty(len(points), np.int64)
    for at in range(0, len(points), tile):
        out[at : at + tile] = (points[at : at + tile] @ centres.T - half).argmax(axis=1)
    return out


@dataclass
class Cells:
    """Centres of both levels in their space; fine cells are numbered so that those of one coarse cell are together."""

    space: Space
    coarse: np.ndarray
    fine: np.ndarray
    parent: np.ndarray
    radius: np.ndarray | None = None
    rows: int = 0
    starts: np.ndarray = field(init=False)

    def __post_init__(self):
        self.starts = np.searchsorted(self.parent, np.arange(len(self.coarse) + 1))

    def plain(self) -> dict:
        """The model as arrays and numbers alone, for broadcasting: tasks need not be able to import this module."""
        space = {"metric": self.space.metric, "dim": self.space.dim, "longest": self.space.longest}
        return {"space": space, "coarse": self.coarse, "fine": self.fine, "parent": self.parent, "radius": self.radius}

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, distance to its centre) of rows; looks at the coarse centres and those of one coarse cell."""
        p = self.space.of_rows(x)
        sound = np.flatnonzero(np.isfinite(p).all(axis=1))
        cell, gap = np.full(len(p), ODD, np.int32), np.zeros(len(p))
        top = nearest(p[sound], self.coarse)
        for c in np.unique(top):
            rows = sound[top == c]
            first, end = self.starts[c], self.starts[c + 1]
            cell[rows] = first + nearest(p[rows], self.fine[first:end])
        away = p[sound] - self.fine[cell[sound]]
        gap[sound] = np.sqrt((away * away).sum(axis=1))
        return cell, gap

    def probe(self, q: np.ndarray, count: int) -> np.ndarray:
        """The ``count`` cells nearest to each query, nearest first, among those of enough coarse cells."""
        p, n = self.space.of_queries(q), len(self.fine)
        if count >= n:
            return np.tile(np.arange(n, dtype=np.int32), (len(q), 1))
        opened = min(len(self.coarse), max(2, math.ceil(4 * count * len(self.coarse) / n)))
        out = np.empty((len(q), count), np.int32)
        half = (self.coarse.astype(np.float64) ** 2).sum(axis=1) / 2
        tile = max(1, CELL_TILE // n)
        for at in range(0, len(q), tile):
            part = p[at : at + tile]
            doors = _best_places(part @ self.coarse.T - half, opened)
            closeness = np.full((len(part), n), -np.inf)
            for c in np.unique(doors):
                first, end = self.starts[c], self.starts[c + 1]
                asking = np.flatnonzero((doors == c).any(axis=1))
                own = self.fine[first:end].astype(np.float64)
                closeness[asking, first:end] = part[asking] @ own.T - (own**2).sum(axis=1) / 2
            out[at : at + tile] = _best_places(closeness, count)
        return out

    def bounds(self, q: np.ndarray, some: slice = slice(None)) -> np.ndarray:
        """(queries, ``some`` of the cells): no row of the cell has a better score, by the triangle inequality; -inf for cells without rows."""
        p, fine, radius = self.space.of_queries(q), self.fine[some].astype(np.float64), self.radius[some]
        square = (p * p).sum(axis=1)[:, None] - 2 * (p @ fine.T) + (fine * fine).sum(axis=1)
        gap = np.maximum(np.sqrt(np.maximum(square, 0)) - radius, 0)
        return np.where(radius < 0, -np.inf, self.space.best(q, gap))

    def reached(self, q: np.ndarray, floor: np.ndarray, some: slice = slice(None)) -> np.ndarray:
        """Whether a row of the cell may have a score of the query's floor or better."""
        reach = self.bounds(q, some) >= floor[:, None]
        return reach & (self.radius[some] >= 0)


def received(model):
    """A broadcast model in a task: cells from their plain form, anything else as it is."""
    if isinstance(model, dict):
        return Cells(**(model | {"space": Space(**model["space"])}))
    return model


def fit_two_level(
    corpus: DataFrame, *, key: str = "key", vector: str = "vector", metric: str = "cosine", n_cells: int | None = None,
    rows_per_cell: int = ROWS_PER_CELL, max_iter: int = 10, seed: int = 7,
) -> Cells:
    """About ``n_cells`` cells (the root of the number of rows, 65,536 at most) under the root of so many coarse cells.

    The coarse model is fitted by Spark ML, the fine ones each by a task of its own, side by side. Fitting looks at about ``rows_per_cell`` rows per cell, by a hash
    of their key; search covers all rows whatever was fitted. A row looks at about twice the root of ``n_cells`` centres.
    """
    space, rows = measured_space(corpus, vector, metric)
    if n_cells is None:
        n_cells = min(MOST_CELLS, max(2, math.isqrt(rows)))
    if n_cells < 2:
        raise ValueError("n_cells must be at least 2")
    n_coarse = max(2, round(math.sqrt(n_cells)))
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 30)) / (1 << 30)
    whole = corpus.where(F.col(vector).isNotNull()).select(in_space(F.col(vector), space).alias("point"), draw.alias("draw"))
    whole = whole.where(F.forall("point", lambda x: F.abs(x) < float("inf")))
    training = whole.where(F.col("draw") < n_coarse * 4 * rows_per_cell / rows).select(array_to_vector("point").alias("features"))
    model = KMeans(k=n_coarse, seed=seed, maxIter=max_iter, featuresCol="features", initMode="random").fit(training)
    coarse = np.array(model.clusterCenters(), np.float32)

    @F.arrow_udf(T.IntegerType())
    def top(points: pa.Array) -> pa.Array:
        return pa.array(nearest(points.flatten().to_numpy().reshape(len(points), -1), coarse), pa.int32())

    placed = whole.withColumn("top", top("point"))
    counts = dict(placed.groupBy("top").count().collect())
    # A coarse cell with very many rows has more cells, up to a bound that keeps its task's sample small.
    wanted = {c: min(max(1, round(n_cells * n / sum(counts.values()))), 4 * n_coarse) for c, n in counts.items()}
    layout = [(c, n, n * rows_per_cell / counts[c]) for c, n in wanted.items()]
    sample = placed.join(F.broadcast(corpus.sparkSession.createDataFrame(layout, "top int, wanted int, share double")), "top").where("draw < share")
    fitted = sample.select("top", "wanted", "point").groupBy("top").applyInArrow(_fit_one(max_iter, seed), "top int, centre array<float>").toArrow()
    tops = fitted.column("top").to_numpy()
    centres = np.stack(fitted.column("centre").to_numpy()).astype(np.float32) if len(tops) else np.zeros((0, space.width), np.float32)
    bare = np.setdiff1d(np.arange(len(coarse)), tops)  # no sampled row: its own centre is its one cell
    tops, centres = np.concatenate([tops, bare]), np.concatenate([centres, coarse[bare]])
    order = np.lexsort((*centres.T[::-1], tops))
    return Cells(space, coarse, centres[order], tops[order].astype(np.int32), rows=rows)


def _fit_one(max_iter: int, seed: int):
    def fit(group: pa.Table) -> pa.Table:
        top, wanted = group.column("top")[0].as_py(), group.column("wanted")[0].as_py()
        x = np.concatenate([c.flatten().to_numpy() for c in group.column("point").chunks]).reshape(len(group), -1)
        x = x[np.lexsort(x.T)]  # whatever order the rows came in
        centres = np.unique(x[np.random.default_rng([seed, top]).permutation(len(x))[:wanted]], axis=0)
        for _ in range(max_iter):
            of = nearest(x, centres)
            used, at = np.unique(of, return_inverse=True)
            sums = np.zeros((len(used), x.shape[1]))
            np.add.at(sums, at, x)
            moved = sums / np.bincount(at)[:, None]
            if moved.shape == centres.shape and np.allclose(moved, centres):
                break
            centres = moved
        lists = _lists(centres.astype(np.float32), pa.float32())
        return pa.table([pa.array([top] * len(centres), pa.int32()), lists], names=["top", "centre"])

    return fit


def assigned(corpus: DataFrame, cells: Cells, vector: str) -> DataFrame:
    """``corpus`` with ``_cell``, ``_gap`` (the distance to the centre of the cell) and ``_shelf`` (the coarse cell)."""
    shipped = corpus.sparkSession.sparkContext.broadcast(cells.plain())

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def place(vectors: pa.Array) -> pa.Array:
        model = received(shipped.value)
        cell, gap = model.assign(to_matrix(vectors, model.space.dim))
        shelf = np.where(cell < 0, -1, model.parent[np.maximum(cell, 0)])
        return _lists(np.column_stack([cell, gap, shelf]), pa.float64())

    placed = corpus.where(F.col(vector).isNotNull()).withColumn("_place", place.asNondeterministic()(F.col(vector).cast(FLOATS)))
    at = lambda i: F.element_at("_place", i)
    return placed.withColumns({"_cell": at(1).cast("int"), "_gap": at(2), "_shelf": at(3).cast("int")}).drop("_place")


def model_rows(cells: Cells) -> Iterator[tuple]:
    """Rows (level, place, parent, radius, centre) to store a model."""
    for i, c in enumerate(cells.coarse):
        yield 0, i, None, None, c.tolist()
    for i, c in enumerate(cells.fine):
        yield 1, i, int(cells.parent[i]), float(cells.radius[i]), c.tolist()


MODEL_SCHEMA = "level int, place int, parent int, radius double, centre array<float>"


def model_of(stored: pa.Table, space: Space) -> Cells:
    stored = stored.sort_by([("level", "ascending"), ("place", "ascending")])
    level = stored.column("level").to_numpy()
    centres = np.stack(stored.column("centre").to_numpy()).astype(np.float32)
    fine = level == 1
    return Cells(space, centres[~fine], centres[fine], stored.column("parent").to_numpy()[fine].astype(np.int32), stored.column("radius").to_numpy()[fine])
