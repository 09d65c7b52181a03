"""A search index in a folder: built once from a corpus, opened by every search, refused when the corpus has changed.

``cells``: rows in two-level cells, stored in a folder per coarse cell and in order of their cell, with a radius per cell.
``pca``: rows with a reduced vector beside their own. Either way an index holds all columns of the corpus, so
every option of plain search works on it, and scores are exact.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecframe.operators import ann, knn
from vecframe.operators.cells import MODEL_SCHEMA, MOST_CELLS, ODD, Cells, Space, assigned, fit_two_level, in_space, measured_space, model_of, model_rows, received
from vecframe.operators.metrics import metric_name
from vecframe.operators.topk import to_matrix
from vecframe.operators.vectors import FLOATS, _lists
from vecframe.session import shared_dir

MANIFEST = "number long, build string, kind string, key string, vector string, metric string, dimension int, longest double, rows long, version string, cells int, odd boolean"
#: Added columns of an index's rows.
OWN = {"_cell", "_gap", "_shelf", "_reduced"}
#: Cells that pruned exact search looks into before it bounds the others.
FIRST_CELLS = 2
#: Cells that a task bounds for its queries at once.
PROBED_AT_ONCE = 16
#: About the bytes of vectors in one file of an index.
FILE_BYTES = 128 * 1024 * 1024


class StaleIndex(ValueError):
    """The corpus is not the one the index was built from."""


def corpus_version(corpus: DataFrame, key: str, vector: str) -> str:
    """A mark of a corpus: of its files' names, sizes and times if it is read from files as they are, else of its keys and vectors.

    Files are told apart in their tasks, and no column is read for it.
    """
    try:
        of_files = corpus.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
        facts = of_files.agg(F.count("*"), F.sum(F.xxhash64("file_path", "file_size", "file_modification_time").cast("decimal(38,0)"))).first()
    except AnalysisException:
        facts = corpus.agg(F.count("*"), F.sum(F.xxhash64(key, vector).cast("decimal(38,0)"))).first()
    return f"{facts[0]}-{facts[1] or 0}"


def build_index(
    corpus: DataFrame, path: str, kind: str = "cells", *, key: str = "key", vector: str = "vector", metric: str = "cosine",
    version: str | None = None, reduced_dimensions: int = 64, **fitting,
) -> Index:
    """Fit and store an index; a folder may hold several builds, of which the last counts, so readers of an older one are not disturbed.

    ``version`` is the caller's mark of the corpus, for example a table version; by default ``corpus_version``. Rows without a vector are not in the index.
    """
    if kind not in ("cells", "pca"):
        raise ValueError(f"kind {kind!r} is neither 'cells' nor 'pca'")
    if clash := OWN & set(corpus.columns):
        raise ValueError(f"columns {sorted(clash)} are the index's own")
    spark, path = corpus.sparkSession, path.rstrip("/")
    metric, build = metric_name(metric), f"{path}/build-{uuid.uuid4().hex}"
    version = version or corpus_version(corpus, key, vector)
    cells, odd = 0, False
    if kind == "cells":
        model = fit_two_level(corpus, key=key, vector=vector, metric=metric, **fitting)
        space = model.space
        placed = assigned(corpus, model, vector)
        # By cell and key, so that a cell with very many rows is many files.
        parts = max(min(len(model.coarse), 16), math.ceil(model.rows * (4 * space.dim + 64) / FILE_BYTES))
        placed.repartitionByRange(parts, "_shelf", "_cell", F.xxhash64(key)).sortWithinPartitions("_shelf", "_cell").write.partitionBy("_shelf").parquet(f"{build}/rows")
        held = spark.read.parquet(f"{build}/rows").groupBy("_cell").agg(F.max("_gap").alias("radius"), F.count("*").alias("n")).collect()
        model.radius = np.full(len(model.fine), -1.0)
        for r in held:
            if r["_cell"] == ODD:
                odd = True
            else:
                model.radius[r["_cell"]] = r.radius
        rows, cells = sum(r.n for r in held), len(model.fine)
        spark.createDataFrame(list(model_rows(model)), MODEL_SCHEMA).write.parquet(f"{build}/model")
    else:
        space, rows = measured_space(corpus, vector, metric)
        if not 1 <= reduced_dimensions <= space.width:
            raise ValueError(f"reduced_dimensions must be between 1 and {space.width}")
        known = corpus.where(F.col(vector).isNotNull())
        points = known.select(in_space(F.col(vector), space).alias("p")).where(F.forall("p", lambda x: F.abs(x) < float("inf")))
        components = PCA(k=reduced_dimensions, inputCol="features", outputCol="r").fit(points.select(array_to_vector("p").alias("features"))).pc.toArray()
        known.withColumn("_reduced", _reduced(vector, space, components, rows=True)).write.parquet(f"{build}/rows")
        spark.createDataFrame([(0, i, None, None, row.tolist()) for i, row in enumerate(components)], MODEL_SCHEMA).write.parquet(f"{build}/model")
    last = _last(spark, path)
    entry = ((last.number if last else 0) + 1, build, kind, key, vector, metric, space.dim, space.longest, rows, version, cells, odd)
    # The entry comes last: a build that did not end is never opened.
    spark.createDataFrame([entry], MANIFEST).coalesce(1).write.mode("append").json(f"{path}/manifest")
    return open_index(spark, path)


def _reduced(vector: str, space: Space, components: np.ndarray, *, rows: bool):
    @F.arrow_udf(FLOATS)
    def reduce(vectors: pa.Array) -> pa.Array:
        x = to_matrix(vectors, space.dim)
        return _lists((space.of_rows(x) if rows else space.of_queries(x)) @ components, pa.float32())

    return reduce(F.col(vector).cast(FLOATS))


def _last(spark: SparkSession, path: str):
    try:
        return spark.read.schema(MANIFEST).json(f"{path}/manifest").orderBy(F.desc("number")).first()
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return None


def open_index(spark: SparkSession, path: str, corpus: DataFrame | None = None, *, version: str | None = None) -> Index:
    """The last build in a folder; refused with ``StaleIndex`` if it was not built from ``corpus``, or from the given ``version`` of it."""
    entry = _last(spark, path.rstrip("/"))
    if entry is None:
        raise FileNotFoundError(f"no index at {path}")
    if corpus is not None and version is None:
        version = corpus_version(corpus, entry.key, entry.vector)
    if version is not None and version != entry.version:
        raise StaleIndex(f"the index at {path} was built from another version of the corpus; build it again")
    return Index(spark, entry.asDict())


def open_or_build(corpus: DataFrame, path: str, kind: str = "cells", **options) -> Index:
    """The index in a folder, built if there is none; a stale one is refused, since building again is for the caller to decide."""
    try:
        index = open_index(corpus.sparkSession, path, corpus)
    except FileNotFoundError:
        return build_index(corpus, path, kind, **options)
    if index.entry["kind"] != kind:
        raise ValueError(f"the index at {path} is of kind {index.entry['kind']!r}")
    index._own_names(options)
    return index


@dataclass
class Index:
    """An opened index. The model, at most 65,536 centres by default, is read when a search first needs it and then kept."""

    spark: SparkSession
    entry: dict
    _model: Cells | np.ndarray | None = None

    @property
    def metric(self) -> str:
        return self.entry["metric"]

    @property
    def dim(self) -> int:
        return self.entry["dimension"]

    @property
    def space(self) -> Space:
        return Space(self.metric, self.dim, self.entry["longest"])

    @property
    def names(self) -> dict[str, str]:
        return {"key": self.entry["key"], "vector": self.entry["vector"]}

    @property
    def model(self) -> Cells | np.ndarray:
        if self._model is None:
            stored = self.spark.read.schema(MODEL_SCHEMA).parquet(f"{self.entry['build']}/model").toArrow()
            if self.entry["kind"] == "cells":
                self._model = model_of(stored, self.space)
            else:
                self._model = np.stack(stored.sort_by("place").column("centre").to_numpy()).astype(np.float64)
        return self._model

    def stored_rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.entry['build']}/rows")

    def rows(self) -> DataFrame:
        """The corpus as it was indexed."""
        return self.stored_rows().drop(*OWN)

    def search(self, queries: DataFrame, *, nprobe: int = 8, candidate_multiplier: int = 10, **options) -> DataFrame:
        """kNN join by the index, with the options of ``knn_join`` but for key, vector and metric, which are the index's own."""
        if self.entry["kind"] == "pca":
            return self._by_pca(queries, candidate_multiplier, **options)
        if nprobe < 1:
            raise ValueError("nprobe must be at least 1")
        nprobe = min(nprobe, len(self.model.fine))
        qcells = self._cells_of(F.col(options.get("query_vector", "vector")), lambda model, q: model.probe(q, nprobe))
        return ann.knn_in_cells(self._celled(), queries, qcells, prune=nprobe < len(self.model.fine), **self._layout(), **self._visible(options))

    def exact(self, queries: DataFrame, **options) -> DataFrame:
        """Exact search that skips cells whose bound cannot reach a query's k-th score; see ``exact_with_visits``."""
        return self.exact_with_visits(queries, **options)[0]

    def exact_with_visits(
        self, queries: DataFrame, *, first_cells: int = FIRST_CELLS, query_id: str = "query_id", query_vector: str = "vector", top_k=10,
        min_score=None, max_distance=None, filter: dict | None = None, filter_on: dict[str, str] | None = None,
        metadata: list[str] | bool = False, with_vectors: bool = False, keep_empty: bool = False, broadcast_limit: int = knn.BROADCAST_LIMIT,
    ) -> tuple[DataFrame, DataFrame]:
        """Hits, and rows (query_id, first, later, cells) with the cells looked into at first and afterwards.

        A query first looks into the cells nearest to it. Its k-th score there, or its threshold, is a floor; every other cell
        whose best possible score, by its radius and the triangle inequality, reaches the floor is looked into afterwards. Ties are kept, so the result is that of a full scan.
        """
        if self.entry["kind"] != "cells":
            raise ValueError("exact search with bounds needs an index of cells")
        corpus, key, vector = knn.where_equal(self._celled(), filter), self.entry["key"], self.entry["vector"]
        n = len(self.model.fine)
        near = self._cells_of(F.col(query_vector), lambda model, q: model.probe(q, min(first_cells, n)))
        table = knn.query_table(queries, query_id=query_id, query_vector=query_vector, top_k=top_k, metric=self.metric, min_score=min_score, max_distance=max_distance, filter_on=filter_on, extra=[near.alias("qcells")])
        asked = self._kept(table, "asked")
        facts = knn.measure(asked, broadcast_limit)
        hits_in = lambda some, facts, reach=None: ann.cell_search_hits(corpus, some, facts, prune=True, key=key, vector=vector, filter_on=filter_on, limit=broadcast_limit, reach=reach, **self._layout())
        early = self._kept(_best_hits(hits_in(asked, facts), facts.k), "early-hits")  # at most k rows a query
        floors = early.groupBy("query_id").agg(F.count("*").alias("found"), F.min("goodness").alias("kth"))
        floored = asked.join(floors, F.col("qid") == F.col("query_id"), "left").withColumn("qfloor", F.when(F.col("found") >= F.col("qk"), F.greatest("kth", "qfloor")).otherwise(F.col("qfloor")))
        # How many cells a query looks into is kept, not which: a task that has the queries and a cell can tell.
        reach = _Reach(self)
        visits = self._kept(floored.withColumns({"first": F.size("qcells"), "later": reach.count()}).drop("query_id", "found", "kth"), "later-cells")
        again = visits.where("later > 0").drop("first", "later")
        named = again.withColumn("qcells", reach.cells())
        late_facts = knn.measure(named, broadcast_limit)
        late = hits_in(named if late_facts.rows is not None or not late_facts.n else again, late_facts, reach)
        ranked = knn.merge_hits(early.unionByName(late), facts.k)
        found = knn._finish(ranked, corpus.drop(*OWN), asked, facts, key, vector, metadata, with_vectors, keep_empty, broadcast_limit)
        return found, visits.select(F.col("qid").alias("query_id"), "first", "later", F.lit(n + self.entry["odd"]).alias("cells"))

    def _cells_of(self, column, pick):
        shipped, dim, odd = self._shipped(), self.dim, self.entry["odd"]

        @F.arrow_udf(T.ArrayType(T.IntegerType()))
        def cells(vectors: pa.Array) -> pa.Array:
            found = pick(received(shipped.value), to_matrix(vectors, dim))
            if odd:  # rows that no distance places are always looked at
                found = np.column_stack([found, np.full(len(found), ODD)])
            return _lists(found.astype(np.int32), pa.int32())

        return cells(column.cast(FLOATS))

    def query_facts(self, queries: DataFrame, query_vector: str = "vector") -> dict:
        """Where queries lie, seen from the index: how many, the mean distance to the nearest centre (or of what the components leave of a vector), and their mean.

        Tasks add up their queries; what comes back is a number per dimension.
        """
        shipped, dim, space, cells = self._shipped(), self.dim, self.space, self.entry["kind"] == "cells"

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, far, sums = 0, 0.0, np.zeros(space.width)
            for batch in batches:
                q, model = to_matrix(batch.column("q"), dim), received(shipped.value)
                p = space.of_queries(q)
                near = model.fine[model.probe(q, 1)[:, 0]] if cells else (p @ model) @ model.T
                n, far, sums = n + len(p), far + np.sqrt(((p - near) ** 2).sum(axis=1)).sum(), sums + p.sum(axis=0)
            # Places -1 and -2 hold the number of queries and their distances.
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-2, len(sums)), pa.int32()), pa.array(np.concatenate([[far, n], sums]))], names=["place", "total"])

        vectors = queries.where(F.col(query_vector).isNotNull()).select(F.col(query_vector).cast(FLOATS).alias("q"))
        totals = {r.place: r.total for r in vectors.mapInArrow(add_up, "place int, total double").groupBy("place").agg(F.sum("total").alias("total")).collect()}
        n = totals.get(-1, 0.0)
        return {"queries": int(n), "gap": totals.get(-2, 0.0) / n if n else 0.0, "mean": [totals.get(i, 0.0) / n if n else 0.0 for i in range(space.width)]}

    def _shipped(self):
        return self.spark.sparkContext.broadcast(self.model.plain() if isinstance(self.model, Cells) else self.model)

    def _celled(self) -> DataFrame:
        return self.stored_rows()

    def _layout(self) -> dict:
        return {"cell": "_cell", "shelf_of": {ODD: -1} | dict(enumerate(self.model.parent.tolist()))}

    def _visible(self, options: dict) -> dict:
        """The options, with ``metadata=True`` meaning the columns of the corpus."""
        self._own_names(options)
        if options.get("metadata") is True:
            options = options | {"metadata": [c for c in self.rows().columns if c not in self.names.values()]}
        return self.names | {"metric": self.metric} | options

    def _own_names(self, options: dict) -> None:
        for name, own in (self.names | {"metric": self.metric}).items():
            given = options.get(name, own)
            if (metric_name(given) if name == "metric" else given) != own:
                raise ValueError(f"{name} is {own!r} in this index")

    def _by_pca(self, queries: DataFrame, candidate_multiplier: int, **options) -> DataFrame:
        options = {
            "query_id": "query_id", "query_vector": "vector", "top_k": 10, "min_score": None, "max_distance": None, "filter": None, "filter_on": None,
            "metadata": False, "with_vectors": False, "keep_empty": False, "broadcast_limit": knn.BROADCAST_LIMIT,
        } | self._visible(options)
        options["metric"] = self.metric
        rows = self.stored_rows()
        whole = lambda df, column: df.withColumn("_whole", F.col(column))
        reduced = whole(queries, options["query_vector"]).withColumn(options["query_vector"], _reduced(options["query_vector"], self.space, self.model, rows=False))
        return ann.rescored(rows.drop("_reduced"), queries, whole(rows, self.entry["vector"]), reduced, candidate_metric="euclidean", candidate_multiplier=candidate_multiplier, reduced_vector="_reduced", **options)

    def _kept(self, df: DataFrame, purpose: str) -> DataFrame:
        path = shared_dir(self.spark, purpose)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


class _Reach:
    """The cells that queries (qvec, qfloor) look into beside those they have seen (qcells), by the bounds of the cells."""

    def __init__(self, index: Index):
        self.shipped, self.dim = index._shipped(), index.dim

    def _tiles(self):
        """A function of vectors, floors and seen cells that gives, tile by tile, whether each query looks into each cell."""
        shipped, dim = self.shipped, self.dim

        def tiles(vectors: pa.Array, floors: pa.Array, seen: pa.Array) -> Iterator[np.ndarray]:
            q, model = to_matrix(vectors, dim), received(shipped.value)
            low = floors.to_numpy(zero_copy_only=False).astype(np.float64)
            low = np.where(np.isnan(low), -np.inf, low)
            step = max(1, 4_000_000 // len(model.fine))
            for at in range(0, len(q), step):
                reach = model.reached(q[at : at + step], low[at : at + step])
                part = seen.slice(at, step)
                owner, taken = np.repeat(np.arange(len(part)), pc.list_value_length(part).to_numpy()), part.flatten().to_numpy()
                reach[owner[taken >= 0], taken[taken >= 0]] = False
                yield reach

        return tiles

    def _of_queries(self, kind: T.DataType, made):
        tiles = self._tiles()

        @F.arrow_udf(kind)
        def of_queries(vectors: pa.Array, floors: pa.Array, seen: pa.Array) -> pa.Array:
            return pa.concat_arrays([made(np.zeros((0, 0), bool)), *(made(reach) for reach in tiles(vectors, floors, seen))])

        return of_queries("qvec", "qfloor", "qcells")

    def count(self) -> Column:
        return self._of_queries(T.IntegerType(), lambda reach: pa.array(reach.sum(axis=1), pa.int32()))

    def cells(self) -> Column:
        return self._of_queries(T.ArrayType(T.IntegerType()), _places)

    def columns(self, places: dict[int, tuple[int, int]], total: int) -> Column:
        """The columns of a grid that hold the cells a query looks into; ``places`` has the first column of a cell and their number."""
        cells = np.array(sorted(places))
        held = np.zeros((len(cells), total), np.float32)
        for i, c in enumerate(cells.tolist()):
            held[i, places[c][0] : sum(places[c])] = 1
        return self._of_queries(T.ArrayType(T.IntegerType()), lambda reach: _places(reach[:, cells] @ held > 0 if len(reach) else reach))

    def loads(self, asked: DataFrame) -> dict[int, int]:
        """How many queries look into each cell; tasks add up their own."""
        tiles = self._tiles()

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0
            for batch in batches:
                for reach in tiles(*batch.columns):
                    total = total + reach.sum(axis=0)
            cells = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(np.atleast_1d(total)[cells], pa.int64())], names=["cell", "n"])

        parts = asked.select("qvec", "qfloor", "qcells").mapInArrow(add_up, "cell int, n long")
        return dict(parts.groupBy("cell").agg(F.sum("n")).collect())

    def probing(self):
        shipped = self.shipped
        return lambda best: _Probes(received(shipped.value), best.q, best.floor, best.probes)


class _Probes:
    """In a task: which of its queries look into a cell. Cells are asked for in order of their number, so a few are worked out at a time."""

    def __init__(self, model: Cells, q: np.ndarray, floor: np.ndarray, seen: dict[int, np.ndarray]):
        self.model, self.q, self.floor, self.seen, self.known = model, q, floor, seen, {}

    def get(self, cell: int) -> np.ndarray | None:
        if cell not in self.known:
            end = min(cell + PROBED_AT_ONCE, len(self.model.fine))
            reach = self.model.reached(self.q, self.floor, slice(cell, end))
            self.known = {}
            for c in range(cell, end):
                reach[self.seen.get(c, []), c - cell] = False
                self.known[c] = np.flatnonzero(reach[:, c - cell])
        return self.known[cell]


def _places(mask: np.ndarray) -> pa.Array:
    """The places of the true values of each row."""
    ends = np.cumsum(mask.sum(axis=1))
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(np.nonzero(mask)[1], pa.int32()))


def _best_hits(hits: DataFrame, k_max: int) -> DataFrame:
    """The best k of each query, unranked, in the layout of hits."""
    order = Window.partitionBy("query_id").orderBy(F.desc("goodness"), F.asc("key"))
    ranked = hits.withColumn("place", F.row_number().over(order))
    return ranked.where((F.col("place") <= k_max) & (F.col("place") <= F.col("qk"))).drop("place")
