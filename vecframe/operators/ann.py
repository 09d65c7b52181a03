"""Approximate search: reduced-dimension candidates, inverted-file cells, and recall-driven choice.

Both methods are fitted with Spark ML, keep their small model (components or centroids) as a numpy
array, and end in an exact score, so only the set of candidates is approximate.
"""

from __future__ import annotations

import math
import time

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecframe.operators import knn
from vecframe.operators.evaluate import recall_at_k
from vecframe.operators.metrics import metric_name
from vecframe.operators.topk import METRIC_CODES
from vecframe.operators.vectors import l2_normalize, nearest_cells, project
from vecframe.session import scan_tasks

DEFAULT_TARGET_RECALL = 0.95


def _training_vectors(corpus: DataFrame, vector: str, metric: str) -> DataFrame:
    rows = corpus.where(F.col(vector).isNotNull())
    column = F.col(vector).cast("array<float>")
    if metric == "cosine":
        column = l2_normalize(column)
    return rows.select(array_to_vector(column.cast("array<double>")).alias("features"))


# --- reduced dimensions -------------------------------------------------------------------------


def fit_pca(corpus: DataFrame, reduced_dimensions: int, *, vector: str = "vector", metric: str = "cosine") -> np.ndarray:
    """Principal components, as a (dimension x reduced) matrix."""
    if reduced_dimensions < 1:
        raise ValueError("reduced_dimensions must be at least 1")
    training = _training_vectors(corpus, vector, metric_name(metric))
    model = PCA(k=reduced_dimensions, inputCol="features", outputCol="reduced").fit(training)
    return model.pc.toArray()


def reduce_vectors(df: DataFrame, components: np.ndarray, *, vector: str = "vector", metric: str = "cosine") -> DataFrame:
    """``df`` with ``vector`` replaced by its reduced form; write it as a table to reuse it."""
    unit = metric_name(metric) == "cosine"
    return df.where(F.col(vector).isNotNull()).withColumn(vector, project(F.col(vector), components, unit))


def knn_pca(
    corpus: DataFrame,
    queries: DataFrame,
    components: np.ndarray,
    *,
    reduced: DataFrame | None = None,
    candidate_multiplier: int = 10,
    key: str = "key",
    vector: str = "vector",
    query_id: str = "query_id",
    query_vector: str = "vector",
    top_k: int | Column = 10,
    metric: str = "cosine",
    min_score: float | Column | None = None,
    max_distance: float | Column | None = None,
    filter: dict[str, object] | None = None,
    filter_on: dict[str, str] | None = None,
    metadata: list[str] | bool = False,
    with_vectors: bool = False,
    keep_empty: bool = False,
    broadcast_limit: int = knn.BROADCAST_LIMIT,
) -> DataFrame:
    """Candidates (``candidate_multiplier x top_k``) by reduced vectors, then exact scores.

    ``reduced`` is the stored output of ``reduce_vectors``; without it the corpus is reduced on the
    fly. The projection does not subtract the mean, so candidates of cosine and euclidean rank by
    distance, which a shift does not change.
    """
    metric = metric_name(metric)
    if reduced is None:
        reduced = reduce_vectors(corpus.withColumn("_whole", F.col(vector)), components, vector=vector, metric=metric)
    reduced_queries = queries.withColumn("_whole", F.col(query_vector))
    return rescored(
        corpus, queries, reduced, reduce_vectors(reduced_queries, components, vector=query_vector, metric=metric),
        candidate_metric="dot_product" if metric == "dot_product" else "euclidean", candidate_multiplier=candidate_multiplier,
        key=key, vector=vector, reduced_vector=vector, query_id=query_id, query_vector=query_vector, top_k=top_k, metric=metric,
        min_score=min_score, max_distance=max_distance, filter=filter, filter_on=filter_on, metadata=metadata,
        with_vectors=with_vectors, keep_empty=keep_empty, broadcast_limit=broadcast_limit,
    )


def rescored(
    corpus: DataFrame, queries: DataFrame, reduced: DataFrame, reduced_queries: DataFrame, *, candidate_metric: str,
    candidate_multiplier: int, key: str, vector: str, reduced_vector: str, query_id: str, query_vector: str, top_k: int | Column,
    metric: str, min_score, max_distance, filter, filter_on, metadata, with_vectors: bool, keep_empty: bool, broadcast_limit: int,
) -> DataFrame:
    """Candidates by the reduced vectors, and the best of them by the exact score.

    ``reduced`` holds the corpus columns that filters use, and ``reduced_vector``; ``reduced_queries`` the reduced vector in place of the query's own,
    and that as ``_whole``. If ``reduced`` holds the rows' own vectors as ``_whole`` too, they are not looked up by key.
    """
    if candidate_multiplier < 1:
        raise ValueError("candidate_multiplier must be at least 1")
    asked = knn.query_table(
        queries, query_id=query_id, query_vector=query_vector, top_k=top_k, metric=metric,
        min_score=min_score, max_distance=max_distance, filter_on=None,
    )
    facts = knn.measure(asked, broadcast_limit)
    finish = lambda ranked: knn._finish(ranked, corpus, asked, facts, key, vector, metadata, with_vectors, keep_empty, broadcast_limit)
    if facts.n == 0:
        return finish(knn.merge_hits(knn._no_hits(asked, corpus.select(F.col(key).alias("key"))), 1))
    first_k = (F.coalesce(top_k, F.lit(10)) if isinstance(top_k, Column) else top_k) * candidate_multiplier
    if facts.rows is None:
        filters = filter_on or {}
        first = knn.query_table(
            reduced_queries, query_id=query_id, query_vector=query_vector, top_k=first_k, metric=candidate_metric, min_score=None, max_distance=None,
            filter_on=filter_on, extra=[F.col("_whole").cast("array<float>").alias("qwhole")],
        )
        rows = knn.where_equal(reduced, filter)
        if "_whole" not in rows.columns:
            wholes = corpus.where(F.col(vector).isNotNull()).select(F.col(key).alias("_key"), F.col(vector).alias("_whole"))
            rows = rows.join(wholes, F.col(key) == F.col("_key"))
        rows = rows.select(
            F.col(key).alias("key"), F.col(reduced_vector).cast("array<float>").alias("vec"),
            *[F.col(c).alias(f"f_{i}") for i, c in enumerate(filters)], F.col("_whole").cast("array<float>").alias("whole"),
        )
        return finish(_rescored_in_grid(rows, first, asked, facts, metric, broadcast_limit))
    candidates = knn.knn_join(
        reduced,
        reduced_queries,
        key=key,
        vector=reduced_vector,
        query_id=query_id,
        query_vector=query_vector,
        top_k=first_k,
        metric=candidate_metric,
        filter=filter,
        filter_on=filter_on,
        broadcast_limit=broadcast_limit,
    ).select("query_id", "key")
    few = facts.n * facts.k * candidate_multiplier * 64 <= broadcast_limit
    hint = F.broadcast if few else lambda df: df
    rows = corpus.select(F.col(key).alias("key"), F.col(vector).cast("array<float>").alias("vec"))
    # The query vectors travel once per task; a candidate row brings the ids that ask for it, at
    # most one per query.
    asking = candidates.groupBy("key").agg(F.collect_list("query_id").alias("asking"))
    hits = knn.scan_hits(rows.join(hint(asking), "key"), facts.rows, facts.dim)
    return finish(knn.merge_hits(hits, facts.k, scan_tasks(corpus)))


def _rescored_in_grid(rows: DataFrame, first: DataFrame, asked: DataFrame, facts: knn.Asked, metric: str, limit: int) -> DataFrame:
    """Candidates of many queries: whole vectors travel beside the reduced ones, and a candidate gets its exact score in the task that finds it, so that no pair is joined to its vectors."""
    reduced = knn.measure(first, limit)
    both = knn.Asked(reduced.n, reduced.dim, reduced.k, reduced.bytes + 4 * facts.dim * reduced.n)
    found = knn._grid_hits(rows, first, both, limit, (facts.dim, METRIC_CODES[metric]))
    order = Window.partitionBy("query_id").orderBy(F.col("goodness").desc(), F.col("key").asc())
    found = found.withColumn("place", F.row_number().over(order))
    found = found.where((F.col("place") <= both.k) & (F.col("place") <= F.col("qk"))).select("query_id", "key", F.col("whole").alias("goodness"))
    scored = found.join(asked.select("qid", "qk", "qfloor", "qmetric"), F.col("query_id") == F.col("qid"))
    scored = scored.where(~F.isnan("goodness") & (F.col("qfloor").isNull() | (F.col("goodness") >= F.col("qfloor"))))
    return knn.merge_hits(scored.select("query_id", "key", "goodness", "qk", "qmetric"), facts.k)


# --- inverted-file cells ------------------------------------------------------------------------


def fit_cells(
    corpus: DataFrame, n_cells: int | None = None, *, vector: str = "vector", metric: str = "cosine",
    seed: int = 7, max_iter: int = 10, rows_per_cell: int | None = None,
) -> np.ndarray:
    """k-means centroids as a (cells x dimension) matrix; about sqrt(rows) cells by default.

    All rows are used, unless ``rows_per_cell`` asks for a sample of about so many per cell. Centres start from random rows,
    since the usual start picks candidates on the driver, which takes over with thousands of cells. Search always covers all rows.
    """
    rows = corpus.where(F.col(vector).isNotNull()).count()
    if n_cells is None:
        n_cells = max(2, int(math.sqrt(rows)))
    if n_cells < 2:
        raise ValueError("n_cells must be at least 2")
    training = _training_vectors(corpus, vector, metric_name(metric))
    if rows_per_cell is not None and n_cells * rows_per_cell < rows:
        training = training.sample(n_cells * rows_per_cell / rows, seed=seed)
    model = KMeans(k=n_cells, seed=seed, maxIter=max_iter, featuresCol="features", initMode="random").fit(training)
    return np.array(model.clusterCenters())


def assign_cells(corpus: DataFrame, centroids: np.ndarray, *, vector: str = "vector", metric: str = "cosine") -> DataFrame:
    """``corpus`` with its ``cell``."""
    unit = metric_name(metric) == "cosine"
    rows = corpus.where(F.col(vector).isNotNull())
    return rows.withColumn("cell", nearest_cells(F.col(vector), centroids, 1, unit)[0])


def write_cells(celled: DataFrame, path: str, *, key: str = "key", parts: int = 4) -> None:
    """Store by cell, so that a search reads only the cells it probes.

    A cell is dealt by hashes of its keys over ``parts`` tasks, so a large one does not end in one task, and rows are assigned once.
    """
    placed = celled.repartition("cell", F.pmod(F.xxhash64(key), F.lit(parts)))
    placed.write.mode("overwrite").partitionBy("cell").parquet(path)


def knn_ivf(
    celled: DataFrame,
    queries: DataFrame,
    centroids: np.ndarray,
    *,
    nprobe: int = 8,
    query_vector: str = "vector",
    metric: str = "cosine",
    **options,
) -> DataFrame:
    """Exact scores within the ``nprobe`` cells nearest to each query; all cells give exact search. Options as in ``knn_join``."""
    if nprobe < 1:
        raise ValueError("nprobe must be at least 1")
    metric = metric_name(metric)
    nprobe = min(nprobe, len(centroids))
    qcells = nearest_cells(F.col(query_vector), centroids, nprobe, metric == "cosine")
    return knn_in_cells(celled, queries, qcells, prune=nprobe < len(centroids), query_vector=query_vector, metric=metric, **options)


def knn_in_cells(
    celled: DataFrame,
    queries: DataFrame,
    qcells: Column,
    *,
    cell: str = "cell",
    prune: bool = True,
    shelf_of: dict[int, int] | None = None,
    key: str = "key",
    vector: str = "vector",
    query_id: str = "query_id",
    query_vector: str = "vector",
    top_k: int | Column = 10,
    metric: str | Column = "cosine",
    min_score: float | Column | None = None,
    max_distance: float | Column | None = None,
    filter: dict[str, object] | None = None,
    filter_on: dict[str, str] | None = None,
    metadata: list[str] | bool = False,
    with_vectors: bool = False,
    keep_empty: bool = False,
    broadcast_limit: int = knn.BROADCAST_LIMIT,
) -> DataFrame:
    """Exact scores within the cells that each query names in ``qcells``.

    With ``prune`` the scan is narrowed to the cells that any query names; ``shelf_of`` tells the folder ``_shelf`` of each cell, if there are any.
    """
    celled = knn.where_equal(celled, filter)
    asked = knn.query_table(
        queries, query_id=query_id, query_vector=query_vector, top_k=top_k, metric=metric,
        min_score=min_score, max_distance=max_distance, filter_on=filter_on, extra=[qcells.alias("qcells")],
    )
    facts = knn.measure(asked, broadcast_limit)
    hits = cell_search_hits(celled, asked, facts, cell=cell, prune=prune, shelf_of=shelf_of, key=key, vector=vector, filter_on=filter_on, limit=broadcast_limit)
    return knn._finish(
        knn.merge_hits(hits, facts.k, scan_tasks(celled)), celled, asked, facts, key, vector, metadata, with_vectors, keep_empty, broadcast_limit
    )


def cell_search_hits(celled, asked, facts, *, cell, prune, shelf_of, key, vector, filter_on, limit, reach=None) -> DataFrame:
    """Best rows per task or grid cell, before they are merged. ``reach``: see ``cell_grid_hits``; queries that fit the limit need their ``qcells`` nevertheless."""
    wanted = [F.col(c).alias(f"f_{i}") for i, c in enumerate(filter_on or {})]
    pick = lambda df: df.select(F.col(cell).alias("cell"), F.col(key).alias("key"), F.col(vector).cast("array<float>").alias("vec"), *wanted)
    if facts.n == 0:
        return knn._no_hits(asked, pick(celled))
    if facts.rows is None:
        if not prune:
            # Every query looks into every cell, so cells need not be kept together.
            return knn._grid_hits(pick(celled).drop("cell"), asked.drop("qcells"), knn.without_lists(facts), limit)
        return cell_grid_hits(pick(celled), asked, facts, limit, reach=reach)
    if prune:
        probed = sorted(set(facts.rows.column("qcells").combine_chunks().flatten().to_pylist()))
        if shelf_of is not None:
            celled = celled.where(F.col("_shelf").isin(sorted({shelf_of[c] for c in probed})))
        celled = celled.where(F.col(cell).isin(probed))
    return knn.scan_hits(pick(celled), facts.rows, facts.dim)


def cell_grid_hits(rows: DataFrame, asked: DataFrame, facts: knn.Asked, limit: int, apart: int | None = None, reach=None) -> DataFrame:
    """Rows and queries meet in a grid whose columns hold whole cells, with their neighbours by number, up to an equal share of the work.

    A query travels once to a column, with the cells it names there, and not once per cell. The work of a cell is its rows times the queries that name it; one with more
    than a share is dealt over columns of its own by a hash of the keys. ``apart``: cells of different multiples of that number share no column.
    With ``reach`` queries do not name cells: it tells from the queries how many look into each cell (``loads``), in which columns they meet them (``columns``),
    and in the task itself which of them look into a cell (``probing``), so that what travels does not grow with the number of cells.
    """
    spark = rows.sparkSession
    sizes = dict(rows.groupBy("cell").count().collect())
    if reach is None:
        loads = dict(asked.select(F.explode("qcells").alias("cell")).groupBy("cell").count().collect())
    else:
        facts, loads = knn.without_lists(facts), reach.loads(asked)
    n_rows, n_columns = knn.grid_shape(rows, facts, limit)
    places, total = _columns({c: sizes[c] * n for c, n in loads.items() if c in sizes}, n_columns, apart)
    if not places:
        return knn._no_hits(asked, rows)
    # At most one row per cell.
    layout = F.broadcast(spark.createDataFrame([(c, *place) for c, place in places.items()], "cell int, first int, parts int"))
    met = rows.join(layout, "cell").withColumn("column", (F.col("first") + F.pmod(F.xxhash64("key"), F.col("parts"))).cast("int")).drop("first", "parts")
    if reach is not None:
        return knn.grid_hits(met, asked.withColumn("column", F.explode(reach.columns(places, total))), facts.dim, n_rows, total, probing=reach.probing())
    routed = asked.withColumn("route", F.explode(_routes(places)("qcells"))).withColumn("column", F.col("route.column")).withColumn("qcells", F.col("route.cells")).drop("route")
    return knn.grid_hits(met, routed, facts.dim, n_rows, total)


def _columns(work: dict[int, int], n_columns: int, apart: int | None) -> tuple[dict[int, tuple[int, int]], int]:
    """(first column, number of columns) of each cell, and the number of columns."""
    share = max(1.0, sum(work.values()) / n_columns)
    places, column, filled, last = {}, -1, math.inf, None
    for cell, load in sorted(work.items()):
        group = cell // apart if apart else None
        parts = math.ceil(load / share)
        if parts > 1 or filled + load > share or group != last:
            column, filled = column + 1, 0
        places[cell] = (column, max(1, parts))
        if parts > 1:
            column, filled = column + parts - 1, math.inf
        else:
            filled += load
        last = group
    return places, column + 1


def _routes(places: dict[int, tuple[int, int]]):
    """For a query's cells the columns they lie in, each with its own of them."""
    cells = np.array(sorted(places), np.int64)
    first, parts = np.array([places[c] for c in cells.tolist()], np.int64).T

    @F.arrow_udf(T.ArrayType(T.StructType([T.StructField("column", T.IntegerType()), T.StructField("cells", T.ArrayType(T.IntegerType()))])))
    def route(lists: pa.Array) -> pa.Array:
        owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        named = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.minimum(np.searchsorted(cells, named), len(cells) - 1)
        known = cells[at] == named  # a cell without rows has no column
        owner, named, at = owner[known], named[known], at[known]
        again = parts[at]
        nth = np.arange(again.sum()) - np.repeat(np.cumsum(again) - again, again)
        owner, named, column = np.repeat(owner, again), np.repeat(named, again), np.repeat(first[at], again) + nth
        order = np.lexsort((named, column, owner))
        owner, named, column = owner[order], named[order], column[order]
        starts = np.flatnonzero(np.r_[True, (np.diff(owner) != 0) | (np.diff(column) != 0)]) if len(owner) else np.zeros(0, np.int64)
        held = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(owner)], pa.int32()), pa.array(named, pa.int32()))
        routes = pa.StructArray.from_arrays([pa.array(column[starts], pa.int32()), held], names=["column", "cells"])
        ends = np.cumsum(np.bincount(owner[starts], minlength=len(lists)))
        return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), routes)

    return route


# --- choosing a method by recall ----------------------------------------------------------------

# Settings tried, from cheap to dear: (share of the dimensions, candidate multiplier), share of the cells.
PCA_SETTINGS = [(0.125, 10), (0.25, 10), (0.5, 10), (0.5, 20), (0.75, 10)]
CELL_SHARES = [0.01, 0.05, 0.25, 0.5, 0.75]
# Queries that tuning asks at most.
SAMPLE_QUERIES = 1000


def check_target_recall(target: float) -> float:
    if not 0.50 <= target <= 0.999:
        raise ValueError(f"target_recall must be between 0.50 and 0.999; got {target}")
    return target


def tune_recall(
    corpus: DataFrame,
    queries: DataFrame,
    *,
    target_recall: float = DEFAULT_TARGET_RECALL,
    key: str = "key",
    vector: str = "vector",
    query_id: str = "query_id",
    query_vector: str = "vector",
    top_k: int = 10,
    metric: str = "cosine",
    exact_below: int = 0,
    n_cells: int | None = None,
    sample_queries: int = SAMPLE_QUERIES,
) -> tuple[dict, DataFrame]:
    """The cheapest setting whose measured recall meets the target, and the report behind it.

    ``queries`` stands for the workload; at most ``sample_queries`` of them, by a hash of their ids, are asked exactly and with each setting.
    Cost is the seconds that took, with what a search can store beforehand (reduced vectors, cells) stored. A caller may ask for exact search below ``exact_below`` rows;
    exact search is also the answer when no approximate setting reaches the target. ``tuning.keep_target`` keeps a choice with an index.
    """
    check_target_recall(target_recall)
    metric = metric_name(metric)
    names = {"key": key, "vector": vector, "query_id": query_id, "query_vector": query_vector}
    options = {**names, "top_k": top_k, "metric": metric}
    facts = corpus.where(F.col(vector).isNotNull()).agg(F.count("*").alias("rows"), F.max(F.size(vector)).alias("dim")).first()
    tried = [{"method": "exact", "params": {}, "recall": 1.0, "cost": 0.0}]
    if facts.rows >= exact_below and facts.rows > 0:
        asked = queries.orderBy(F.xxhash64(query_id), query_id).limit(sample_queries).persist()
        truth = knn.knn_join(corpus, asked, **options).persist()
        truth.count()

        def measured(search) -> tuple[float, float]:
            start = time.perf_counter()
            hits = search().persist()
            hits.count()
            seconds = time.perf_counter() - start
            recall = recall_at_k(hits, truth, top_k).first().recall or 0.0
            hits.unpersist()
            return recall, seconds

        tried[0]["cost"] = measured(lambda: knn.knn_join(corpus, asked, **options))[1]
        # Components come in order of variance, so the widest fit holds all narrower ones.
        widest = max(1, int(facts.dim * max(share for share, _ in PCA_SETTINGS)))
        components = fit_pca(corpus, widest, vector=vector, metric=metric)
        for share, multiplier in PCA_SETTINGS:
            reduced_dimensions = max(1, int(facts.dim * share))
            narrow = components[:, :reduced_dimensions]
            reduced = reduce_vectors(corpus, narrow, vector=vector, metric=metric).persist()
            reduced.count()
            recall, seconds = measured(lambda: knn_pca(corpus, asked, narrow, reduced=reduced, candidate_multiplier=multiplier, **options))
            reduced.unpersist()
            params = {"reduced_dimensions": reduced_dimensions, "candidate_multiplier": multiplier}
            tried.append({"method": "pca", "params": params, "recall": recall, "cost": seconds})
        centroids = fit_cells(corpus, n_cells, vector=vector, metric=metric)
        celled = assign_cells(corpus, centroids, vector=vector, metric=metric).persist()
        celled.count()
        for nprobe in sorted({max(1, int(len(centroids) * share)) for share in CELL_SHARES}):
            recall, seconds = measured(lambda: knn_ivf(celled, asked, centroids, nprobe=nprobe, **options))
            tried.append({"method": "ivf", "params": {"n_cells": len(centroids), "nprobe": nprobe}, "recall": recall, "cost": seconds})
        for held in (celled, truth, asked):
            held.unpersist()
    choice = min((t for t in tried if t["recall"] >= target_recall), key=lambda t: (t["cost"], t["method"]))
    return choice, _report(corpus.sparkSession, tried, choice)


def _report(spark: SparkSession, tried: list[dict], choice: dict) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("method", T.StringType()),
            T.StructField("params", T.MapType(T.StringType(), T.IntegerType())),
            T.StructField("recall", T.DoubleType()),
            T.StructField("cost", T.DoubleType()),
            T.StructField("chosen", T.BooleanType()),
        ]
    )
    return spark.createDataFrame(
        [(t["method"], t["params"], t["recall"], t["cost"], t is choice) for t in tried], schema
    )


# --- one entry point by index name --------------------------------------------------------------

INDEX_PARAMETERS = {
    "pca": {"reduced_dimensions", "candidate_multiplier"},
    "ivf": {"n_cells", "nprobe"},
}
# Cells serve every named neighbour index other than pca.
INDEX_ALIASES = {"pca": "pca", "ivf": "ivf", "hnsw": "ivf"}


def search(
    corpus: DataFrame, queries: DataFrame, *, use_index: str | None = None,
    index_params: dict[str, int] | None = None, index_path: str | None = None, target_recall: float | None = None, **options,
) -> DataFrame:
    """kNN join by exact scan or by a named index.

    With ``index_path`` the index is kept in that folder: built by the first call, opened by later ones, and refused (``StaleIndex``) once
    the corpus has changed. With ``target_recall`` too, the setting is the one tuned for that target, see ``tuning.keep_target``.
    Without a folder the index is fitted for this call alone.
    """
    if use_index is None and index_path is None:
        if index_params is not None:
            raise ValueError("index_params requires use_index")
        if target_recall is not None:
            raise ValueError("target_recall requires index_path, where the choice is kept")
        return knn.knn_join(corpus, queries, **options)
    use_index = use_index or "ivf"
    if use_index not in INDEX_ALIASES:
        raise ValueError(f"use_index {use_index!r} is not one of {sorted(INDEX_ALIASES)}")
    index, params = INDEX_ALIASES[use_index], dict(index_params or {})
    unknown = set(params) - INDEX_PARAMETERS[index]
    if unknown:
        raise ValueError(f"unknown parameters for {use_index!r}: {sorted(unknown)}")
    fitting = {"vector": options.get("vector", "vector"), "metric": options.get("metric", "cosine")}
    if index_path is not None:
        from vecframe.operators import index as kept, tuning  # they build on this module

        own = {name: options.pop(name) for name in ("key", "vector", "metric") if name in options}
        fixed = {name: params.pop(name) for name in ("n_cells", "reduced_dimensions") if name in params}
        opened = kept.open_or_build(corpus, index_path, "pca" if index == "pca" else "cells", **own, **fixed)
        if target_recall is not None:
            return tuning.keep_target(opened, queries, index_path, target_recall=target_recall, **options)
        return opened.search(queries, **params, **options)
    if target_recall is not None:
        raise ValueError("target_recall requires index_path, where the choice is kept")
    if index == "pca":
        components = fit_pca(corpus, params.pop("reduced_dimensions", 64), **fitting)
        return knn_pca(corpus, queries, components, **params, **options)
    centroids = fit_cells(corpus, params.pop("n_cells", None), **fitting)
    return knn_ivf(assign_cells(corpus, centroids, **fitting), queries, centroids, **params, **options)
