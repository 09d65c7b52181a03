"""Exact k-nearest-neighbour search: one query, or a join of a query table with a vector table.

The result columns are always ``query_id, rank, key, score``, then any payload asked for.

How the work is laid out:

* A query table whose measured size fits ``broadcast_limit`` travels to the tasks; the corpus is
  scanned in place, in its own splits and without a shuffle, and each task sends on at most ``k`` rows per query.
* A larger query table is spread over a grid of as many cells as keep all tasks busy. Each cell streams its corpus
  rows past its queries, so memory does not grow with the corpus. A corpus row is copied once per row of the grid, a query and
  its hits once per column, so the grid has the shape that moves least, with each part of the queries within
  the same limit. Until that limit asks for more rows, what moves grows in proportion to both tables.

Filters are applied before scoring, so ``k`` counts matching rows only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from vecframe.operators.metrics import METRIC_ALIASES, metric_column, metric_name
from vecframe.operators.points import MOST_PUSHED, among
from vecframe.operators.topk import EUCLIDEAN, METRIC_CODES, TopK
from vecframe.session import estimated_bytes, scan_tasks, shuffle_tasks, task_slots

BROADCAST_LIMIT = 64 * 1024 * 1024
TASKS_PER_SLOT = 3
MERGE_FAN_IN = 64
# Cells of a grid, on however small a cluster, if a shuffle has so many tasks.
LEAST_CELLS = 48
# About the bytes of a hit on its way to the merge.
HIT_BYTES = 48


def knn_join(
    corpus: DataFrame,
    queries: DataFrame,
    *,
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
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """The ``top_k`` best corpus rows for every row of ``queries``.

    ``top_k``, ``metric``, ``min_score`` and ``max_distance`` may be columns of ``queries``.
    ``filter`` holds equality predicates on the corpus for all queries; ``filter_on`` maps a corpus
    column to the query column with the wanted value (null = no constraint). ``keep_empty`` keeps a
    query without hits as one row with null rank, key and score.
    Keys must be unique in the corpus, query ids in the query table.
    """
    corpus = where_equal(corpus, filter)
    asked = query_table(
        queries,
        query_id=query_id,
        query_vector=query_vector,
        top_k=top_k,
        metric=metric,
        min_score=min_score,
        max_distance=max_distance,
        filter_on=filter_on,
    )
    facts = measure(asked, broadcast_limit)
    rows = corpus.select(
        F.col(key).alias("key"),
        F.col(vector).cast("array<float>").alias("vec"),
        *[F.col(c).alias(f"f_{i}") for i, c in enumerate(filter_on or {})],
    )
    if facts.n == 0:
        hits = _no_hits(asked, rows)
    elif facts.rows is not None:
        hits = scan_hits(_wanted_rows(rows, facts.rows), facts.rows, facts.dim)
    else:
        hits = _grid_hits(rows, asked, facts, broadcast_limit)
    ranked = merge_hits(hits, facts.k, scan_tasks(corpus))
    return _finish(
        ranked, corpus, asked, facts, key, vector, metadata, with_vectors, keep_empty, broadcast_limit
    )


def knn_single(corpus: DataFrame, vector: list[float], **options) -> DataFrame:
    """The best rows for one query vector, in rank order."""
    if vector is None or len(vector) == 0:
        raise ValueError("the query vector must not be empty")
    spark = corpus.sparkSession
    schema = T.StructType(
        [T.StructField("query_id", T.IntegerType()), T.StructField("query", T.ArrayType(T.FloatType()))]
    )
    one = spark.createDataFrame([(0, [float(x) for x in vector])], schema)
    column = options.pop("vector_column", "vector")
    hits = knn_join(corpus, one, vector=column, query_vector="query", **options)
    return hits.drop("query_id").orderBy("rank")


def query_batch(
    collections: dict[str, DataFrame], queries: DataFrame, *, collection: str = "collection", **options
) -> DataFrame:
    """Queries that each name their collection.

    An item that cannot be answered gives an empty result and leaves the others alone: an unknown collection or metric, no
    vector or one of another length than the collection's, a top_k below 1, or a bound that does not go with the metric.
    """
    if not collections:
        raise ValueError("no collections given")
    options.setdefault("keep_empty", True)
    parts, answerable = [], F.lit(False)
    for name, df in collections.items():
        # A collection is a table, or an index of one, which knows its own key, vector, metric and dimension.
        indexed = not isinstance(df, DataFrame)
        own = {n: v for n, v in options.items() if n not in ("key", "vector", "metric")} | {"metric": df.metric} if indexed else options
        if indexed:
            dimension = df.dim
        else:
            sized = df.where(F.col(options.get("vector", "vector")).isNotNull()).select(F.size(options.get("vector", "vector"))).first()
            dimension = sized[0] if sized else None
        sound = (F.col(collection) == name) & _sound(own, dimension)
        answerable = answerable | F.coalesce(sound, F.lit(False))
        asked = queries.where(sound)
        parts.append(df.search(asked, **{n: v for n, v in own.items() if n != "metric"}) if indexed else knn_join(df, asked, **own))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    if options["keep_empty"]:
        lost = queries.where(~answerable)
        lost = lost.select(F.col(options.get("query_id", "query_id")).alias("query_id"))
        result = result.unionByName(lost, allowMissingColumns=True)
    return result


def _sound(options: dict, dimension: int | None) -> Column:
    """Whether a query of a batch can be answered by a collection of that dimension."""
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    metric = options.get("metric", "cosine")
    known = F.create_map(*[F.lit(x) for pair in METRIC_ALIASES.items() for x in pair])
    resolved = F.try_element_at(known, metric) if isinstance(metric, Column) else F.lit(metric_name(metric))
    unused = F.when(resolved == "euclidean", as_column(options.get("min_score"))).otherwise(as_column(options.get("max_distance")))
    size = F.size(options.get("query_vector", "vector"))
    right_size = size == dimension if dimension is not None else size > 0
    top_k = F.coalesce(as_column(options.get("top_k", 10)), F.lit(10))
    return right_size & resolved.isNotNull() & unused.isNull() & (top_k >= 1) & F.col(options.get("query_id", "query_id")).isNotNull()


def where_equal(df: DataFrame, filter: dict[str, object] | None) -> DataFrame:
    """AND of scalar equalities, as plain predicates that reach the scan."""
    for name, value in (filter or {}).items():
        if isinstance(value, (dict, list, tuple, set)):
            raise ValueError(f"filter on {name!r} must be one scalar value")
        df = df.where(F.col(name).isNull() if value is None else F.col(name) == F.lit(value))
    return df


def query_table(
    queries: DataFrame,
    *,
    query_id: str,
    query_vector: str,
    top_k: int | Column,
    metric: str | Column,
    min_score: float | Column | None,
    max_distance: float | Column | None,
    filter_on: dict[str, str] | None,
    extra: list[Column] | None = None,
) -> DataFrame:
    """Queries in the layout that the top-k tasks read."""
    if isinstance(metric, str):
        metric = metric_name(metric)
        if metric == "euclidean" and min_score is not None:
            raise ValueError("min_score does not apply to euclidean distances; use max_distance")
        if metric != "euclidean" and max_distance is not None:
            raise ValueError("max_distance applies to euclidean only; use min_score")
        code = F.lit(METRIC_CODES[metric])
    else:
        names = F.create_map(*[F.lit(x) for pair in METRIC_CODES.items() for x in pair])
        code = F.element_at(names, metric_column(metric))
    if isinstance(top_k, int) and top_k < 1:
        raise ValueError("top_k must be at least 1")
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    low, far = as_column(min_score).cast("double"), as_column(max_distance).cast("double")
    misuse = F.raise_error(F.lit("min_score goes with cosine and dot_product, max_distance with euclidean"))
    floor = F.when(
        code == EUCLIDEAN, F.when(low.isNotNull(), misuse.cast("double")).otherwise(-far)
    ).otherwise(F.when(far.isNotNull(), misuse.cast("double")).otherwise(low))
    return queries.select(
        F.col(query_id).alias("qid"),
        F.col(query_vector).cast("array<float>").alias("qvec"),
        F.coalesce(as_column(top_k), F.lit(10)).cast("int").alias("qk"),
        floor.alias("qfloor"),
        code.cast("int").alias("qmetric"),
        *[F.col(c).alias(f"f_{i}") for i, c in enumerate((filter_on or {}).values())],
        *(extra or []),
    )


@dataclass
class Asked:
    """Measured queries: how many, how wide, and their rows when those fit the limit."""

    n: int
    dim: int
    k: int
    bytes: int
    rows: pa.Table | None = None
    #: Of the bytes, those of the lists of cells.
    listed: int = 0


def measure(asked: DataFrame, limit: int) -> Asked:
    """Size up the query table, and fetch it if it fits; broken queries are refused.

    The row count and one row decide whether it fits, so that queries that are costly to compute,
    such as embedded texts, are computed once.
    """
    listed = F.size("qcells") if "qcells" in asked.columns else F.lit(0)
    first = asked.select(F.size("qvec"), "qk", listed.alias("listed")).first()
    if first is None:
        return Asked(0, 0, 1, 0)
    *first, listed = first
    n = asked.count()
    wide = lambda dim, k: n * (4 * max(dim or 0, 0) + 24 * k + 4 * max(listed or 0, 0) + 64)
    if wide(*first) <= limit:
        rows = asked.toArrow()
        sizes = pc.list_value_length(rows.column("qvec"))
        if pc.count_distinct(rows.column("qid"), mode="only_valid").as_py() < len(rows) - rows.column("qid").null_count:
            raise ValueError("a query id occurs more than once")
        facts = (
            len(rows.column("qid")) - rows.column("qid").null_count, len(sizes) - sizes.null_count,
            pc.min(sizes).as_py(), pc.max(sizes).as_py(), pc.min(rows.column("qk")).as_py(), pc.max(rows.column("qk")).as_py(),
        )
    else:
        rows = None
        repeated = asked.where("qid is not null").groupBy("qid").count().where("count > 1").limit(1).collect()
        if repeated:
            raise ValueError("a query id occurs more than once")
        facts = asked.agg(
            F.count("qid"), F.count("qvec"), F.min(F.size("qvec")), F.max(F.size("qvec")), F.min("qk"), F.max("qk")
        ).first()
    ids, vectors, low, high, k_low, k_high = facts
    if ids < n or vectors < n:
        raise ValueError("every query needs an id and a vector")
    if low != high:
        raise ValueError(f"query vectors differ in dimension: {low} to {high}")
    if low < 1:
        raise ValueError("the query vector must not be empty")
    if k_low < 1:
        raise ValueError("top_k must be at least 1")
    return Asked(n, low, k_high, wide(low, k_high), rows if wide(low, k_high) <= limit else None, n * 4 * max(listed or 0, 0))


def without_lists(facts: Asked) -> Asked:
    """The measure of queries that leave their lists of cells behind, so that a grid does not grow with the number of cells."""
    return replace(facts, bytes=facts.bytes - facts.listed, listed=0)


def _hit_schema(id_type: T.DataType, key_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", id_type),
            T.StructField("key", key_type),
            T.StructField("goodness", T.DoubleType()),
            T.StructField("qk", T.IntegerType()),
            T.StructField("qmetric", T.IntegerType()),
        ]
    )


def _no_hits(asked: DataFrame, rows: DataFrame) -> DataFrame:
    return rows.sparkSession.createDataFrame([], _hit_schema(asked.schema["qid"].dataType, rows.schema["key"].dataType))


def scan_hits(rows: DataFrame, asked: pa.Table, dim: int) -> DataFrame:
    """Best rows per task, for queries small enough to travel to every task.

    ``rows`` has ``key, vec, f_*`` and, when the queries carry ``qcells``, ``cell``. With ``asking``,
    the ids of the queries a row is a candidate for, only those pairs are scored.
    """
    spark = rows.sparkSession
    shipped = spark.sparkContext.broadcast(asked)
    filters = [c for c in rows.columns if c.startswith("f_")]
    by_cell, by_pair = "qcells" in asked.column_names, "asking" in rows.columns

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            batch = with_vectors_only(batch)
            keys, vectors = batch.column("key"), batch.column("vec")
            if best is None:
                best = TopK(shipped.value, dim)
            if by_pair:
                best.add_pairs(keys, vectors, batch.column("asking"))
                continue
            cells = batch.column("cell").to_numpy(zero_copy_only=False) if by_cell else None
            best.add(keys, vectors, {f: batch.column(f) for f in filters}, cells)
        if best is not None:
            yield best.result(keys.type)

    id_type = from_arrow_type(asked.schema.field("qid").type)
    return rows.mapInArrow(search, _hit_schema(id_type, rows.schema["key"].dataType))


def _wanted_rows(rows: DataFrame, asked: pa.Table) -> DataFrame:
    """Rows with a value of each filter column that some query asks for, where these are few and no query leaves it open: the scan skips the rest."""
    for name in [c for c in rows.columns if c.startswith("f_")]:
        values = pc.unique(asked.column(name).combine_chunks())
        if not values.null_count and len(values) <= MOST_PUSHED:
            rows = rows.where(among(F.col(name), values.to_pylist()))
    return rows


def with_vectors_only(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows without a vector are dropped here: a filter on a computed vector would compute it twice."""
    vectors = batch.column("vec")
    return batch.filter(vectors.is_valid()) if vectors.null_count else batch


def grid_shape(rows: DataFrame, facts: Asked, limit: int) -> tuple[int, int]:
    """(rows, columns) of a grid that moves least: corpus rows travel to every grid row, queries and their hits to and from every column."""
    spark = rows.sparkSession
    cells = max(TASKS_PER_SLOT * task_slots(spark), min(shuffle_tasks(spark), LEAST_CELLS))
    of_queries = facts.n * (4 * facts.dim + 64 + HIT_BYTES * facts.k)
    balanced = math.sqrt(cells * of_queries / max(1, estimated_bytes(rows)))
    n_rows = max(math.ceil(facts.bytes / limit), min(cells, round(balanced)), 1)
    return n_rows, max(1, math.ceil(cells / n_rows))


def _grid_hits(rows: DataFrame, asked: DataFrame, facts: Asked, limit: int, whole: tuple[int, int] | None = None) -> DataFrame:
    n_rows, n_columns = grid_shape(rows, facts, limit)
    asked = asked.withColumn("column", F.explode(F.sequence(F.lit(0), F.lit(n_columns - 1))))
    rows = rows.withColumn("column", F.pmod(F.xxhash64("key"), F.lit(n_columns)).cast("int"))
    return grid_hits(rows, asked, facts.dim, n_rows, n_columns, whole)


def grid_hits(rows: DataFrame, asked: DataFrame, dim: int, n_rows: int, n_columns: int, whole: tuple[int, int] | None = None, probing: Callable | None = None) -> DataFrame:
    """Best rows per cell of a grid: queries and corpus rows have the ``column`` (0 and up) where they meet, queries are dealt over its rows."""
    row_of = F.pmod(F.xxhash64("qid"), F.lit(n_rows))
    rows = rows.withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))))
    return cell_hits(
        rows.withColumn("at", (F.col("row") * n_columns + F.col("column")).cast("int")).drop("row", "column"),
        asked.withColumn("at", (row_of * n_columns + F.col("column")).cast("int")).drop("column"),
        dim,
        n_rows * n_columns,
        whole,
        probing,
    )


def cell_hits(rows: DataFrame, asked: DataFrame, dim: int, cells: int, whole: tuple[int, int] | None = None, probing: Callable | None = None) -> DataFrame:
    """Best rows per grid cell: queries and corpus rows meet where their ``at`` (0..cells-1) is equal.

    Within a partition each cell's queries come first and are held; its corpus rows stream past. If rows have a ``cell`` of an index and
    queries their ``qcells``, rows meet only the queries that name their cell. With ``whole``, the dimension and metric of a second vector
    of rows (``whole``) and queries (``qwhole``), hits also have the exact score by that one. ``probing`` makes of the queries of a task (a ``TopK``)
    what tells, cell by cell, which of them look into it, in place of their ``qcells``.
    """
    spark = rows.sparkSession
    filters = [c for c in rows.columns if c.startswith("f_")]
    by_cell = "cell" in rows.columns
    schema = _hit_schema(asked.schema["qid"].dataType, rows.schema["key"].dataType)
    if whole is not None:
        schema = schema.add("whole", T.DoubleType())
    null = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    left = asked.select(
        "at", F.lit(0).alias("side"), "qid", null(rows, "key"), F.col("qvec").alias("vec"),
        "qk", "qfloor", "qmetric", *[F.col(f).cast(rows.schema[f].dataType).alias(f) for f in filters],
        *(["qcells", null(rows, "cell")] if by_cell else []), *([F.col("qwhole").alias("whole")] if whole else []),
    )
    right = rows.select(
        "at", F.lit(1).alias("side"), null(asked, "qid"), "key", "vec",
        null(asked, "qk"), null(asked, "qfloor"), null(asked, "qmetric"), *filters,
        *([null(asked, "qcells"), "cell"] if by_cell else []), *(["whole"] if whole else []),
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, best = None, [], None
        for batch in batches:
            batch = with_vectors_only(batch)
            at = batch.column("at").to_numpy(zero_copy_only=False).astype(np.int64)
            side = batch.column("side").to_numpy(zero_copy_only=False)
            key_type = batch.column("key").type
            turns = np.flatnonzero(np.r_[True, np.diff(at * 2 + side) != 0])
            for start, stop in zip(turns, np.r_[turns[1:], len(at)]):
                run = batch.slice(start, stop - start)
                if at[start] != current:
                    if best is not None:
                        yield best.result(key_type)
                    current, held, best = at[start], [], None
                if side[start] == 0:
                    held.append(run)
                    continue
                if best is None:
                    if not held:
                        continue
                    table = pa.Table.from_batches(held)
                    best = TopK(table.rename_columns([{"vec": "qvec", "whole": "qwhole"}.get(c, c) for c in table.column_names]), dim, whole)
                    if probing is not None:
                        best.probes = probing(best)
                best.add(
                    run.column("key"), run.column("vec"), {f: run.column(f) for f in filters},
                    run.column("cell").to_numpy(zero_copy_only=False) if by_cell else None, run.column("whole") if whole else None,
                )
        if best is not None:
            yield best.result(key_type)

    tasks = min(cells, 4 * TASKS_PER_SLOT * max(shuffle_tasks(spark), task_slots(spark)))
    met = left.unionByName(right).repartitionById(tasks, F.pmod("at", F.lit(tasks)))
    return met.sortWithinPartitions("at", "side", *(["cell"] if by_cell else [])).mapInArrow(search, schema)


def merge_hits(hits: DataFrame, k_max: int, tasks: int = 0, *, repeated: bool = False) -> DataFrame:
    """Best k per query over all tasks: ``query_id, rank, key, score``. A key that tasks may have found several times counts once with ``repeated``.

    The bound ``k_max`` on every query's k lets Spark drop rows before each shuffle as well as after
    it. With many ``tasks`` behind ``hits`` a level of ``MERGE_FAN_IN`` groups per query comes first, so no task sorts a
    hit from every task.
    """
    order = [F.col("goodness").desc(), F.col("key").asc()]
    if tasks > MERGE_FAN_IN:
        hits = hits.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(MERGE_FAN_IN)))
        partial = Window.partitionBy("query_id", "group").orderBy(*order)
        hits = hits.withColumn("place", F.row_number().over(partial))
        hits = hits.where((F.col("place") <= k_max) & (F.col("place") <= F.col("qk"))).drop("place", "group")
    if repeated:
        # A dense rank is the same for equal hits; grouping by query needs no second shuffle.
        place = F.dense_rank().over(Window.partitionBy("query_id").orderBy(*order))
        hits = hits.withColumn("place", place).where(F.col("place") <= k_max).dropDuplicates(["query_id", "place"]).drop("place")
    by_query = Window.partitionBy("query_id").orderBy(*order)
    score = F.when(F.col("qmetric") == EUCLIDEAN, F.abs("goodness")).otherwise(F.col("goodness"))
    return (
        hits.withColumn("rank", F.row_number().over(by_query))
        .where((F.col("rank") <= k_max) & (F.col("rank") <= F.col("qk")))
        .select("query_id", "rank", "key", score.alias("score"))
    )


def _finish(ranked, corpus, asked, facts, key, vector, metadata, with_vectors, keep_empty, limit) -> DataFrame:
    """Fetch payload for the winners only, and put back queries without hits."""
    taken = {"query_id", "rank", "key", "score"}
    if metadata is True:
        metadata = [c for c in corpus.columns if c not in {key, vector}]
    payload = [F.col(c).alias(f"{c}_meta" if c in taken else c) for c in (metadata or [])]
    if with_vectors:
        payload.append(F.col(vector).alias("vector"))
    if payload:
        # Keys and scores were ranked alone; the number of winners is known, so its size is too.
        small = facts.n * facts.k * 64 <= limit
        winners = F.broadcast(ranked) if small else ranked
        ranked = corpus.select(F.col(key).alias("key"), *payload).join(winners, "key", "inner")
        first = ["query_id", "rank", "key", "score"]
        ranked = ranked.select(*first, *[c for c in ranked.columns if c not in first])
    if keep_empty:
        ids = asked.select(F.col("qid").alias("query_id"))
        ranked = ids.join(ranked, "query_id", "left")
    return ranked
