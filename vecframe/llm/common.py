"""Helpers of the operators: stored intermediates, size-checked broadcasts, runs of equal keys, components."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecframe.session import shared_dir, shuffle_tasks

BROADCAST_BYTES = 32 * 1024 * 1024
BATCH_ROWS = 1000
#: Rows of numbers, without texts, that are handed to Python at a time.
NUMBER_ROWS = 20_000
#: Edges, 16 bytes each, that one task may join at once.
FEW_EDGES = 500_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def modest_batches(spark: SparkSession) -> None:
    """Hand texts to Python at most BATCH_ROWS at a time from now on: a batch is held several times over."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
        spark.conf.set(setting, BATCH_ROWS)


@contextlib.contextmanager
def number_batches(spark: SparkSession) -> Iterator[None]:
    """Inside, Python gets up to NUMBER_ROWS rows at a time, for steps whose rows hold a few numbers: small batches cost more than their rows."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, NUMBER_ROWS)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read again: cuts lineage and survives lost executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A stored table with a broadcast hint if its counted rows fit ``limit``, else as it is."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def join_counted(rows: DataFrame, side: DataFrame, on: list[str], *, copies: str = "copies", row_bytes: int = 64) -> DataFrame:
    """``rows`` joined with stored ``side``, one row per key, that counts in ``copies`` how many of ``rows`` have it.

    A side that fits is broadcast. Else the keys with more than a quarter of a task's even share of rows are, of which there are at most four
    a task since their rows add up, and the others meet by shuffle; so no key makes a task long.
    """
    facts = side.agg(F.count("*").alias("keys"), F.sum(copies).alias("rows")).first()
    if facts.keys * row_bytes <= BROADCAST_BYTES:
        return rows.join(F.broadcast(side), on)
    share = facts.rows // (4 * shuffle_tasks(side.sparkSession))
    hot = F.broadcast(side.where(F.col(copies) > share))
    rest = rows.join(hot.select(*on), on, "left_anti").join(side.where(F.col(copies) <= share), on)
    return rows.join(hot, on).unionByName(rest)


def bucketed(df: DataFrame, keys: list[str], purpose: str) -> str:
    """The rows as a table bucketed by ``keys`` in the shared folder; joins on these keys do not move them. Returns its name, for the caller to drop."""
    spark, tasks = df.sparkSession, shuffle_tasks(df.sparkSession)
    path = shared_dir(spark, purpose)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    df.repartition(tasks, *keys).write.format("parquet").bucketBy(tasks, *keys).option("path", path).saveAsTable(name)
    return name


def content_keys(text: Column) -> list[Column]:
    """128 bits of hash of a text as two longs; a null text has the keys of an empty one."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("c1"), F.xxhash64(F.lit(7), whole).alias("c2")]


def whole_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by ``key`` as tables of complete runs, with the bounds of the runs.

    What is held is one batch and the run at its end.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut or held and held[-1].column(key)[-1].as_py() != keys[0]:
            ready = pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
            yield ready, run_bounds(ready.column(key).to_numpy())
        held.append(batch.slice(cut))
    if held:
        ready = pa.Table.from_batches(held)
        yield ready, run_bounds(ready.column(key).to_numpy())


def run_bounds(keys: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the bounds of each text in them; nulls are empty."""
    texts = column.fill_null("").cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    body = np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]] if data and len(texts) else np.zeros(0, np.uint8)
    return body, bounds - bounds[0]


def text_chunks(column: pa.Array, most: int = 1 << 18) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, bounds) of runs of rows with about ``most`` bytes, one text at least."""
    data, bounds = text_buffers(column)
    row = 0
    while row < len(bounds) - 1:
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + most, "right")) - 1)
        yield row, data[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row]
        row = end


def components(edges: DataFrame, purpose: str, few_edges: int = FEW_EDGES) -> DataFrame:
    """Connected components of edges (a, b) of longs: rows (node, root), root the smallest node.

    Alternating large-star and small-star rounds; each round is written to the shared folder. Ends
    when a round changes nothing, or when the edges left are so few that one task joins them at once
    (the roots are the same). Minima are combined per task, so a node with very many edges is one row
    per task in the shuffle. Nodes without an edge do not appear; no edges, no rows.
    """
    state = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), purpose)
    mark = _mark(state)
    while mark[0]:
        if mark[0] <= few_edges:
            state = state.coalesce(1).mapInArrow(_join_edges, "u long, v long")
            break
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        state = stored(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), purpose)
        before, mark = mark, _mark(state)
        if mark == before:
            break
    nodes = state.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())


def _join_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find: rows (u, v) with v the smallest node of the component of u."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            root.setdefault(u, u)
            root.setdefault(v, v)
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
    joined = [(x, find(x)) for x in root]
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    yield batch_of(schema, [x for x, r in joined if x != r], [r for x, r in joined if x != r])


def _mark(state: DataFrame) -> tuple[int, int]:
    row = state.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_000_007).alias("s")).first()
    return row.n, row.s or 0
