"""Maximal marginal relevance over search hits that carry their vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vecframe.operators.metrics import metric_name


def mmr(hits: DataFrame, top_k: int, *, trade_off: float = 0.5, metric: str = "cosine") -> DataFrame:
    """Reorder each query's hits by ``trade_off * score - (1 - trade_off) * closest picked hit``.

    ``hits`` comes from a search ``with_vectors`` by ``metric``, so a query has at most that search's top_k rows. A
    euclidean score is a distance and counts as its negative. Likeness to picked hits is cosine. Ties go to the better
    original rank. Many queries share a batch: what is held is a batch and one query's hits.
    """
    if not 0.0 <= trade_off <= 1.0:
        raise ValueError("trade_off must lie between 0 and 1")
    sign = -1.0 if metric_name(metric) == "euclidean" else 1.0
    schema = T.StructType([f for f in hits.schema if f.name in ("query_id", "rank", "key", "score")])

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            # A rank of 1 or a lower one than before starts the next query; the last may go on in the next batch.
            rows = pa.Table.from_batches(held)
            starts = _starts(rows.column("rank").to_numpy())
            if len(starts) > 1:
                yield from _reranked(rows.slice(0, starts[-1]), starts, top_k, trade_off, sign)
                held = rows.slice(starts[-1]).to_batches()
        if held:
            rows = pa.Table.from_batches(held)
            if len(rows):
                yield from _reranked(rows, np.array([0, len(rows)]), top_k, trade_off, sign)

    found = hits.where("key is not null").select(*schema.names, "vector")
    return found.repartition("query_id").sortWithinPartitions("query_id", "rank").mapInArrow(rerank, schema)


def _starts(ranks: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, ranks[1:] <= ranks[:-1]]) if len(ranks) else np.zeros(0, int)


def _reranked(rows: pa.Table, starts: np.ndarray, top_k: int, trade_off: float, sign: float) -> list[pa.RecordBatch]:
    score = sign * rows.column("score").to_numpy()
    vectors = rows.column("vector").combine_chunks()
    x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1).astype(np.float64)
    length = np.sqrt((x**2).sum(axis=1, keepdims=True))
    x = np.divide(x, length, out=np.zeros_like(x), where=length != 0)
    order, places = [], []
    for start, end in zip(starts[:-1], starts[1:], strict=True):
        picked = _pick(score[start:end], x[start:end], top_k, trade_off)
        order += [start + i for i in picked]
        places += range(1, len(picked) + 1)
    out = rows.drop_columns(["vector"]).take(pa.array(order, pa.int64()))
    at = out.schema.get_field_index("rank")
    return out.set_column(at, out.schema.field(at), pa.array(places, out.schema.field(at).type)).to_batches()


def _pick(score: np.ndarray, x: np.ndarray, top_k: int, trade_off: float) -> list[int]:
    closest, picked = np.full(len(x), -np.inf), []
    while len(picked) < min(top_k, len(x)):
        penalty = np.where(np.isneginf(closest), 0.0, closest)
        value = trade_off * score - (1 - trade_off) * penalty
        value[picked] = -np.inf
        best = int(np.argmax(value))
        picked.append(best)
        closest = np.maximum(closest, x @ x[best])
    return picked
