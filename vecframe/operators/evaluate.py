"""Search quality against ground truth: recall and NDCG at k, averaged over the true queries."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _found(hits: DataFrame, truth: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    truth = truth.where((F.col("rank") <= k) & F.col("key").isNotNull()).select("query_id", "key")
    hits = hits.where((F.col("rank") <= k) & F.col("key").isNotNull()).select("query_id", "key", "rank")
    joined = truth.join(hits, ["query_id", "key"], "left")
    return truth, joined


def recall_per_query(hits: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """Share of each query's true keys that are among its first k hits."""
    _, joined = _found(hits, truth, k)
    return joined.groupBy("query_id").agg((F.count("rank") / F.count("key")).alias("recall"))


def recall_at_k(hits: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    return recall_per_query(hits, truth, k).agg(F.avg("recall").alias("recall"), F.count("*").alias("queries"))


def ndcg_per_query(hits: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """Binary gain with a log2 discount by hit rank, over the best possible sum."""
    _, joined = _found(hits, truth, k)
    gain = F.coalesce(F.lit(1.0) / F.log2(F.col("rank") + 1.0), F.lit(0.0))
    discounts = [1.0 / math.log2(i + 2) for i in range(k)]
    best = F.aggregate(
        F.slice(F.array(*[F.lit(d) for d in discounts]), F.lit(1), F.col("n").cast("int")),
        F.lit(0.0),
        lambda total, d: total + d,
    )
    sums = joined.groupBy("query_id").agg(F.sum(gain).alias("gain"), F.count("*").alias("n"))
    return sums.select("query_id", (F.col("gain") / best).alias("ndcg"))


def ndcg_at_k(hits: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    return ndcg_per_query(hits, truth, k).agg(F.avg("ndcg").alias("ndcg"), F.count("*").alias("queries"))
