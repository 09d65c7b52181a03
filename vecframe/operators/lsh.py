"""Euclidean search by p-stable hashing: Spark ML's bucketed random projections, with a bucket length from measured distances."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecframe.operators import ann, knn
from vecframe.session import shared_dir

SAMPLE_QUERIES = 200
#: A pair as far apart as most k-th neighbours is to be missed with at most this chance.
MISS = 0.01
MOST_TABLES = 16
#: The bucket length as a multiple of that distance.
LENGTHS = 2.0
#: Numbers for the buckets of a table.
BUCKETS = 512


def collision(distance: float, length: float) -> float:
    """The chance that one projection puts two points so far apart in one bucket."""
    if distance <= 0:
        return 1.0
    r = length / distance
    below = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def knn_lsh(
    corpus: DataFrame, queries: DataFrame, *, key: str = "key", vector: str = "vector", query_id: str = "query_id", query_vector: str = "vector",
    top_k: int = 10, lengths: float = LENGTHS, miss: float = MISS, sample_queries: int = SAMPLE_QUERIES, seed: int = 7,
    broadcast_limit: int = knn.BROADCAST_LIMIT,
) -> DataFrame:
    """The ``top_k`` nearest rows by euclidean distance, as ``knn_join`` gives them, found by hashing.

    The distance to look within is the largest but for 5 % of the k-th distances of at most ``sample_queries`` queries, by a hash of their ids; the bucket length is a multiple of
    it, and tables are added until a pair at that distance is missed with a chance of ``miss`` at most. Pairs that share a bucket of a table and lie within the
    distance are candidates. Buckets are the cells of a grid in which rows stream past queries, so no pair is a row of a join; scores are exact. A query with fewer than ``top_k`` of them
    is searched exactly, so every query has its full number of hits. Vectors must be finite.
    """
    asked = knn.query_table(queries, query_id=query_id, query_vector=query_vector, top_k=top_k, metric="euclidean", min_score=None, max_distance=None, filter_on=None)
    facts = knn.measure(asked, broadcast_limit)
    names = {"key": key, "vector": vector, "query_id": query_id, "query_vector": query_vector, "top_k": top_k, "metric": "euclidean", "broadcast_limit": broadcast_limit}
    sample = queries.orderBy(F.xxhash64(query_id), query_id).limit(sample_queries)
    kth = [r.far for r in knn.knn_join(corpus, sample, **names).groupBy("query_id").agg(F.max("score").alias("far")).collect()] if facts.n else []
    reach = float(np.quantile(kth, 0.95)) * (1 + 1e-6) if kth else 0.0
    if reach <= 0:
        return knn.knn_join(corpus, queries, **names)
    length = lengths * reach
    tables = min(MOST_TABLES, max(1, math.ceil(math.log(miss) / math.log(1 - collision(reach, length)))))
    features = lambda c: array_to_vector(F.col(c).cast("array<float>").cast("array<double>")).alias("features")
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=length, numHashTables=tables, seed=seed).fit(asked.select(features("qvec")))
    # Buckets so many lengths apart share a number; they are farther apart than what is looked for.
    bucket = lambda t: (F.pmod(vector_to_array(F.col("hashes")[t])[0].cast("long"), F.lit(BUCKETS)) + t * BUCKETS).cast("int")
    buckets = F.array(*[bucket(t) for t in range(tables)])
    hashed = lambda df, c: model.transform(df.withColumn("features", features(c)))
    rows = hashed(corpus.where(F.col(vector).isNotNull()).select(F.col(key).alias("key"), F.col(vector).cast("array<float>").alias("vec")), "vec")
    within = F.greatest(F.coalesce("qfloor", F.lit(-reach)), F.lit(-reach))
    queries_in = hashed(asked, "qvec").withColumn("qcells", buckets).withColumn("qfloor", within).drop("features", "hashes")
    hits = ann.cell_grid_hits(rows.select("key", "vec", F.explode(buckets).alias("cell")), queries_in, facts, broadcast_limit, apart=BUCKETS)
    found = _kept(knn.merge_hits(hits, facts.k, repeated=True), "lsh-hits")
    short = asked.select("qid").join(found.groupBy("query_id").count().where(F.col("count") >= top_k).select(F.col("query_id").alias("qid")), "qid", "left_anti")
    rest = _kept(queries.join(short.withColumnRenamed("qid", "_short"), F.col(query_id) == F.col("_short"), "left_semi"), "short-queries")
    exact = knn.knn_join(corpus, rest, **names)
    full = found.join(short.withColumnRenamed("qid", "query_id"), "query_id", "left_anti")
    return full.select(*exact.columns).unionByName(exact)


def _kept(df: DataFrame, purpose: str) -> DataFrame:
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
