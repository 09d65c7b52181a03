"""The registered queries: each operator on the given tables, whole."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecframe.functions.encoders import HashEncoder, embed
from vecframe.functions.text import SPECIAL_TOKENS, count_tokens, normalize_title, truncate_text, wordpiece_join
from vecframe.operators import ann, evaluate, index, knn, lsh, points, profiles, remap, rerank, schema, tables, vectors
from vecframe.operators.filed import FiledTable
from vecframe.plans import corpus as corpora
from vecframe.plans.staging import stage_files
from vecframe.session import pieces, shared_dir, spread
from vecframe.sources import typed
from vecframe.sources.export import export
from vecframe.sources.files import read_vectors
from vecframe.streaming.apply import StreamedTable

EMBEDDED = {"key": "vec_id", "vector": "embedding", "query_id": "vec_id", "query_vector": "embedding"}
GROUPS = ["en", "es"]
# A token enters the vocabulary if it occurs so often.
LEAST_COUNT = 2
# A second, smaller selection, whose limit cuts through the joined rows.
FEW = 100
IVF_CELLS = 16


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(hits: DataFrame) -> DataFrame:
    return hits.withColumn("score", F.round("score", 6))


def elements(df: DataFrame, key: str, vector: str) -> DataFrame:
    """One row per vector element, so that a comparison covers every value.

    The outer form, since for the inner one Spark also filters on the size, and so computes a
    vector made by a function twice.
    """
    parts = df.select(key, F.posexplode_outer(vector).alias("pos", "value"))
    return parts.withColumn("value", F.round(F.col("value").cast("double"), 6))


# --- search -------------------------------------------------------------------------------------


def knn_metric(metric: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        e = table(spark, folder, "embeddings")
        return rounded(knn.knn_join(e, e, metric=metric, **EMBEDDED))

    return query


def knn_single(spark, folder):
    """Rows nearest to the mean of all vectors, found with one query vector."""
    e = table(spark, folder, "embeddings")
    mean = vectors.vector_mean(e.withColumn("all", F.lit(0)), ["all"], "embedding").first().embedding
    return rounded(knn.knn_single(e, mean, key="vec_id", vector_column="embedding"))


def knn_filtered(spark, folder):
    e = table(spark, folder, "embeddings")
    return rounded(knn.knn_join(e, e, filter={"label": 3}, **EMBEDDED))


def knn_filter_id(spark, folder):
    """Each query asks for one key, the one its label and id add up to."""
    e = table(spark, folder, "embeddings")
    asked = e.withColumn("wanted", F.col("vec_id") + F.col("label"))
    return rounded(knn.knn_join(e, asked, filter_on={"vec_id": "wanted"}, keep_empty=True, **EMBEDDED))


def knn_typed_filter(spark, folder):
    """Metadata kept in its types and filtered by them, with the key mirrored into it."""
    e = table(spark, folder, "embeddings").withColumn("even", F.col("vec_id") % 2 == 0)
    rows = typed.mirrored(typed.with_typed_metadata(e, ["label", "even"]), key="vec_id")
    hits = knn.knn_join(typed.where_metadata(rows, {"label": 3, "even": True}), e, metadata=["metadata"], **EMBEDDED)
    return rounded(hits.withColumns({"id": typed.value("id", "string"), "label": typed.value("label", "int")}).drop("metadata"))


def knn_min_score(spark, folder):
    e = table(spark, folder, "embeddings")
    return rounded(knn.knn_join(e, e, min_score=0.25, **EMBEDDED))


def knn_join(spark, folder):
    """Neighbours with the query's own label."""
    e = table(spark, folder, "embeddings")
    return rounded(knn.knn_join(e, e, filter_on={"label": "label"}, **EMBEDDED))


def knn_mixed(spark, folder):
    """k, metric, threshold and collection differ by query; some queries have no hits."""
    e = table(spark, folder, "embeddings")
    label = F.col("label")
    asked = e.select(
        F.col("vec_id").alias("query_id"),
        "embedding",
        (label + 1).alias("k"),
        F.when(label < 4, "cosine").when(label < 7, "IP").otherwise("L2").alias("metric"),
        F.when(label == 0, 2.0).when(label < 3, 0.25).alias("low"),
        F.when(label == 9, 1.2).alias("far"),
        F.when(label == 5, "nowhere").when(label < 5, "all").otherwise("odd").alias("collection"),
    )
    # Some items cannot be answered: a vector of another length, an unknown metric.
    asked = asked.withColumns({
        "embedding": F.when(F.col("query_id") % 7 == 3, F.slice("embedding", 1, 3)).otherwise(F.col("embedding")),
        "metric": F.when(F.col("query_id") % 7 == 5, "manhattan").otherwise(F.col("metric")),
    })
    return rounded(
        knn.query_batch(
            {"all": e, "odd": e.where("label in (1, 3, 5, 7, 9)")},
            asked,
            key="vec_id", vector="embedding", query_vector="embedding",
            top_k=F.col("k"), metric=F.col("metric"), min_score=F.col("low"), max_distance=F.col("far"),
        )
    )


def knn_with_payload(spark, folder):
    e = table(spark, folder, "embeddings")
    hits = knn.knn_join(e, e, metadata=["label"], with_vectors=True, **EMBEDDED)
    total = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return rounded(hits.withColumn("vector_sum", F.round(total, 6)).drop("vector"))


def knn_pca(spark, folder):
    e = table(spark, folder, "embeddings")
    components = ann.fit_pca(e, 48, vector="embedding")
    return rounded(ann.knn_pca(e, e, components, candidate_multiplier=10, **EMBEDDED))


def knn_pca_full(spark, folder):
    """As many components as dimensions: a rotation, which must equal exact search."""
    e = table(spark, folder, "embeddings")
    components = ann.fit_pca(e, 64, vector="embedding")
    return rounded(ann.knn_pca(e, e, components, candidate_multiplier=2, **EMBEDDED))


def knn_ivf(spark, folder):
    """All cells probed, which must equal exact search."""
    e = table(spark, folder, "embeddings")
    centroids = ann.fit_cells(e, IVF_CELLS, vector="embedding")
    path = shared_dir(spark, "cells")
    ann.write_cells(ann.assign_cells(e, centroids, vector="embedding"), path, key="vec_id")
    celled = spark.read.parquet(path)
    return rounded(ann.knn_ivf(celled, e, centroids, nprobe=IVF_CELLS, **EMBEDDED))


ASKING = {"query_id": "vec_id", "query_vector": "embedding"}


def _built(spark, folder, kind: str = "cells", **options) -> index.Index:
    """An index of the embeddings, built in one call and opened by another."""
    e, path = table(spark, folder, "embeddings"), shared_dir(spark, "index")
    index.build_index(e, path, kind, key="vec_id", vector="embedding", **options)
    return index.open_index(spark, path, e)


def knn_index_cells(spark, folder):
    """A stored index of two-level cells, all of them probed, which must equal exact search; with payload."""
    hits = _built(spark, folder).search(table(spark, folder, "embeddings"), nprobe=index.MOST_CELLS, metadata=["label"], **ASKING)
    return rounded(hits)


def knn_index_filtered(spark, folder):
    """Neighbours with the query's own label, by a stored index."""
    hits = _built(spark, folder).search(table(spark, folder, "embeddings"), nprobe=index.MOST_CELLS, filter_on={"label": "label"}, **ASKING)
    return rounded(hits)


def knn_index_pca(spark, folder):
    """A stored index of reduced vectors for the dot product, at full width (one more than the dimension)."""
    built = _built(spark, folder, "pca", metric="dot_product", reduced_dimensions=65)
    return rounded(built.search(table(spark, folder, "embeddings"), candidate_multiplier=2, **ASKING))


def knn_exact_pruned(metric: str) -> Callable[[SparkSession, str], DataFrame]:
    """Exact search that skips cells by their bounds."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        return rounded(_built(spark, folder, metric=metric).exact(table(spark, folder, "embeddings"), **ASKING))

    return query


def knn_lsh_l2(spark, folder):
    """Search by p-stable hashing: what every query finds, that scores are exact, and that recall passes the gate."""
    e = table(spark, folder, "embeddings")
    hits, truth = _written(lsh.knn_lsh(e, e, **EMBEDDED), "hashed"), knn.knn_join(e, e, metric="euclidean", **EMBEDDED)
    recall = evaluate.recall_at_k(hits, truth, 10).first().recall
    pairs = hits.join(e.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("a")), "query_id").join(e.select(F.col("vec_id").alias("key"), F.col("embedding").alias("b")), "key")
    distance = vectors.pair_score(F.col("a"), F.col("b"), "euclidean", 64)
    pairs = pairs.withColumn("same", F.abs(F.col("score") - distance) < 1e-9)
    each = pairs.groupBy("query_id").agg(F.count("*").alias("hits"), F.min_by("key", "rank").alias("first"), F.bool_and("same").alias("exact"))
    return each.withColumn("reached", F.lit(recall >= 0.9))


def search_target(spark, folder):
    """A recall target kept with an index: tuned by the first search, applied by the second, whose recall is measured."""
    e, path = table(spark, folder, "embeddings"), shared_dir(spark, "index")
    search = lambda: ann.search(e, e, index_path=path, target_recall=0.9, **EMBEDDED)
    search()
    return evaluate.recall_at_k(search(), knn.knn_join(e, e, **EMBEDDED), 10).select((F.col("recall") >= 0.9).alias("reached"), "queries")


def tune_recall(spark, folder):
    e = table(spark, folder, "embeddings")
    _, report = ann.tune_recall(e, e, exact_below=0, n_cells=IVF_CELLS, **EMBEDDED)
    return report.select(
        "method", F.to_json("params").alias("params"), F.round("recall", 4).alias("recall"), "cost", "chosen"
    )


def mmr(metric: str, trade_off: float) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        e = table(spark, folder, "embeddings")
        hits = knn.knn_join(e, e, top_k=20, metric=metric, with_vectors=True, **EMBEDDED)
        return rounded(rerank.mmr(hits, 5, trade_off=trade_off, metric=metric))

    return query


def fetch_keys(spark, folder):
    """Conversations' keys, a row per turn: keys come several times, and some are no vectors."""
    keys = table(spark, folder, "conversations").select((F.col("conv_id") * 3).alias("vec_id"))
    found = tables.fetch(table(spark, folder, "embeddings"), keys, key="vec_id")
    return found.select("vec_id", "found", "label", F.size("embedding").alias("dimension"))


def fetch_stored_keys(spark, folder):
    """The keys of the benchmark's items, from a table laid out by key."""
    path = shared_dir(spark, "keyed")
    points.write_keyed(table(spark, folder, "embeddings"), path, "vec_id")
    keys = table(spark, folder, "benchmark").select((F.col("item_id") * 20).alias("vec_id"))
    found = points.fetch_stored(spark, path, keys, key="vec_id")
    return found.select("vec_id", "found", "label", F.size("embedding").alias("dimension"))


def _signs_and_truth(spark, folder) -> tuple[DataFrame, DataFrame]:
    e = table(spark, folder, "embeddings")
    signs = e.withColumn("embedding", F.transform("embedding", lambda x: F.when(x >= 0, 1.0).otherwise(-1.0)))
    return knn.knn_join(signs, signs, metric="dot_product", **EMBEDDED), knn.knn_join(e, e, **EMBEDDED)


def recall_at_k(spark, folder):
    """Search on the signs of the elements, against exact search."""
    hits, truth = _signs_and_truth(spark, folder)
    return evaluate.recall_at_k(hits, truth, 10).withColumn("recall", F.round("recall", 6))


def ndcg_at_k(spark, folder):
    hits, truth = _signs_and_truth(spark, folder)
    return evaluate.ndcg_at_k(hits, truth, 10).withColumn("ndcg", F.round("ndcg", 6))


# --- vectors and schema -------------------------------------------------------------------------


def coerce_vectors(spark, folder):
    """Doubles in, and no vector for label 0."""
    e = table(spark, folder, "embeddings")
    rough = e.withColumn("embedding", F.when(F.col("label") > 0, F.col("embedding").cast("array<double>")))
    return elements(vectors.coerce_vectors(rough, "embedding"), "vec_id", "embedding")


def normalize_vectors(spark, folder):
    e = table(spark, folder, "embeddings")
    scaled = e.withColumn("embedding", F.transform("embedding", lambda x: x * F.col("label").cast("float")))
    return elements(vectors.normalize_vectors(scaled, "embedding"), "vec_id", "embedding")


def vector_mean(spark, folder):
    return elements(vectors.vector_mean(table(spark, folder, "embeddings"), ["label"], "embedding"), "label", "embedding")


def profile_schema(spark, folder):
    return schema.profile_schema(table(spark, folder, "embeddings"))


def profile_files(spark, folder):
    """Two tables profiled file by file, before and after a file is added to each."""
    out = []
    for name, key in (("embeddings", "vec_id"), ("documents", "doc_id")):
        rows, path = table(spark, folder, name), shared_dir(spark, "growing")
        known = profiles.FileProfiles(spark, shared_dir(spark, "profiles"))
        rows.where(F.col(key) % 2 == 0).coalesce(1).write.parquet(path)
        known.add(spark.read.parquet(path))
        rows.where(F.col(key) % 2 == 1).coalesce(1).write.mode("append").parquet(path)
        out.append(known.profile(spark.read.parquet(path)))
        known.add(spark.read.parquet(path))
        out.append(known.profile(spark.read.parquet(path)))
    return out[0].union(out[1]).union(out[2]).union(out[3])


def confirm_schema(spark, folder):
    e = table(spark, folder, "embeddings")
    confirmed = schema.confirm_schema(e, id_field="vec_id", vector_field="embedding", dimension=64)
    return confirmed.select("key", "label", F.size("vector").alias("dimension"), F.element_at("vector", -1).cast("double").alias("last"))


def remap_schema(spark, folder):
    e = table(spark, folder, "embeddings")
    target = shared_dir(spark, "remap")
    report = schema.remap_schema(
        f"{folder}/embeddings.parquet", target, e,
        current=("vec_id", "embedding"), id_field="item", vector_field="features", reprocess=True,
    )
    rows = spark.read.parquet(target)
    return rows.select(
        "item", "label", F.size("features").alias("dimension"), F.lit(report["files_rewritten"]).alias("files_rewritten")
    )


def remap_stored(spark, folder):
    """Files of which half have the new names already; only the others are written again."""
    e, path = table(spark, folder, "embeddings"), shared_dir(spark, "remap")
    old, new = e.where(F.col("vec_id") % 2 == 0), e.where(F.col("vec_id") % 2 == 1)
    old.coalesce(1).write.parquet(path)
    new.withColumnsRenamed({"vec_id": "item", "embedding": "features"}).coalesce(1).write.mode("append").parquet(path)
    report = remap.remap_files(spark, path, current=("vec_id", "embedding"), id_field="item", vector_field="features", reprocess=True)
    rows = spark.read.option("mergeSchema", "true").parquet(path)
    return rows.select("item", "label", F.size("features").alias("dimension"), F.lit(report["files_rewritten"]).alias("files_rewritten"))


def mirror_id(spark, folder):
    e = table(spark, folder, "embeddings")
    own = F.when(F.col("label") == 0, F.create_map(F.lit("id"), F.lit("own"))).when(
        F.col("label") < 5, F.create_map(F.lit("label"), F.col("label").cast("string"))
    )
    mirrored = schema.mirror_id(e.select(F.col("vec_id").alias("key"), own.alias("metadata")))
    return mirrored.select(
        "key",
        F.try_element_at("metadata", F.lit("id")).alias("id"),
        F.try_element_at("metadata", F.lit("label")).alias("label"),
        F.size("metadata").alias("entries"),
    )


def promote_key(spark, folder):
    d = table(spark, folder, "documents")
    original = [F.lit("key_original"), F.col("doc_id").cast("string")]
    language = [F.lit("lang"), F.col("lang")]
    metadata = (
        F.when(F.col("lang") == "en", F.create_map(*original, *language))
        .when(F.col("lang") == "fr", F.create_map(*original))
        .when(F.col("lang") == "de", F.create_map(*language))
    )
    stored = d.select("doc_id", F.md5(F.col("doc_id").cast("string")).alias("key"), metadata.alias("metadata"))
    promoted = schema.promote_key(stored)
    return promoted.select(
        "doc_id", "key", F.col("metadata").isNotNull().alias("has_metadata"),
        F.try_element_at("metadata", F.lit("lang")).alias("lang"),
    )


# --- table maintenance --------------------------------------------------------------------------


def _files(spark, folder) -> DataFrame:
    d = table(spark, folder, "documents")
    return d.select(
        F.col("doc_id").alias("key"), F.lit(0).cast("long").alias("seq"),
        F.col("n_chars").cast("double").alias("value"), F.col("source").alias("source_file"),
    )


def _log(spark, folder) -> DataFrame:
    ev = table(spark, folder, "events")
    return ev.select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"), F.col("event_type").alias("op"), "value")


def _customers(spark, folder) -> DataFrame:
    c = table(spark, folder, "customer")
    return c.select(F.col("c_custkey").alias("key"), F.lit(-1).cast("long").alias("seq"), F.col("c_acctbal").alias("value"))


def upsert_rows(spark, folder):
    """Turns of conversations written over documents, the last turn of each winning."""
    turns = table(spark, folder, "conversations").select(
        F.col("conv_id").alias("key"), (F.col("turn") + 1).alias("seq"),
        F.length("text").cast("double").alias("value"), F.col("role").alias("source_file"),
    )
    return tables.upsert(_files(spark, folder), turns)


def _order_changes(spark, folder) -> DataFrame:
    o = table(spark, folder, "orders")
    return o.select(F.col("o_orderkey").alias("key"), F.lit(1).cast("long").alias("seq"), F.col("o_totalprice").alias("value"))


def update_rows(spark, folder):
    return tables.update_rows(_files(spark, folder), _order_changes(spark, folder))[0]


def update_report(spark, folder):
    return tables.update_rows(_files(spark, folder), _order_changes(spark, folder))[1]


def _toxic(spark, folder) -> DataFrame:
    return table(spark, folder, "labels").where("toxic = 1").select(F.col("doc_id").alias("key"))


def delete_ids(spark, folder):
    return tables.delete_ids(_files(spark, folder), _toxic(spark, folder))[0]


def delete_report(spark, folder):
    return tables.delete_ids(_files(spark, folder), _toxic(spark, folder))[1]


def delete_file(spark, folder):
    return tables.delete_file(_files(spark, folder), "src3")


def replace_file(spark, folder):
    """Pages in place of one source's documents; some pages have the key of a document of another source."""
    pages = table(spark, folder, "pages").select(
        F.col("page_id").alias("key"), F.lit(1).cast("long").alias("seq"),
        F.length("html").cast("double").alias("value"),
    )
    return tables.replace_file(_files(spark, folder), "src3", pages)


def _named_files(documents: DataFrame) -> DataFrame:
    return documents.groupBy(F.concat_ws("-", "source", "lang").alias("name")).agg(F.sum("n_chars").alias("size"))


def idempotent_append(spark, folder):
    """Labelled documents are what was loaded of each (source, lang) file before."""
    d = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").select("doc_id")
    before = d.join(labels, "doc_id", "left_semi")
    return tables.file_actions(_named_files(before), _named_files(d))


def append_files(spark, folder):
    """All documents appended to the labelled ones, by the files not loaded yet; turns of conversations share their keys."""
    d = table(spark, folder, "documents")
    name = F.concat_ws("-", "source", "lang")
    rows = d.select(F.col("doc_id").alias("key"), F.lit(0).cast("long").alias("seq"), F.col("n_chars").cast("double").alias("value"), name.alias("source_file"))
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("key"))
    turns = table(spark, folder, "conversations").groupBy("conv_id").agg(F.max("turn").alias("seq")).select(
        F.col("conv_id").alias("key"), "seq", F.lit(0.0).alias("value"), F.lit("turns").alias("source_file")
    )
    base = rows.join(labels, "key", "left_semi").join(turns, "key", "left_anti").unionByName(turns)
    return tables.append_new_files(base, rows, idempotent_append(spark, folder))


def list_files(spark, folder):
    return tables.list_files(_files(spark, folder), log=_log_ops(spark, folder))


def _log_ops(spark, folder) -> DataFrame:
    return _log(spark, folder).withColumn("op", F.when(F.col("op") == "error", "delete").otherwise("upsert"))


def merge_on_read(spark, folder):
    return tables.merge_on_read(_customers(spark, folder), _log(spark, folder), op="op", delete="error")


def snapshot_at(spark, folder):
    return tables.snapshot_at(_customers(spark, folder), _log(spark, folder), 5000, op="op", delete="error")


def wal_net_count(spark, folder):
    return tables.log_net_count(_log(spark, folder), delete="error")


def collection_stats(spark, folder):
    e = table(spark, folder, "embeddings")
    return tables.collection_stats({"embeddings": e, "unlabelled": e.where("label is null")}, vector="embedding")


def _filed(spark, folder) -> FiledTable:
    return FiledTable(spark, shared_dir(spark, "filed")).create(_files(spark, folder))


def stored_update(spark, folder):
    """A table kept by source file; only files with changed rows are written again."""
    stored = _filed(spark, folder)
    stored.update_rows(_order_changes(spark, folder))
    return stored.read()


def stored_delete(spark, folder):
    stored = _filed(spark, folder)
    stored.delete_ids(_toxic(spark, folder))
    return stored.read()


def stored_delete_file(spark, folder):
    stored = _filed(spark, folder)
    stored.delete_file("src3")
    return stored.read()


def stored_replace_file(spark, folder):
    pages = table(spark, folder, "pages").select(
        F.col("page_id").alias("key"), F.lit(1).cast("long").alias("seq"),
        F.length("html").cast("double").alias("value"),
    )
    stored = _filed(spark, folder)
    stored.replace_file("src3", pages)
    return stored.read()


def stored_files(spark, folder):
    """The listing of a stored table with its log; sizes and times are the file system's, so only that they are there is compared."""
    listed = _filed(spark, folder).files(_log_ops(spark, folder))
    return listed.select("name", "vector_count", "is_wal", (F.col("size") > 0).alias("has_size"), F.col("modified").isNotNull().alias("has_time"))


def stream_merge(spark, folder):
    """Events as a stream of operations in several micro-batches, in two runs that are each folded; the second brings operations older than those of the first."""
    staged, target = shared_dir(spark, "ops"), shared_dir(spark, "streamed")
    ops = _log_ops(spark, folder)
    files = pieces(ops, least=4)
    streamed = StreamedTable(spark, target)
    for run in (0, 1):
        ops.where(F.col("seq") % 2 == run).repartitionByRange(files, "seq").write.mode("append").parquet(staged)
        stream = spark.readStream.schema(ops.schema).option("maxFilesPerTrigger", math.ceil(files / 4)).parquet(staged)
        streamed.start(stream).awaitTermination()
        streamed.fold()
    streamed.compact()
    return streamed.read().select("key", "seq", "value")


def stream_replay(spark, folder):
    """Batches delivered again, before and after they were folded, change nothing."""
    ops, streamed = _log_ops(spark, folder), StreamedTable(spark, shared_dir(spark, "streamed"))
    early, late = (ops.where(F.col("seq") % 2 == run) for run in (1, 0))
    streamed.append(early, 0)
    streamed.append(early, 0)
    streamed.fold()
    streamed.append(late, 1)
    streamed.append(early, 0)
    streamed.append(late, 1)
    return streamed.read().select("key", "seq", "value")


# --- text and corpus ----------------------------------------------------------------------------


def documents_as_texts(spark, folder) -> DataFrame:
    d = table(spark, folder, "documents")
    return d.select(
        F.col("text").alias("title"), (F.lit(1900) + F.col("n_chars") % 120).cast("int").alias("year"),
        F.col("source").alias("genre"), F.col("text").alias("plot"), F.col("lang").alias("origin"),
        F.col("doc_id").alias("position"),
    )


def labels_as_popularity(spark, folder) -> DataFrame:
    d, labels = spread(table(spark, folder, "documents")), table(spark, folder, "labels")
    return d.join(labels, "doc_id").select(
        F.concat(F.lit('"'), "text", F.lit('!"')).alias("title"),
        (F.lit(1900) + F.col("n_chars") % 120).cast("int").alias("year"),
        (F.col("quality") * 1000 + F.col("n_chars") % 97).alias("popularity"),
        F.col("doc_id").alias("position"),
    )


def _wanted(spark, folder) -> DataFrame:
    texts = documents_as_texts(spark, folder)
    return corpora.corpus_filter(texts, title="title", year="year", text="plot", group="origin", groups=GROUPS)


def corpus_filter(spark, folder):
    return _wanted(spark, folder).select(F.col("position").alias("doc_id"), "year", "origin")


def dedup_keep_first(spark, folder):
    keyed = documents_as_texts(spark, folder).withColumn("title_norm", normalize_title(F.col("title")))
    first = corpora.keep_first(keyed, ["title_norm", "year"], [F.asc("position")])
    return first.select(F.col("position").alias("doc_id"), "year")


def corpus_join(spark, folder):
    joined = corpora.match_popularity(_wanted(spark, folder), labels_as_popularity(spark, folder))
    return joined.select(F.col("position").alias("doc_id"), "year", "popularity")


def _top(spark, folder, n: int = corpora.TOP_N) -> DataFrame:
    joined = corpora.match_popularity(_wanted(spark, folder), labels_as_popularity(spark, folder))
    return corpora.top_n(joined, n, [F.desc("popularity"), F.asc("position")])


def top_n(spark, folder, n: int = corpora.TOP_N):
    return _top(spark, folder, n).select(F.col("position").alias("doc_id"), "popularity")


def selected_range(spark, folder):
    return corpora.selected_range(_top(spark, folder))


def row_ids(spark, folder, n: int = corpora.TOP_N):
    numbered = corpora.row_ids(_top(spark, folder, n), [F.desc("popularity"), F.asc("position")])
    return numbered.select("id", F.col("position").alias("doc_id"))


def normalized_titles(spark, folder):
    return table(spark, folder, "documents").select("doc_id", normalize_title(F.col("text")).alias("title_norm"))


def truncated_texts(spark, folder):
    return table(spark, folder, "documents").select("doc_id", truncate_text(F.col("text")).alias("plot"))


def token_counts(spark, folder):
    return count_tokens(table(spark, folder, "documents"), "text")


def vocabulary(spark, folder) -> DataFrame:
    """All tokens that occur twice or more and all single characters, with and without ``##``, after the special tokens: a stored table (piece, id)."""
    counts = _written(token_counts(spark, folder), "tokens")
    letters = counts.select(F.explode(F.split("token", "")).alias("c")).where("c != ''").distinct()
    special = spark.createDataFrame(list(enumerate(SPECIAL_TOKENS)), "place long, piece string")
    parts = [
        special.select(F.lit(0).alias("part"), "place", "piece"),
        letters.select(F.lit(1), F.lit(0).cast("long"), "c"),
        letters.select(F.lit(2), F.lit(0).cast("long"), F.concat(F.lit("##"), "c")),
        counts.where(F.col("n") >= LEAST_COUNT).select(F.lit(3), -F.col("n"), "token"),
    ]
    pieces_of = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    order = [F.asc("part"), F.asc("place"), F.asc("piece")]
    numbered = corpora.row_ids(corpora.keep_first(pieces_of, ["piece"], order), order, id_format="%d")
    return _written(numbered.select("piece", F.col("id").cast("int").alias("id")), "vocabulary")


def _written(df: DataFrame, purpose: str) -> DataFrame:
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def wordpieces(spark, folder):
    """Ids under a vocabulary counted from the texts, which is a table throughout."""
    rows = wordpiece_join(table(spark, folder, "documents"), vocabulary(spark, folder), key="doc_id", text="text")
    return rows.select("doc_id", F.size("ids").alias("n_ids"), F.array_join("ids", " ").alias("ids"))


def embed_hash(spark, folder):
    d = embed(table(spark, folder, "documents").select("doc_id", "text"), "text", HashEncoder())
    slots = d.select("doc_id", F.posexplode_outer("vector").alias("pos", "value")).where("value != 0")
    return slots.withColumn("value", F.round(F.col("value").cast("double"), 6))


def text_search(spark, folder):
    encoder = HashEncoder()
    d = embed(table(spark, folder, "documents"), "text", encoder)
    asked = table(spark, folder, "benchmark")
    hits = corpora.semantic_search(d, asked, encoder, text="text", query_id="item_id", key="doc_id", metadata=["lang", "source"])
    return rounded(hits)


def _corpus(spark, folder, n: int = corpora.TOP_N) -> DataFrame:
    return corpora.build_corpus(
        documents_as_texts(spark, folder), labels_as_popularity(spark, folder), HashEncoder(), groups=GROUPS, n=n
    )


def with_few(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: query(spark, folder, FEW)


def checksum(vector: str) -> Column:
    weighted = F.transform(vector, lambda x, i: x.cast("double") * (i + 1))
    return F.round(F.aggregate(weighted, F.lit(0.0), lambda acc, x: acc + x), 4)


def corpus_build(spark, folder, n: int = corpora.TOP_N):
    path = shared_dir(spark, "corpus")
    corpora.write_corpus(_corpus(spark, folder, n), path)
    stored = spark.read.parquet(path)
    return stored.select("id", "title", "year", "genre", "plot", F.size("vector").alias("dimension"), checksum("vector").alias("checksum"))


def validate_corpus(spark, folder):
    return corpora.validate_corpus(_corpus(spark, folder), dimension=HashEncoder().dimension)


# --- files --------------------------------------------------------------------------------------


def read_csv_vectors(spark, folder):
    e, path = table(spark, folder, "embeddings"), shared_dir(spark, "csv")
    e.withColumn("embedding", F.to_json("embedding")).write.option("header", True).option("escape", '"').csv(path)
    rows = read_vectors(spark, path, format="csv", schema=e.schema, vector_field="embedding")
    return elements(rows, "vec_id", "embedding")


def read_jsonl_vectors(spark, folder):
    e, path = table(spark, folder, "embeddings"), shared_dir(spark, "json")
    e.write.json(path)
    return elements(read_vectors(spark, path, format="jsonl", schema=e.schema), "vec_id", "embedding")


def read_arrow_vectors(spark, folder):
    e, path = table(spark, folder, "embeddings"), shared_dir(spark, "arrow")
    stage_files(e, path, "arrow", order="vec_id", vector="embedding")
    return elements(read_vectors(spark, path, format="arrow"), "vec_id", "embedding")


# What is added to an element before scaling, and the scale, for the integer formats.
INTEGER_RANGES = {"bvecs": (1, 100), "u8bin": (1, 100), "ivecs": (0, 1000), "i8bin": (0, 100)}


def read_matrix(format: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        e, path = table(spark, folder, "embeddings"), shared_dir(spark, format)
        if format in INTEGER_RANGES:
            shift, scale = INTEGER_RANGES[format]
            whole = lambda x: F.floor((x.cast("double") + shift) * scale).cast("int")
            e = e.withColumn("embedding", F.transform("embedding", whole))
        stage_files(e.select("vec_id", "embedding"), path, format, order="vec_id", vector="embedding")
        return elements(read_vectors(spark, path, format=format), "id", "vector")

    return query


def export_manifest(spark, folder):
    """Customers under the events as of event 5000, their seq and value as a vector, exported as a snapshot."""
    path = shared_dir(spark, "export")
    rows = snapshot_at(spark, folder)
    vector = F.array(F.col("seq").cast("double"), F.col("value"))
    manifest = export(rows.select("key", "seq", vector.alias("vector")), path, seq="seq")
    stored = spark.read.parquet(path)
    return stored.groupBy((F.col("key") % 10).alias("part")).agg(F.count("*").alias("rows"), F.max("seq").alias("last"), F.round(F.max(F.col("vector")[1].cast("double")), 2).alias("most")).withColumns(
        {
            "vector_count": F.lit(manifest["vector_count"]).cast("long"),
            "part_rows": F.lit(sum(p["rows"] for p in manifest["parts"])).cast("long"),
            "input_dim": F.lit(manifest["input_dim"]).cast("int"),
            "high_water": F.lit(manifest["snapshot_high_water_seq"]).cast("long"),
        }
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "knn_cosine": knn_metric("cosine"),
    "knn_dot": knn_metric("dot_product"),
    "knn_euclidean": knn_metric("euclidean"),
    "knn_single": knn_single,
    "knn_filtered": knn_filtered,
    "knn_filter_id": knn_filter_id,
    "knn_typed_filter": knn_typed_filter,
    "knn_min_score": knn_min_score,
    "knn_join": knn_join,
    "knn_mixed": knn_mixed,
    "knn_with_payload": knn_with_payload,
    "knn_pca": knn_pca,
    "knn_pca_full": knn_pca_full,
    "knn_ivf": knn_ivf,
    "knn_index_cells": knn_index_cells,
    "knn_index_filtered": knn_index_filtered,
    "knn_index_pca": knn_index_pca,
    "knn_exact_pruned": knn_exact_pruned("cosine"),
    "knn_exact_pruned_dot": knn_exact_pruned("dot_product"),
    "knn_exact_pruned_l2": knn_exact_pruned("euclidean"),
    "knn_lsh_l2": knn_lsh_l2,
    "search_target": search_target,
    "tune_recall": tune_recall,
    "mmr": mmr("cosine", 0.7),
    "mmr_dot": mmr("dot_product", 0.5),
    "mmr_euclidean": mmr("euclidean", 0.7),
    "fetch_keys": fetch_keys,
    "fetch_stored_keys": fetch_stored_keys,
    "recall_at_k": recall_at_k,
    "ndcg_at_k": ndcg_at_k,
    "coerce_vectors": coerce_vectors,
    "normalize_vectors": normalize_vectors,
    "vector_mean": vector_mean,
    "profile_schema": profile_schema,
    "profile_files": profile_files,
    "confirm_schema": confirm_schema,
    "remap_schema": remap_schema,
    "remap_stored": remap_stored,
    "mirror_id": mirror_id,
    "promote_key": promote_key,
    "upsert_rows": upsert_rows,
    "update_rows": update_rows,
    "update_report": update_report,
    "delete_ids": delete_ids,
    "delete_report": delete_report,
    "delete_file": delete_file,
    "replace_file": replace_file,
    "idempotent_append": idempotent_append,
    "append_files": append_files,
    "list_files": list_files,
    "stored_update": stored_update,
    "stored_delete": stored_delete,
    "stored_delete_file": stored_delete_file,
    "stored_replace_file": stored_replace_file,
    "stored_files": stored_files,
    "merge_on_read": merge_on_read,
    "snapshot_at": snapshot_at,
    "wal_net_count": wal_net_count,
    "collection_stats": collection_stats,
    "stream_merge": stream_merge,
    "stream_replay": stream_replay,
    "corpus_filter": corpus_filter,
    "dedup_keep_first": dedup_keep_first,
    "corpus_join": corpus_join,
    "top_n": top_n,
    "selected_range": selected_range,
    "row_ids": row_ids,
    "top_n_few": with_few(top_n),
    "row_ids_few": with_few(row_ids),
    "corpus_build_few": with_few(corpus_build),
    "normalize_title": normalized_titles,
    "truncate_text": truncated_texts,
    "token_counts": token_counts,
    "wordpiece_ids": wordpieces,
    "embed_hash": embed_hash,
    "text_search": text_search,
    "corpus_build": corpus_build,
    "validate_corpus": validate_corpus,
    "read_csv_vectors": read_csv_vectors,
    "read_jsonl_vectors": read_jsonl_vectors,
    "read_arrow_vectors": read_arrow_vectors,
    "read_fvecs": read_matrix("fvecs"),
    "read_bvecs": read_matrix("bvecs"),
    "read_ivecs": read_matrix("ivecs"),
    "read_fbin": read_matrix("fbin"),
    "read_u8bin": read_matrix("u8bin"),
    "read_i8bin": read_matrix("i8bin"),
    "read_npy": read_matrix("npy"),
    "export_manifest": export_manifest,
}
