"""The operators of this subpackage on the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecframe.llm.balanced_shards import document_shards
from vecframe.llm.centroid_clusters import described_clusters
from vecframe.llm.common import table
from vecframe.llm.decontaminate import find_leaks
from vecframe.llm.line_dedup import line_dedup
from vecframe.llm.main_text import extract_main_text
from vecframe.llm.mix_sources import mix_sources
from vecframe.llm.near_vectors import near_vectors
from vecframe.llm.ngram_join import ngram_join
from vecframe.llm.oracle import ORACLE  # noqa: F401
from vecframe.llm.quality import quality_filter
from vecframe.llm.secrets import RULES, joined_spans, scan_documents
from vecframe.llm.token_shards import write_shards
from vecframe.llm.toxicity import toxicity
from vecframe.llm.vector_codes import described_codes

#: The rank file of a public byte-level tokenizer; it is read, never copied.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def op1_ngram_join(spark, folder):
    return ngram_join(table(spark, folder, "documents"))


def op2_near_vectors(spark, folder):
    return near_vectors(table(spark, folder, "embeddings"))


def op3_toxicity(spark, folder):
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_line_dedup(spark, folder):
    return line_dedup(table(spark, folder, "documents"))


def op5_token_shards(spark, folder):
    return write_shards(table(spark, folder, "documents"), VOCABULARY)


def op6_mix_sources(spark, folder):
    return mix_sources(table(spark, folder, "documents")).drop("mark", "draw")


def op7_secrets(spark, folder):
    found = scan_documents(table(spark, folder, "documents"))
    sizes = [F.size(r.kind).cast("long").alias(f"n_{r.kind}") for r in RULES]
    # The ledger adds no spans of its own, so all spans are the base ones.
    return found.select("doc_id", *sizes, joined_spans().alias("spans")).select("doc_id", *[f"n_{r.kind}" for r in RULES], F.sha2("spans", 256).alias("base_sha256"), "spans")


def op8_main_text(spark, folder):
    return extract_main_text(table(spark, folder, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_decontaminate(spark, folder):
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_quality(spark, folder):
    return quality_filter(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_balanced_shards(spark, folder):
    return document_shards(table(spark, folder, "documents"))


def op12_centroid_clusters(spark, folder):
    return described_clusters(table(spark, folder, "embeddings"))


def op13_vector_codes(spark, folder):
    return described_codes(table(spark, folder, "embeddings"))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_near_vectors": op2_near_vectors,
    "op3_toxicity": op3_toxicity,
    "op4_line_dedup": op4_line_dedup,
    "op5_token_shards": op5_token_shards,
    "op6_mix_sources": op6_mix_sources,
    "op7_secrets": op7_secrets,
    "op8_main_text": op8_main_text,
    "op9_decontaminate": op9_decontaminate,
    "op10_quality": op10_quality,
    "op11_balanced_shards": op11_balanced_shards,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_vector_codes": op13_vector_codes,
}

