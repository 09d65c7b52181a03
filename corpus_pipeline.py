"""A training corpus from documents: quality, near duplicates, benchmark leaks, mixture, token shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecframe.llm.common import small_side, stored, table
from vecframe.llm.decontaminate import find_leaks
from vecframe.llm.mix_sources import mix_sources, row_marks
from vecframe.llm.ngram_join import ngram_join
from vecframe.llm.quality import quality_filter
from vecframe.llm.queries import VOCABULARY
from vecframe.llm.token_shards import write_shards

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
KEYS = ["k1", "k2"]
ROW_BYTES = 40


def _keyed(docs: DataFrame) -> DataFrame:
    """The columns of documents with two hashes of all that decisions depend on; rows with equal keys are alike to every stage."""
    whole = ["doc_id", "lang", "source", "text"]
    return docs.select(*COLUMNS, F.xxhash64(*whole).alias("k1"), F.xxhash64(F.lit(7), *whole).alias("k2"))


def _without(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """``docs`` without the keys of ``decided``."""
    return docs.join(small_side(stored(decided.select(*KEYS).distinct(), "dropped"), ROW_BYTES), KEYS, "left_anti").select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is usual for trusted texts of their language."""
    keyed = _keyed(docs)
    judged = quality_filter(keyed, table(spark, sf_dir, "labels"), carry=tuple(KEYS))
    return _without(keyed, judged.where(~F.col("kept")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    keyed = _keyed(docs)
    kept = stored(ngram_join(keyed, carry=tuple(KEYS)).groupBy(*KEYS).agg(F.sum(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("rows")), "kept")
    out = _without(keyed, kept.where("kept < rows"))
    # Of rows that are equal throughout, keys cannot tell the one that stays.
    repeated = kept.where("kept > 0 and kept < rows").select(*KEYS)
    if repeated.head():
        out = out.unionByName(keyed.join(repeated, KEYS, "left_semi").dropDuplicates(KEYS).select(*COLUMNS))
    return out


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    keyed = _keyed(docs)
    leaks = find_leaks(keyed, table(spark, sf_dir, "benchmark"), carry=tuple(KEYS))
    return _without(keyed, leaks.where("contaminated"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for: a row per copy, and for one document of a source a row with its first words."""
    marks = ["mark", "draw"]
    marked = docs.select(*COLUMNS, *row_marks(F.col("doc_id"), F.col("source"), F.col("text")))
    taken = stored(mix_sources(docs).groupBy(*marks).agg(F.sum("copies").alias("copies"), F.max("tail_words").alias("tail"), F.count("*").alias("rows")), "mixed")
    # Rows of equal key, source and text take their copies together.
    repeated = taken.where("rows > 1").select(*marks)
    if repeated.head():
        marked = marked.join(repeated, marks, "left_anti").unionByName(marked.join(repeated, marks, "left_semi").dropDuplicates(marks))
    joined = marked.join(small_side(taken.where("copies > 0 or tail > 0").drop("rows"), ROW_BYTES), marks)
    whole = joined.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select(*COLUMNS)
    words = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = joined.where("tail > 0").withColumn("text", F.array_join(F.slice(words, F.lit(1), F.col("tail").cast("int")), "")).withColumn("n_chars", F.length("text").cast("long"))
    return whole.unionByName(cut.select(*COLUMNS))


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All sequences in training order, one row each; the files are in the shared folder."""
    return write_shards(docs, VOCABULARY)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed),
    ("token-ID / binary output", token_shards),
]

#: Neither the model's perplexity nor the random rounding can be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").replace("/", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
