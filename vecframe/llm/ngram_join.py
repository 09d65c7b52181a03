"""Documents joined by the Jaccard similarity of their word n-grams."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecframe.llm.common import content_keys, stored
from vecframe.llm.near import similar_classes
from vecframe.llm.shingles import word_shingles

WORDS = 5
THRESHOLD = 0.8
#: Chance below which a pair is given up before it is verified.
TOLERANCE = 1e-8
ROUNDS = 8


def ngram_join(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = WORDS, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row (key, n_links, class_id, kept, and the columns to ``carry``) per document.

    Two documents are linked if their sets of ``words``-word shingles have a Jaccard similarity of
    ``threshold`` or more. ``n_links`` counts the other documents linked directly, copies included;
    ``class_id`` is the smallest key that links reach, ``kept`` is true for that document alone.

    Words are runs of characters other than space and 09 to 0D. A shorter text is one shingle. A null, empty or
    blank text links with nothing and is kept. Rows with equal keys, and rows that are equal
    throughout, are documents of their own, of which a class keeps one. A null key ranks after all
    others. Other columns are not read. An empty table gives no rows.

    A pair is missed only if none of 32 bands of four MinHash values agree (chance 5e-8 at 0.8) or
    if its values look, by ``tolerance``, too different. No pair is ever written out: see ``near``.
    """
    read = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), *[F.col(c).alias(f"carried_{c}") for c in carry])
    items = read.select(*content_keys(F.col("text")), "text")
    classes = similar_classes(items, functools.partial(word_shingles, size=words), rounds=ROUNDS, threshold=threshold, tolerance=tolerance, purpose="ngram-join")
    rows = stored(read.select("id", *[f"carried_{c}" for c in carry], *content_keys(F.col("text")), F.monotonically_increasing_id().alias("row")), "ngram-join-rows")
    joined = rows.join(classes, ["c1", "c2"], "left")
    first = F.min(F.struct(F.col("id").isNull(), "id", "row"))
    firsts = joined.where("root is not null").groupBy("root").agg(first.alias("first")).select("root", F.col("first.id").alias("class_id"), F.col("first.row").alias("first_row"))
    return joined.join(firsts, "root", "left").select(
        F.col("id").alias(key),
        F.when(F.col("root").isNull(), F.lit(0)).otherwise(F.col("links") + F.col("copies") - 1).cast("long").alias("n_links"),
        F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        (F.col("root").isNull() | (F.col("row") == F.col("first_row"))).alias("kept"),
        *[F.col(f"carried_{c}").alias(c) for c in carry],
    )
