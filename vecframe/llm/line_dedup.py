"""Documents with one line kept of each group of equal or nearly equal lines."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecframe.llm.common import BROADCAST_BYTES, content_keys, join_counted, small_side, stored
from vecframe.llm.near import similar_classes
from vecframe.llm.shingles import char_shingles

CHARACTERS = 7
THRESHOLD = 0.8
ROUNDS = 4
TOLERANCE = 1e-8
#: Copies of one row that one task makes at a time.
COPIES = 100_000
SPACES = " \t\n\v\f\r"


def _lines(docs: DataFrame) -> DataFrame:
    """Rows (id, d1, d2, line_no, c1, c2, text): lines by number, without white space at the ends, with the keys of document and line."""
    split = docs.select("id", "d1", "d2", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "raw"))
    # Trimming characters of a list looks at every character, so only lines that need it are trimmed.
    line = F.when(_padded(F.col("raw")), F.btrim("raw", F.lit(SPACES))).otherwise(F.col("raw"))
    return split.select("id", "d1", "d2", "line_no", *content_keys(line), line.alias("text"))


def _padded(line: Column) -> Column:
    return functools.reduce(operator.or_, [end(F.lit(space)) for space in SPACES for end in (line.startswith, line.endswith)])


def line_dedup(docs: DataFrame, *, key: str = "doc_id", text: str = "text", characters: int = CHARACTERS, threshold: float = THRESHOLD) -> DataFrame:
    """One row (key, n_lines, n_kept, dropped, text) per document.

    Lines end at \\n; white space at their ends does not count. Two lines are alike if their sets of
    ``characters``-character shingles (the whole line, if shorter) have a Jaccard similarity of
    ``threshold`` or more. Of each group that such likeness joins, over all documents, the first line by document key and
    line number stays; ``dropped`` are the numbers of the other lines, from 0, and ``text`` is the text without them.

    Blank lines are alike to nothing and stay. A null text stays null, with no lines; an empty text
    has one blank line. Rows of equal key and text are documents of their own, one after the other: all but one of them lose every line that is not
    blank. A null key comes first. An empty table gives no rows. Other columns are not read.

    See ``near`` for how pairs are found: 16 bands of four values, so a pair at 0.8 is missed with a
    chance of about 2e-4; what is found is verified exactly.
    """
    read = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(key, text).alias("d1"), F.xxhash64(F.lit(7), text, key).alias("d2"))
    lines = stored(_lines(read), "line-dedup-split")
    classes = similar_classes(lines, functools.partial(char_shingles, size=characters), rounds=ROUNDS, threshold=threshold, tolerance=TOLERANCE, purpose="line-dedup", counted=False)
    # Only groups of more than one line matter from here on: those with a link or with copies.
    classes = stored(classes.where("links > 0 or copies > 1"), "line-dedup-roots")
    sizes = stored(classes.groupBy("root").agg(F.sum("copies").alias("members"), F.count("*").alias("rows")).where("members > 1").drop("members"), "line-dedup-sizes")
    groups = stored(join_counted(classes, sizes, ["root"], copies="rows", row_bytes=16).select("c1", "c2", "root"), "line-dedup-groups")
    grouped = stored(lines.select("id", "d1", "d2", "line_no", "c1", "c2").join(small_side(groups, 40), ["c1", "c2"]).select("id", "d1", "d2", "line_no", "root"), "line-dedup-lines")
    place = F.struct("id", "d1", "d2", "line_no")
    firsts = stored(grouped.groupBy("root").agg(F.min(place).alias("first"), F.count("*").alias("rows")), "line-dedup-least")
    drops = join_counted(grouped, firsts, ["root"], copies="rows").where(~place.eqNullSafe(F.col("first"))).groupBy("d1", "d2").agg(F.array_sort(F.collect_set("line_no")).alias("dropped"))
    drops = stored(drops, "line-dedup-dropped")
    size = drops.agg(F.sum(F.size("dropped") * 4 + 64)).first()[0] or 0
    marked = read.join(F.broadcast(drops) if size <= BROADCAST_BYTES else drops, ["d1", "d2"], "left").withColumn("dropped", F.coalesce("dropped", F.array().cast("array<int>")))
    # Every text that is not null has a first line.
    repeated = stored(lines.where("line_no = 0").groupBy("d1", "d2").agg(F.count("*").alias("rows")).where("rows > 1"), "line-dedup-repeated")
    if repeated.isEmpty():
        return _result(marked, key)
    # Of equal rows one stays as the lines above say; it is taken out once, and the others follow from it and their number.
    few = small_side(repeated, 40)
    firsts = stored(marked.join(few.select("d1", "d2"), ["d1", "d2"], "left_semi").dropDuplicates(["d1", "d2"]), "line-dedup-firsts")
    parts = F.transform(F.split("text", "\n", -1), lambda line, i: F.when(F.btrim(line, F.lit(SPACES)) != "", i))
    copies = firsts.join(repeated, ["d1", "d2"]).withColumn("dropped", F.filter(parts, lambda i: i.isNotNull())).withColumn("more", F.col("rows") - 1)
    # In steps, so that a row that is a third of the table is not multiplied in one task.
    steps = copies.withColumn("step", F.explode(F.expr(f"sequence(0, (more - 1) div {COPIES})"))).repartition("d1", "d2", "step")
    others = steps.withColumn("copy", F.explode(F.sequence(F.col("step") * COPIES, F.least((F.col("step") + 1) * COPIES, "more") - 1)))
    return _result(marked.join(few.select("d1", "d2"), ["d1", "d2"], "left_anti"), key).unionByName(_result(firsts, key)).unionByName(_result(others, key))


def _result(marked: DataFrame, key: str) -> DataFrame:
    parts = F.split("text", "\n", -1)
    kept = F.when(F.size("dropped") == 0, F.col("text")).otherwise(F.array_join(F.filter(parts, lambda _, i: ~F.array_contains("dropped", i)), "\n"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)
    return marked.select(F.col("id").alias(key), n_lines.cast("long").alias("n_lines"), (n_lines - F.size("dropped")).cast("long").alias("n_kept"), "dropped", kept.alias("text"))
