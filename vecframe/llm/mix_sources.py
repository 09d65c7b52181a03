"""Copies of documents such that every source takes its target share of words: pivotal dependent rounding."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vecframe.llm.common import modest_batches, small_side, stored, text_chunks
from vecframe.llm.shingles import word_spans

WEIGHTS = (1.0, 2.0, 3.0)
MOST_COPIES = 3
#: Documents that one task rounds at a time.
BLOCK = 4096
SEED = 20_240_601


def count_words(docs: DataFrame, text: str, out: str) -> DataFrame:
    """``docs`` with the number of runs other than space and 09 to 0D in place of the text."""
    modest_batches(docs.sparkSession)
    rest = [c for c in docs.columns if c != text]
    schema = docs.select(*rest).withColumn(out, F.lit(0).cast("long")).schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [np.bincount(word_spans(data, bounds)[2], minlength=len(bounds) - 1) for _, data, bounds in text_chunks(batch.column(text))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(np.concatenate([*sizes, np.zeros(0, np.int64)]), pa.int64())], names=[*rest, out])

    return docs.select(*rest, text).mapInArrow(count, schema)


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """Rows (source_no, source, source_size, target): sources by code point, null last, weigh ``weights`` in turn.

    Targets are the smaller of level x weight and most x size, with the level at which they add up to
    all sizes: what handing out the excess by weight, until no source is above its bound, ends in. The
    windows have one row per source.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    weighed = sources.withColumn("source_no", F.row_number().over(order) - 1).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), F.col("source_no") % len(weights) + 1)
    )
    full = F.col("bound") / F.col("weight")
    before = W.orderBy("full", "source_no").rowsBetween(W.unboundedPreceding, -1)
    after = W.orderBy("full", "source_no").rowsBetween(0, W.unboundedFollowing)
    levels = (
        weighed.withColumn("bound", F.col("source_size") * float(most))
        .withColumn("full", full)
        .withColumn("level", (F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum("bound").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    )
    level = F.max(F.when(F.col("level") <= F.col("full"), F.col("level"))).over(W.partitionBy())
    return levels.withColumn("at", level).select("source_no", "source", "source_size", "documents", F.least(F.coalesce(F.col("at") * F.col("weight"), F.col("bound")), F.col("bound")).alias("target"))


def row_marks(key: Column, source: Column, text: Column, seed: int = SEED) -> list[Column]:
    """128 bits of hash of a document, by which the order of rounding and its draws are chosen."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(F.lit(seed), key, source, whole).alias("mark"), F.xxhash64(F.lit(seed + 1), key, source, whole).alias("draw")]


def mix_sources(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """One row (key, size, source_size, target, taken, copies, tail_words, mark, draw) per document.

    ``size`` is the number of words. Each source gets a target (see ``source_targets``), so each of
    its documents should come target / source_size times. The whole part of that is given; the
    fractions are rounded by moving words between pairs of documents, at random and without bias, until one of the two
    is whole. Equal rows are counted first, and only the rest of
    their parts is rounded with others. What is left of a block of documents meets the rests of other blocks, up to one document per
    source, of which a last copy takes only the first ``tail_words`` words. So a source takes its
    target to within half a word. ``taken`` is copies x size + tail_words, at most ``most`` x size.

    Decisions come from hashes of key, source, text and seed (``row_marks``, returned with them): reruns and other partitionings agree. Rows with equal keys are documents
    of their own (which of two equal rows gets the copy has no meaning). A null source is one
    source, a null text has size 0 and takes no words; empty texts have a whole number of copies by
    their hash. An empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(F.col(key).alias("id"), F.col(source).alias("source"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    hashed = rows.select("*", *row_marks(F.col("id"), F.col("source"), F.col("text"), seed))
    sized = stored(count_words(hashed, "text", "size"), "mix-sizes")
    sources = stored(source_targets(sized, weights, most), "mix-sources")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = (
        sized.join(small_side(sources.withColumnRenamed("source", "of"), 100), sized.source.eqNullSafe(F.col("of")))
        .drop("of", "source")
        .withColumn("share", F.least(share, F.lit(float(most))))
        .withColumn("copies", F.floor("share"))
        .withColumn("part", F.col("share") - F.col("copies"))
        .drop("share")
    )
    unit = F.pmod("draw", F.lit(1 << 40)) / float(1 << 40)
    settled = joined.where("size = 0 or part = 0").withColumn("part", F.when(F.col("part") > unit, 1.0).otherwise(0.0))
    open_ = joined.where("size > 0 and part > 0")
    whole, open_ = _without_repeats(open_)
    done = [settled, whole]
    blocks = max(1, math.ceil((sources.agg(F.max("documents")).first()[0] or 0) / BLOCK))
    while True:
        rounded = stored(_round(open_, blocks), "mix-round")
        if blocks == 1:
            done.append(rounded)
            break
        done.append(rounded.where("part = 0 or part = 1"))
        open_ = rounded.where("part > 0 and part < 1")
        blocks = math.ceil(blocks / BLOCK)
    out = done[0]
    for df in done[1:]:
        out = out.unionByName(df)
    tail = F.when(F.col("part") < 1, F.round(F.col("part") * F.col("size"))).otherwise(0).cast("long")
    out = out.withColumn("copies", F.col("copies") + (F.col("part") == 1).cast("long")).withColumn("tail_words", tail)
    return out.select(F.col("id").alias(key), "size", "source_size", "target", (F.col("copies") * F.col("size") + F.col("tail_words")).alias("taken"), "copies", "tail_words", "mark", "draw")


def _without_repeats(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with part 0 or 1, and rows to be rounded, of which no two are equal.

    Equal rows are counted before anything groups them. Their parts add up to a whole number, that many of them with
    part 1, and a rest, which is the part of one more; the others have part 0. Nothing tells equal rows apart, so they are made from the count.
    """
    counted = stored(rows.groupBy(*rows.columns).agg(F.count("*").alias("rows")), "mix-equal")
    total = F.col("rows") * F.col("part")
    once = F.col("rows") == 1
    sure = F.when(once, 0).when(F.abs(total - F.round(total)) < 1e-9, F.round(total)).otherwise(F.floor(total)).cast("long")
    rest = F.when(once, F.col("part")).when(total - F.col("sure") < 1e-9, 0.0).otherwise(total - F.col("sure"))
    split = counted.withColumn("sure", sure).withColumn("rest", rest)
    none = F.col("rows") - F.col("sure") - (F.col("rest") > 0).cast("long")
    made = split.where("rows > 1").select(*[c for c in rows.columns if c != "part"], F.explode(F.array(*[F.struct(n.alias("n"), F.lit(p).alias("part")) for n, p in ((F.col("sure"), 1.0), (none, 0.0))])).alias("of"))
    # In pieces of BLOCK rows, dealt over the tasks.
    pieces = made.where("of.n > 0").withColumn("piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("of.n") - 1) / BLOCK)))).repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    items = F.array_repeat(F.lit(0), F.least(F.lit(BLOCK), F.col("of.n") - F.col("piece") * BLOCK).cast("int"))
    whole = pieces.withColumn("item", F.explode(items)).withColumn("part", F.col("of.part")).select(*rows.columns)
    return whole, split.where("rest > 0").withColumn("part", F.col("rest")).select(*rows.columns)


def _round(rows: DataFrame, blocks: int) -> DataFrame:
    """``part`` of each row made 0 or 1, but for one row at most of each source and block."""

    def settle(group: pa.Table) -> pa.Table:
        group = group.sort_by([("mark", "ascending"), ("draw", "ascending"), ("size", "ascending")])
        parts = pivotal(group["part"].to_pylist(), group["size"].to_pylist(), (np.asarray(group["draw"]).view(np.uint64) >> np.uint64(11)) / float(1 << 53))
        return group.set_column(group.schema.get_field_index("part"), "part", pa.array(parts, pa.float64())).drop_columns(["block"])

    blocked = rows.withColumn("block", F.pmod(F.xxhash64("mark", F.lit(blocks)), F.lit(blocks)))
    return blocked.groupBy("source_no", "block").applyInArrow(settle, rows.schema)


def pivotal(parts: list[float], sizes: list[int], draws) -> list[float]:
    """Parts rounded in turn; the sum of part x size stays, and so does the expectation of each part."""
    parts = list(parts)
    i = 0
    for j in range(1, len(parts)):
        up = min((1 - parts[i]) * sizes[i], parts[j] * sizes[j])
        down = min(parts[i] * sizes[i], (1 - parts[j]) * sizes[j])
        move = up if draws[j] * (up + down) < down else -down
        left, right = parts[i] + move / sizes[i], parts[j] - move / sizes[j]
        left, right = (round(p) if abs(p - round(p)) < 1e-12 else p for p in (left, right))
        parts[i], parts[j] = float(left), float(right)
        if parts[i] in (0.0, 1.0):
            i = j
    return parts
