"""Rows dealt to shards of nearly equal size, groups kept together: longest processing time first."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecframe.llm.common import batch_of, content_keys, join_counted, small_side, stored
from vecframe.session import shuffle_tasks

SHARDS = 40
#: Bytes a document costs beside its text.
OVERHEAD = 16
ROWS_PER_FILE = 100_000
#: From so many groups of one size on, their shares are worked out at once instead of one by one.
RUN = 64
#: monotonically_increasing_id counts rows within a partition in so many bits.
PARTITION_BITS = 33


class Scheduler:
    """Groups, largest first, each to the shard with the least load (of equal ones, the first)."""

    def __init__(self, shards: int):
        self.heap = [(0, s) for s in range(shards)]

    def deal(self, size: int, count: int) -> list[int]:
        """How many of ``count`` groups of ``size`` each shard takes."""
        taken = [0] * len(self.heap)
        if count >= RUN:
            return self._deal_many(size, count)
        for _ in range(count):
            load, shard = self.heap[0]
            heapq.heapreplace(self.heap, (load + size, shard))
            taken[shard] += 1
        return taken

    def _deal_many(self, size: int, count: int) -> list[int]:
        """The same, by the level at which the shards' next turns come to ``count``.

        A shard of load l has turns at l, l + size, ...; one by one the heap serves turns in the order of (level, shard).
        """
        shards = len(self.heap)
        loads = [0] * shards
        for load, shard in self.heap:
            loads[shard] = load
        before = lambda level: sum(-((load - level) // size) for load in loads if load < level)
        low, high = min(loads), max(loads) + size * (count // shards + 2)
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if before(middle) <= count else (low, middle)
        taken = [-((load - low) // size) if load < low else 0 for load in loads]
        left = count - sum(taken)
        for shard in range(shards):
            if left and loads[shard] + taken[shard] * size == low:
                taken[shard] += 1
                left -= 1
        self.heap = [(loads[s] + taken[s] * size, s) for s in range(shards)]
        heapq.heapify(self.heap)
        return taken


def balanced_shards(
    rows: DataFrame, *, group: list[Column], size: Column, shards: int = SHARDS, carry: dict[str, Column] | None = None
) -> DataFrame:
    """One row (*carry, size, shard, slot) per row: rows of equal ``group`` share a shard, and shards have sizes near equal.

    Groups are sorted by their summed ``size`` and go, largest first, to the shard with the least load. ``size`` is a
    positive whole number per row. ``slot`` counts the rows of a shard from 0 without gaps, in the order of the table's partitions.
    A group larger than a shard's even share fills a shard alone. Groups whose columns are null are equal. An empty table gives no rows.

    The heap needs sizes alone, and equal sizes are one step. A table of T bytes has less than sqrt(2 T) different sizes of
    groups, and so many rows, and one per task, pass the one task with the heap: 14 million at 100 TB, held by Spark's sort. Groups, and rows, never do.
    A group with very many rows is summed per task; its rows find their shard by a broadcast of the few such groups.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    carry = carry or {}
    c1, c2 = F.xxhash64(*group).alias("c1"), F.xxhash64(F.lit(7), *group).alias("c2")
    keyed = stored(rows.select(F.struct(*[c.alias(n) for n, c in carry.items()] or [F.lit(0)]).alias("carried"), size.cast("long").alias("size"), c1, c2, F.monotonically_increasing_id().alias("at")), "shard-rows")
    summed = keyed.groupBy("c1", "c2").agg(F.sum("size").alias("total"), F.count("*").alias("copies"))
    # By size; the hashes spread a size that very many groups have over partitions.
    ordered = summed.repartitionByRange(shuffle_tasks(rows.sparkSession), F.desc("total"), "c1", "c2").sortWithinPartitions(F.desc("total"), "c1", "c2")
    groups = stored(ordered.withColumn("place", F.monotonically_increasing_id()), "shard-groups").withColumn("part", F.shiftright("place", PARTITION_BITS))
    runs = groups.groupBy("part", "total").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    dealt = stored(runs.repartition(1).sortWithinPartitions(F.desc("total"), "part").mapInArrow(_deal(shards), "part long, total long, first long, ends array<long>, to array<int>"), "shard-runs")
    place = F.element_at("to", F.size(F.filter("ends", lambda end: end <= F.col("place") - F.col("first"))) + 1)
    homes = stored(groups.join(small_side(dealt, 64 + 12 * shards), ["part", "total"]).select("c1", "c2", "copies", place.alias("shard")), "shard-homes")
    placed = stored(join_counted(keyed, homes, ["c1", "c2"]).select("carried", "size", "shard", "at", F.shiftright("at", PARTITION_BITS).alias("block")), "shard-placed")
    counts = placed.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")), "shard-starts")
    within = Window.partitionBy("shard", "block").orderBy("at")
    numbered = placed.withColumn("nth", F.row_number().over(within)).join(small_side(starts, 32), ["shard", "block"])
    return numbered.select(*[F.col(f"carried.{n}").alias(n) for n in carry], "size", "shard", (F.col("start") + F.col("nth") - 1).alias("slot"))


def _deal(shards: int):
    schema = pa.schema([("part", pa.int64()), ("total", pa.int64()), ("first", pa.int64()), ("ends", pa.list_(pa.int64())), ("to", pa.list_(pa.int32()))])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scheduler = Scheduler(shards)
        for batch in batches:
            ends, to = [], []
            for total, n in zip(batch.column("total").to_pylist(), batch.column("n").to_pylist(), strict=True):
                taken = np.array(scheduler.deal(total, n))
                some = np.flatnonzero(taken)
                ends.append(np.cumsum(taken[some]))
                to.append(some)
            yield batch_of(schema, batch.column("part"), batch.column("total"), batch.column("first"), ends, to)

    return deal


def document_shards(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shards: int = SHARDS, with_text: bool = False) -> DataFrame:
    """One row (key, size, text_crc32, law, shard, slot, grown_shard), and the text if asked for, per document; equal texts share a shard.

    A document's size is its UTF-8 bytes and 16. A null text counts as an empty one: its size is 16, its checksum 0, and both are equal texts.
    Rows with equal keys, and null keys, are documents of their own. The law is ``bytes``, so ``grown_shard`` is null. Other columns are not read.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    carry = {"id": F.col(key), "crc": F.crc32(whole)} | ({"text": F.col(text)} if with_text else {})
    placed = balanced_shards(docs, group=[whole], size=F.octet_length(whole) + OVERHEAD, shards=shards, carry=carry)
    return placed.select(
        F.col("id").alias(key), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), *[F.col("text").alias(text)] * with_text,
    )


def write_document_shards(docs: DataFrame, folder: str, *, rows_per_file: int = ROWS_PER_FILE, **options) -> None:
    """The documents as Parquet, a folder per shard, in the order of their slots; a shard of very many documents is many files."""
    placed = document_shards(docs, with_text=True, **options).withColumn("file", F.floor(F.col("slot") / rows_per_file))
    placed.repartition("shard", "file").sortWithinPartitions("shard", "file", "slot").drop("file").write.partitionBy("shard").parquet(folder)
