"""Session settings shared by the jobs: the folder all executors can reach, and parallelism."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession

SMALL_SHARE = 16 * 1024 * 1024


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can read and write.

    Without that setting it is below the checkpoint folder of the session, else below its warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = known.get() if known.isDefined() else None
    base = base or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def task_slots(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


def shuffle_tasks(spark: SparkSession) -> int:
    """Tasks of a shuffle as the session has it set; unlike the slots it does not depend on which executors are up."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def scan_tasks(df: DataFrame) -> int:
    """About how many tasks scan the rows, by Spark's estimate of their size."""
    return math.ceil(estimated_bytes(df) / (128 * 1024 * 1024))


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own size estimate, made without running anything."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def pieces(df: DataFrame, least: int, piece_bytes: int = 64 * 1024 * 1024) -> int:
    """How many partitions of about ``piece_bytes`` the rows make, ``least`` or more."""
    return max(least, math.ceil(estimated_bytes(df) / piece_bytes))


def spread(df: DataFrame) -> DataFrame:
    """A small input over all task slots, for work that costs far more than moving the rows.

    A small table is often one file split, hence one task. By Spark's estimate only inputs below
    16 MiB per slot are moved; anything larger is left where it is.
    """
    slots = task_slots(df.sparkSession)
    return df.repartition(slots) if estimated_bytes(df) < slots * SMALL_SHARE else df
