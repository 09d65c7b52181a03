"""Joins with a side that says how often each of its keys is asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecframe.session import shuffle_tasks

BROADCAST_BYTES = 32 * 1024 * 1024


def join_counted(rows: DataFrame, side: DataFrame, on: list[str], *, copies: str = "copies", row_bytes: int = 64, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``rows`` joined with stored ``side``, one row per key, that counts in ``copies`` how many of ``rows`` have it.

    A side that fits ``limit`` is broadcast. Else the keys with more than a quarter of a task's even share of rows are, of which there are at most four
    a task since their rows add up, and the others meet by shuffle; so no key makes a task long.
    """
    facts = side.agg(F.count("*").alias("keys"), F.sum(copies).alias("rows")).first()
    if facts.keys * row_bytes <= limit:
        return rows.join(F.broadcast(side), on)
    share = facts.rows // (4 * shuffle_tasks(side.sparkSession))
    hot = F.broadcast(side.where(F.col(copies) > share))
    rest = rows.join(hot.select(*on), on, "left_anti").join(side.where(F.col(copies) <= share), on)
    return rows.join(hot, on).unionByName(rest)
