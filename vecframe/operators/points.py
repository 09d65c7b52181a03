"""Tables laid out for reads by key: in key order, with a Bloom filter of the key in every row group."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecframe.operators.tables import fetch

#: Keys that are given to a scan one by one; more are joined.
MOST_PUSHED = 1000
#: Spark hands Parquet a list of values as such only up to this length, by default; longer ones as a range.
IN_LENGTH = 10
GROUP_BYTES = 16 * 1024 * 1024


def write_keyed(df: DataFrame, path: str, key: str, *, parts: int | None = None, group_bytes: int = GROUP_BYTES, keys_per_group: int = 100_000) -> None:
    """Store ``df`` in order of ``key``, in row groups of about ``group_bytes`` that each know their range of keys and have a Bloom filter of them."""
    ordered = df.repartitionByRange(parts, key) if parts else df.repartitionByRange(key)
    options = {"parquet.bloom.filter.enabled#" + key: "true", "parquet.bloom.filter.expected.ndv#" + key: str(keys_per_group), "parquet.block.size": str(group_bytes)}
    ordered.sortWithinPartitions(key).write.options(**options).parquet(path)


def among(column: Column, values: Iterable) -> Column:
    """Equality with any of the values, in pieces short enough to reach the row groups' statistics and Bloom filters."""
    values = list(values)
    pieces = [column.isin(values[i : i + IN_LENGTH]) for i in range(0, len(values), IN_LENGTH)]
    while len(pieces) > 1:  # a balanced tree, so that its depth stays small
        pieces = [pieces[i] | pieces[i + 1] if i + 1 < len(pieces) else pieces[i] for i in range(0, len(pieces), 2)]
    return pieces[0] if pieces else F.lit(False)


def fetch_stored(spark: SparkSession, path: str, keys: DataFrame, *, key: str, most: int = MOST_PUSHED) -> DataFrame:
    """``fetch`` from a table of ``write_keyed``: up to ``most`` different keys are pushed into the scan, which reads few row groups."""
    table = spark.read.parquet(path)
    wanted = [r[0] for r in keys.select(key).where(F.col(key).isNotNull()).distinct().limit(most + 1).collect()]
    return fetch(table.where(among(F.col(key), wanted)) if len(wanted) <= most else table, keys, key=key)
