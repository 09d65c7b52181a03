"""Tables bucketed and sorted by key, so that a merge of changes moves the changes alone."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecframe.operators.tables import VersionedTable, newest
from vecframe.session import shared_dir, shuffle_tasks


def save_bucketed(df: DataFrame, folder: str, key: str, buckets: int, *, placed: bool = False) -> DataFrame:
    """Write ``df`` in ``buckets`` files by a hash of ``key``, and open it; ``placed`` if its tasks hold one bucket each already."""
    name = f"bucketed_{uuid.uuid4().hex}"
    rows = df if placed else df.repartition(buckets, key)
    rows.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", folder).saveAsTable(name)
    return _opened(df.sparkSession, name)


def open_bucketed(spark: SparkSession, folder: str, key: str, buckets: int, columns: str) -> DataFrame:
    name = f"bucketed_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{folder}'")
    return _opened(spark, name)


def _opened(spark: SparkSession, name: str) -> DataFrame:
    """The table's rows. Its entry in the catalog is needed only until it is resolved; the files are outside of the warehouse and stay."""
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


class BucketedTable(VersionedTable):
    """A ``VersionedTable`` whose versions are bucketed by ``key``; the number of buckets is that of its first version."""

    def __init__(self, spark: SparkSession, path: str, *, key: str = "key", buckets: int | None = None):
        super().__init__(spark, path)
        self.key, self.wanted = key, buckets

    @property
    def buckets(self) -> int:
        latest = self._latest()
        return latest["buckets"] if latest else self.wanted or shuffle_tasks(self.spark)

    def _open(self, entry: dict) -> DataFrame:
        return open_bucketed(self.spark, f"{self.path}/{entry['folder']}", self.key, entry["buckets"], entry["columns"])

    def _save(self, df: DataFrame, folder: str) -> dict:
        buckets = self.buckets
        # A merge of bucketed sides leaves each task with its bucket.
        saved = save_bucketed(df, folder, self.key, buckets, placed=self._merged(df, buckets))
        return {"buckets": buckets, "columns": saved._jdf.schema().toDDL()}

    def _merged(self, df: DataFrame, buckets: int) -> bool:
        plan = df._jdf.queryExecution().sparkPlan().toString()
        return self.exists() and f"{buckets} out of {buckets}" in plan

    def merged(self, log: DataFrame, *, seq: str = "seq") -> DataFrame:
        """The table under a log: of each key the row with the highest ``seq``, where they tie the log's.

        The newest rows of the log are bucketed like the table, and both are merged bucket by bucket: the table is read once and not shuffled, however large the log is.
        """
        latest = newest(log, self.key, seq)
        if not self.exists():
            return latest
        base = self.read()
        changes = save_bucketed(latest, shared_dir(self.spark, "newest"), self.key, self.buckets)
        columns = [*base.columns, *[c for c in changes.columns if c not in base.columns]]
        old, new = F.col("_old"), F.col("_new")
        left = base.select(F.col(self.key).alias("_k"), F.struct(*base.columns).alias("_old"))
        right = changes.select(F.col(self.key).alias("_l"), F.struct(*changes.columns).alias("_new"))
        met = left.join(right.hint("merge"), F.col("_k") == F.col("_l"), "full_outer")
        wins = new.isNotNull() & (old.isNull() | (new[seq] >= old[seq]))
        pick = lambda c: F.when(wins, new[c] if c in changes.columns else F.lit(None)).otherwise(old[c] if c in base.columns else F.lit(None))
        return met.select(*[pick(c).alias(c) for c in columns])
