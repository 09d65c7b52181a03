"""A vector table stored by source file, whose changes rewrite only the files they touch.

Each source file is a partition. A change finds the files of its keys by a scan of the key column, works out their new content,
and overwrites these partitions alone (``partitionOverwriteMode=dynamic``); all others keep their files as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecframe.operators.tables import LOG_NAME, check_filename, file_actions, log_net_count, newest, travelling
from vecframe.session import shared_dir
from vecframe.sources import storage

#: Names of touched files that a scan is given to prune by.
MOST_NAMES = 10_000


class FiledTable:
    """Rows with a unique ``key``, a number ``seq`` that grows with every write, and ``source_file``."""

    def __init__(self, spark: SparkSession, path: str, *, key: str = "key", seq: str = "seq", source_file: str = "source_file"):
        self.spark, self.path = spark, path.rstrip("/")
        self.key, self.seq, self.file = key, seq, source_file

    def create(self, rows: DataFrame) -> FiledTable:
        """Store the first content; the table must not exist."""
        wrong = rows.where(~F.col(self.file).rlike("^[a-zA-Z0-9._-]+$")).select(self.file).head()
        if wrong:
            check_filename(wrong[0])
        # By key too, so that a file with very many rows is not one task.
        rows.repartition(self.file, F.pmod(F.xxhash64(self.key), F.lit(4))).write.partitionBy(self.file).parquet(self.path)
        return self

    def read(self) -> DataFrame:
        """The rows. File names are read as text, also where they look like numbers or dates."""
        found = self.spark.read.parquet(self.path).schema
        fields = [T.StructField(f.name, T.StringType()) if f.name == self.file else f for f in found]
        return self.spark.read.schema(T.StructType(fields)).parquet(self.path)

    # --- reads ---

    def files(self, log: DataFrame | None = None, *, op: str = "op") -> DataFrame:
        """One row (name, vector_count, size, modified, is_wal) per source file, and one for a log of operations with its net count."""
        parts = self.read().select(self.file, "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
        each = parts.groupBy(self.file, "file_path", "file_size", "file_modification_time").agg(F.count("*").alias("rows"))
        listed = each.groupBy(F.col(self.file).alias("name")).agg(
            F.sum("rows").alias("vector_count"), F.sum("file_size").alias("size"), F.max("file_modification_time").alias("modified"), F.lit(False).alias("is_wal")
        )
        if log is None:
            return listed
        entry = log_net_count(log, key=self.key, seq=self.seq, op=op)
        columns = [F.lit(LOG_NAME).alias("name"), "vector_count", F.lit(None).cast("long").alias("size"), F.lit(None).cast("timestamp").alias("modified"), F.lit(True).alias("is_wal")]
        return listed.unionByName(entry.select(*columns))

    # --- changes: each returns a report with one row per touched file ---

    def update_rows(self, changes: DataFrame) -> DataFrame:
        """Replace rows that exist; they stay in their file. Rows (source_file, updated); changes to unknown keys alter nothing and are counted under a null file."""
        changes = self._kept(newest(changes, self.key, self.seq).drop(self.file), "changes")
        homes = self._homes(changes)
        matched = changes.join(homes, self.key)
        self._rewrite(homes, matched)
        counted = changes.select(self.key).join(homes, self.key, "left").groupBy(self.file)
        return self._kept(counted.agg(F.count("*").alias("updated")), "report")

    def delete_ids(self, ids: DataFrame) -> DataFrame:
        """Drop rows by key. Rows (source_file, deleted)."""
        homes = self._homes(self._kept(ids.select(self.key).distinct(), "ids"))
        self._rewrite(homes, None)
        return homes.groupBy(self.file).agg(F.count("*").alias("deleted"))

    def upsert(self, rows: DataFrame) -> DataFrame:
        """Add rows, or replace those of equal key and lower or equal ``seq``, wherever they are. Rows (source_file, written).

        Rows that lose to a newer one in the table are left out.
        """
        rows = self._kept(newest(rows, self.key, self.seq), "changes")
        held = self.read().select(self.key, F.col(self.seq).alias("_seq"), F.col(self.file).alias("_file")).join(travelling(rows.select(self.key)), self.key, "left_semi")
        held = self._kept(held, "held")
        winners = rows.join(held, self.key, "left").where(F.col("_seq").isNull() | (F.col("_seq") <= F.col(self.seq))).drop("_seq", "_file")
        winners = self._kept(winners, "winners")
        beaten = held.join(travelling(winners.select(self.key)), self.key, "left_semi").select(self.key, F.col("_file").alias(self.file))
        self._rewrite(self._kept(beaten, "beaten"), winners)
        return winners.groupBy(self.file).agg(F.count("*").alias("written"))

    def append_files(self, rows: DataFrame, loaded: DataFrame, incoming: DataFrame) -> DataFrame:
        """Load files not loaded yet, by ``name`` and ``size`` (see ``file_actions``). Rows (name, size, action)."""
        actions = self._kept(file_actions(loaded, incoming), "actions")
        names = actions.where("action = 'load'").select(F.col("name").alias(self.file))
        self.upsert(rows.join(travelling(names), self.file, "left_semi"))
        return actions

    def delete_file(self, name: str) -> None:
        """Drop one file, which must exist. Nothing else is read or written."""
        self._require(name)
        storage.remove(self.spark, f"{self.path}/{self.file}={name}")

    def replace_file(self, name: str, rows: DataFrame) -> DataFrame:
        """Exchange all rows of one existing file; equal content is written again. A key that other files hold too stays once: the higher ``seq`` wins."""
        self._require(name)
        rows = self._kept(rows.drop(self.file).withColumn(self.file, F.lit(name)), "replacement")
        of_file = self.read().where(F.col(self.file) == name)  # a partition, so the rest is not read
        gone = self._kept(of_file.join(travelling(rows.select(self.key)), self.key, "left_anti").select(self.key, self.file), "gone")
        rows = newest(rows, self.key, self.seq)
        others = self.read().where(~F.col(self.file).eqNullSafe(F.lit(name))).select(self.key, F.col(self.seq).alias("_seq"), F.col(self.file).alias("_file"))
        held = self._kept(others.join(travelling(rows.select(self.key)), self.key, "left_semi"), "held")
        winners = self._kept(rows.join(held, self.key, "left").where(F.col("_seq").isNull() | (F.col("_seq") <= F.col(self.seq))).drop("_seq", "_file"), "winners")
        beaten = held.join(travelling(winners.select(self.key)), self.key, "left_semi").select(self.key, F.col("_file").alias(self.file))
        every = of_file.select(self.key, self.file)
        self._rewrite(self._kept(beaten.unionByName(every), "beaten"), winners)
        return gone.groupBy(self.file).agg(F.count("*").alias("dropped"))

    # --- how ---

    def _require(self, name: str) -> None:
        check_filename(name)
        if not storage.exists(self.spark, f"{self.path}/{self.file}={name}"):
            raise FileNotFoundError(f"no rows of file {name!r}")

    def _homes(self, keys: DataFrame) -> DataFrame:
        """Stored rows (key, source_file) of the keys that the table holds; of the table only these two columns are read."""
        return self._kept(self.read().select(self.key, self.file).join(travelling(keys.select(self.key)), self.key, "left_semi"), "homes")

    def _rewrite(self, removed: DataFrame, added: DataFrame | None) -> None:
        """New content for the files of ``removed`` (key, source_file), whose rows go, and of ``added``, whose rows come."""
        names = removed.select(self.file)
        if added is not None:
            names = names.unionByName(added.select(self.file))
        touched = self._kept(names.distinct(), "touched")
        base = self.read()
        kept = self._of_files(base, touched).join(travelling(removed.select(self.key)), self.key, "left_anti")
        content = kept if added is None else kept.unionByName(added.select(*base.columns))
        # Aside first: a partition cannot be overwritten while it is read, and a failed write must not leave half of it.
        staged = self._kept(content, "staged")
        placed = staged.repartition(self.file, F.pmod(F.xxhash64(self.key), F.lit(4)))
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.file).parquet(self.path)
        # A file without rows is no partition of what was written, so it is removed.
        emptied = touched.join(staged.select(self.file).distinct().withColumnRenamed(self.file, "_left"), F.col(self.file).eqNullSafe(F.col("_left")), "left_anti")
        for row in emptied.toLocalIterator():
            storage.remove(self.spark, f"{self.path}/{self.file}={row[0] if row[0] is not None else '__HIVE_DEFAULT_PARTITION__'}")

    def _of_files(self, base: DataFrame, touched: DataFrame) -> DataFrame:
        """Rows of the touched files. Up to ``MOST_NAMES`` names become a predicate on the partition, so that other files are not even opened."""
        names = [r[0] for r in touched.limit(MOST_NAMES + 1).collect()]
        if len(names) > MOST_NAMES:
            return base.join(travelling(touched.withColumnRenamed(self.file, "_touched")), F.col(self.file).eqNullSafe(F.col("_touched")), "left_semi")
        named = F.col(self.file).isin([n for n in names if n is not None])
        return base.where(named | F.col(self.file).isNull() if None in names else named)

    def _kept(self, df: DataFrame, purpose: str) -> DataFrame:
        path = shared_dir(self.spark, purpose)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
