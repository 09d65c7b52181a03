"""Keeping vector tables up to date: upsert, update, delete, replace, and merge on read.

A table is a DataFrame with a key column, a sequence number ``seq`` that grows with every write,
and ``source_file``, the name of the file a row came from. Each function returns the new content;
``VersionedTable`` stores it. Writes are usually far smaller than the table, so the table itself is
filtered by the changed keys, which travel to it when their measured size allows.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vecframe.session import shared_dir
from vecframe.sources import storage

# The names a file may have, and the name under which the log is listed.
VALID_FILENAME = re.compile(r"^[a-zA-Z0-9._-]+$")
LOG_NAME = "__wal__"

BROADCAST_LIMIT = 64 * 1024 * 1024


def check_filename(name: str) -> str:
    if not VALID_FILENAME.match(name):
        raise ValueError(f"file name {name!r} may hold only letters, digits, dots, hyphens and underscores")
    return name


def key_bytes(keys: DataFrame) -> int:
    """Measured size of a table of keys as it would be held in memory."""
    widths = [F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) + 24 for c in keys.columns]
    return keys.agg(F.sum(sum(widths[1:], widths[0])).alias("bytes")).first().bytes or 0


def travelling(keys: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``keys`` marked for broadcast if it measures at most ``limit`` bytes, else unmarked.

    Measured up front, because a join planned as a shuffle has already moved the large side by the
    time adaptive execution sees how small the other side is.
    """
    return F.broadcast(keys) if key_bytes(keys) <= limit else keys


def newest(rows: DataFrame, key: str = "key", seq: str = "seq") -> DataFrame:
    """The row with the highest ``seq`` per key.

    Spark keeps one row per key and task before the shuffle, so a key written very often is no hot spot.
    """
    latest = Window.partitionBy(key).orderBy(F.col(seq).desc())
    return rows.withColumn("_place", F.row_number().over(latest)).where("_place = 1").drop("_place")


def upsert(base: DataFrame, changes: DataFrame, *, key: str = "key", seq: str = "seq") -> DataFrame:
    """``base`` with the rows of ``changes`` added or replaced; the higher ``seq`` wins."""
    if key not in changes.columns:
        raise ValueError(f"rows without {key!r} cannot be merged")
    return merge_on_read(base, changes, key=key, seq=seq)


def merge_on_read(
    base: DataFrame,
    log: DataFrame,
    *,
    key: str = "key",
    seq: str = "seq",
    op: str | None = None,
    delete: str = "delete",
    keep_deletes: bool = False,
) -> DataFrame:
    """Base rows under a log of operations: the newest operation per key wins, deletes shadow rows.

    Operations may come in any order, and older ones than the base row lose to it. The log is evaluated once: its
    newest rows are written to the shared folder, where the joins read them. ``keep_deletes`` keeps deleted keys as rows marked in ``op``, so that a late, older write cannot bring them back.
    """
    latest = _stored(newest(log, key, seq))
    stamps = travelling(latest.select(F.col(key).alias("_key"), F.col(seq).alias("_seq")))
    same_key = F.col(key) == F.col("_key")
    # One full scan of the base for the rows that stay, one of its keys for the rows that beat the log.
    kept = base.join(stamps, same_key & (F.col("_seq") > F.col(seq)), "left_anti")
    beaten = base.select(key, seq).join(stamps, same_key & (F.col("_seq") <= F.col(seq)), "left_semi")
    winners = latest.join(beaten.select(key), key, "left_anti")
    if op is not None and not keep_deletes:
        winners = winners.where(F.col(op).isNull() | (F.col(op) != delete))
        if op not in base.columns:
            winners = winners.drop(op)
    return kept.unionByName(winners, allowMissingColumns=True)


def _stored(df: DataFrame) -> DataFrame:
    path = shared_dir(df.sparkSession, "newest")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def snapshot_at(base: DataFrame, log: DataFrame, high_water: int, *, key: str = "key", seq: str = "seq", **options) -> DataFrame:
    """The table as of sequence ``high_water``; later writes are left out."""
    upto = F.col(seq) <= F.lit(high_water)
    return merge_on_read(base.where(upto), log.where(upto), key=key, seq=seq, **options)


def log_net_count(log: DataFrame, *, key: str = "key", seq: str = "seq", op: str = "op", delete: str = "delete") -> DataFrame:
    """How many rows the log holds once repeated writes and deletes are netted."""
    alive = newest(log.select(key, seq, op), key, seq).where(F.col(op).isNull() | (F.col(op) != delete))
    return alive.agg(F.count("*").alias("vector_count"))


def update_rows(
    base: DataFrame, changes: DataFrame, *, key: str = "key", seq: str = "seq", source_file: str = "source_file"
) -> tuple[DataFrame, DataFrame]:
    """Replace rows that exist; a row keeps the file of the one it replaces.

    Returns the new table and a report with one row per touched file, ``source_file, updated``.
    Changes to unknown keys are reported under a null file and alter nothing.
    """
    changes = newest(changes, key, seq)
    if source_file in changes.columns:
        changes = changes.drop(source_file)
    keys = travelling(changes.select(key))
    homes = base.select(key, source_file).join(keys, key, "left_semi")
    matched = changes.join(homes, key)
    kept = base.join(keys, key, "left_anti")
    table = kept.unionByName(matched.select(*base.columns))
    touched = changes.select(key).join(homes, key, "left")
    report = touched.groupBy(source_file).agg(F.count("*").alias("updated"))
    return table, report


def delete_ids(
    base: DataFrame, ids: DataFrame, *, key: str = "key", source_file: str = "source_file"
) -> tuple[DataFrame, DataFrame]:
    """Drop rows by key. The report has one row per touched file, ``source_file, deleted``."""
    keys = travelling(ids.select(key).distinct())
    report = base.select(key, source_file).join(keys, key, "left_semi").groupBy(source_file)
    return base.join(keys, key, "left_anti"), report.agg(F.count("*").alias("deleted"))


def _require_file(base: DataFrame, name: str, source_file: str) -> None:
    check_filename(name)
    if base.where(F.col(source_file) == name).limit(1).isEmpty():
        raise FileNotFoundError(f"no rows of file {name!r}")


def delete_file(base: DataFrame, name: str, *, source_file: str = "source_file") -> DataFrame:
    """Drop all rows of one file, which must exist."""
    _require_file(base, name, source_file)
    return base.where(~F.col(source_file).eqNullSafe(F.lit(name)))


def replace_file(
    base: DataFrame, name: str, rows: DataFrame, *, source_file: str = "source_file", key: str = "key", seq: str = "seq"
) -> DataFrame:
    """Exchange all rows of one existing file. Replacing always rewrites, even with equal content.

    A key that other files hold too stays once: the higher ``seq`` wins.
    """
    kept = delete_file(base, name, source_file=source_file)
    return upsert(kept, rows.withColumn(source_file, F.lit(name)), key=key, seq=seq)


def file_actions(loaded: DataFrame, incoming: DataFrame) -> DataFrame:
    """What to do with each incoming file, by ``name`` and ``size``.

    ``skip`` when a file of that name and size is loaded, ``conflict`` when only the size differs,
    else ``load``.
    """
    known = loaded.groupBy("name").agg(F.collect_set("size").alias("sizes"))
    joined = incoming.join(known, "name", "left")
    action = (
        F.when(F.col("sizes").isNull(), "load").when(F.array_contains("sizes", F.col("size")), "skip").otherwise("conflict")
    )
    return joined.select("name", "size", action.alias("action"))


def append_new_files(
    base: DataFrame, rows: DataFrame, actions: DataFrame, *, source_file: str = "source_file", key: str = "key",
    seq: str = "seq",
) -> DataFrame:
    """Add the rows of files marked ``load``; skipped and conflicting files add nothing.

    A key that the table or several of the files hold stays once: the higher ``seq`` wins.
    """
    names = actions.where("action = 'load'").select(F.col("name").alias(source_file))
    return upsert(base, rows.join(travelling(names), source_file, "left_semi"), key=key, seq=seq)


def list_files(
    table: DataFrame, *, source_file: str = "source_file", log: DataFrame | None = None, key: str = "key",
    seq: str = "seq", op: str = "op",
) -> DataFrame:
    """Rows per file, plus one entry for the log with its net count."""
    files = table.groupBy(F.col(source_file).alias("name")).agg(F.count("*").alias("vector_count"))
    files = files.withColumn("is_wal", F.lit(False))
    if log is None:
        return files
    entry = log_net_count(log, key=key, seq=seq, op=op)
    return files.unionByName(entry.select(F.lit(LOG_NAME).alias("name"), "vector_count", F.lit(True).alias("is_wal")))


def fetch(table: DataFrame, keys: DataFrame, *, key: str = "key") -> DataFrame:
    """Every asked key with ``found`` and the row's columns; a missing key gives nulls, not an error.

    A key asked for twice is answered twice.
    """
    asked = keys.select(key)
    rows = table.join(travelling(asked.distinct()), key, "left_semi").withColumn("found", F.lit(True))
    return asked.join(rows, key, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def collection_stats(collections: dict[str, DataFrame], *, vector: str = "vector") -> DataFrame:
    """One row per collection: count, dimension (null when empty) and bytes of the raw vectors."""
    parts = []
    for name, df in collections.items():
        size = F.when(F.col(vector).isNotNull(), F.size(vector))
        parts.append(
            df.agg(
                F.count("*").alias("vector_count"),
                F.max(size).alias("dimension"),
                (F.coalesce(F.sum(size.cast("long")), F.lit(0)) * 4).alias("vector_bytes"),
            ).withColumn("name", F.lit(name))
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.select("name", "vector_count", "dimension", "vector_bytes")


class VersionedTable:
    """A table whose every write is a new folder, named by a small file in a list of versions.

    Spark cannot overwrite what it is reading; here a job reads version n and writes n + 1. A version counts once its file is in
    the list, so a failed write leaves the old one in force, and of two writers of one version the second fails. The list is read without a job.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in storage.names(self.spark, f"{self.path}/_versions") if n.endswith(".json") and not n.startswith("."))

    def current(self) -> dict | None:
        latest = self._latest()
        return {name: latest[name] for name in ("version", "high_water")} if latest else None

    def _latest(self) -> dict | None:
        known = self.versions()
        return json.loads(storage.read_text(self.spark, self._entry(known[-1]))) if known else None

    def _entry(self, version: int) -> str:
        return f"{self.path}/_versions/{version:010d}.json"

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self) -> DataFrame:
        latest = self._latest()
        if latest is None:
            raise FileNotFoundError(f"no version of the table at {self.path}")
        return self._open(latest)

    def write(self, df: DataFrame, high_water: int | None = None) -> int:
        latest = self._latest()
        entry = {"version": latest["version"] + 1 if latest else 1, "high_water": high_water, "folder": f"v-{uuid.uuid4().hex}"}
        entry |= self._save(df, f"{self.path}/{entry['folder']}")
        storage.write_text(self.spark, self._entry(entry["version"]), json.dumps(entry))
        return entry["version"]

    def drop_old(self, keep: int = 1) -> list[int]:
        """Remove all but the last ``keep`` versions, and return their numbers. Their readers must have ended."""
        old = self.versions()[: -max(1, keep)]
        for version in old:
            folder = json.loads(storage.read_text(self.spark, self._entry(version)))["folder"]
            storage.remove(self.spark, self._entry(version))
            storage.remove(self.spark, f"{self.path}/{folder}")
        return old

    def _open(self, entry: dict) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{entry['folder']}")

    def _save(self, df: DataFrame, folder: str) -> dict:
        df.write.parquet(folder)
        return {}
