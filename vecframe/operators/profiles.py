"""Roles of columns found file by file: what is known of a file is kept, so a table that grows is profiled by its new files alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecframe.operators.schema import FLOAT_TYPES, INT_TYPES, PROFILE
from vecframe.sources import storage

FACTS = "file_path string, file_size long, modified timestamp, rows long, column string, place int, kind string, filled long, sketch binary, low int, high int"
#: A key column has at least so many different values per row, by estimate.
DISTINCT_SHARE = 0.9


class FileProfiles:
    """Facts of each file of a table: rows, filled values and a mergeable sketch of the different ones per plain column, lengths per array column."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def known(self) -> DataFrame:
        if not storage.exists(self.spark, self.path):
            return self.spark.createDataFrame([], FACTS)
        return self.spark.read.schema(FACTS).parquet(self.path)

    def pending(self, table: DataFrame) -> DataFrame:
        """Files of the table not profiled as they are now: rows (file_path, file_size, modified). No column is read for it."""
        now = _files(table)
        return now.join(self.known().select("file_path", "file_size", "modified").distinct(), ["file_path", "file_size", "modified"], "left_anti")

    def add(self, table: DataFrame) -> int:
        """Profile the pending files, and them only; returns how many there were. ``table`` is a plain read of Parquet files."""
        paths = [r.file_path for r in self.pending(table).select("file_path").collect()]  # names of files, which the driver lists anyhow
        if paths:
            self._facts(self.spark.read.schema(table.schema).parquet(*paths)).write.mode("append").parquet(self.path)
        return len(paths)

    def _facts(self, rows: DataFrame) -> DataFrame:
        arrays, plain = _candidates(rows)
        measures = [F.count(F.lit(1)).alias("rows")]
        for i, field in enumerate(arrays):
            size = F.when(F.col(field.name).isNotNull(), F.size(field.name))
            measures += [F.min(size).alias(f"low_{i}"), F.max(size).alias(f"high_{i}")]
        for i, name in enumerate(plain):
            value = F.col(name) if isinstance(rows.schema[name].dataType, T.StringType) else F.col(name).cast("long")
            measures += [F.count(name).alias(f"filled_{i}"), F.hll_sketch_agg(value, F.lit(14)).alias(f"sketch_{i}")]
        by_file = rows.withColumns({"_f": F.col("_metadata.file_path"), "_s": F.col("_metadata.file_size"), "_m": F.col("_metadata.file_modification_time")}).groupBy("_f", "_s", "_m").agg(*measures)
        null = lambda kind: F.lit(None).cast(kind)
        facts = [
            F.struct(F.lit(f.name).alias("column"), F.lit(i).alias("place"), F.lit("whole" if isinstance(f.dataType.elementType, INT_TYPES) else "float").alias("kind"),
                     null("long").alias("filled"), null("binary").alias("sketch"), F.col(f"low_{i}").alias("low"), F.col(f"high_{i}").alias("high"))
            for i, f in enumerate(arrays)
        ] + [
            F.struct(F.lit(n).alias("column"), F.lit(i).alias("place"), F.lit("plain").alias("kind"),
                     F.col(f"filled_{i}").alias("filled"), F.col(f"sketch_{i}").alias("sketch"), null("int").alias("low"), null("int").alias("high"))
            for i, n in enumerate(plain)
        ]
        return by_file.select(F.col("_f").alias("file_path"), F.col("_s").alias("file_size"), F.col("_m").alias("modified"), "rows", F.inline(F.array(*facts)))

    def columns(self, table: DataFrame) -> DataFrame:
        """What the profiled files that are still in the table say together: rows (column, place, kind, rows, filled, estimate, low, high)."""
        current = self.known().join(_files(table), ["file_path", "file_size", "modified"], "left_semi")
        sketch = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
        return current.groupBy("column", "place", "kind").agg(F.sum("rows").alias("rows"), F.sum("filled").alias("filled"), sketch.alias("estimate"), F.min("low").alias("low"), F.max("high").alias("high"))

    def profile(self, table: DataFrame) -> DataFrame:
        """One row as of ``profile_schema``, from what is kept; ``pending_count`` is the number of files not profiled yet.

        A key is told by its estimated number of different values; ``confirm_schema`` and the first merge meet a repeat, if there is one.
        """
        found = self.columns(table).collect()  # a row per column
        arrays = sorted((r.kind == "whole", -r.high, r.place, r.column) for r in found if r.kind != "plain" and r.high and r.low == r.high)
        rank = lambda name: 0 if name in ("id", "key") else 1 if name.endswith("id") else 2
        keys = sorted((rank(r.column.lower()), r.place, r.column) for r in found if r.kind == "plain" and r.rows and r.filled == r.rows and r.estimate >= DISTINCT_SHARE * r.rows)
        state = "detected" if keys and arrays else "analyzing"
        rows = max((r.rows for r in found), default=0)
        row = (state, keys[0][2] if keys else None, arrays[0][3] if arrays else None, -arrays[0][1] if arrays else None, rows, self.pending(table).count())
        return self.spark.createDataFrame([row], PROFILE)


def _files(table: DataFrame) -> DataFrame:
    of = table.select(F.col("_metadata.file_path"), F.col("_metadata.file_size"), F.col("_metadata.file_modification_time").alias("modified"))
    return of.distinct()


def _candidates(df: DataFrame) -> tuple[list[T.StructField], list[str]]:
    arrays = [f for f in df.schema if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, FLOAT_TYPES + INT_TYPES)]
    return arrays, [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, *INT_TYPES))]
