"""Export of a table as Parquet parts with a manifest."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MANIFEST = "_manifest.json"
README = "_EXPORT_README.md"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small text file, through the file system that Spark itself uses for ``path``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def part_listing(spark: SparkSession, path: str) -> DataFrame:
    """``filename, bytes, rows`` of the Parquet parts at ``path``, counted from the files written."""
    parts = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("filename"))
    return parts.agg(F.max("_metadata.file_size").alias("bytes"), F.count("*").alias("rows"))


def export(
    df: DataFrame, path: str, *, vector: str = "vector", seq: str | None = None, dimension: int | None = None
) -> dict:
    """Write ``df`` with float vectors as Parquet, and beside it the manifest that is returned.

    ``df`` is read once, its facts are observed as it is written, and whatever is written later does
    not enter; for a table under a log pass ``snapshot_at``. ``seq`` names the column whose maximum is recorded as the snapshot's high water.
    """
    spark = df.sparkSession
    started = int(time.time() * 1000)
    size = F.when(F.col(vector).isNotNull(), F.size(vector))
    if dimension is None:
        first = df.where(F.col(vector).isNotNull()).select(F.size(vector)).first()
        dimension = first[0] if first else None
    # A vector of another length fails the write itself, so that nothing is left behind that looks whole.
    wrong = F.raise_error(F.format_string("an exported vector has %d elements, expected %d", F.size(vector), F.lit(dimension)))
    floats = F.col(vector).cast("array<float>")
    checked = F.when(size != F.lit(dimension), wrong.cast("array<float>")).otherwise(floats)
    seen = Observation()
    rows = df.withColumn(vector, checked).observe(
        seen,
        F.max(size).alias("high"),
        (F.max(seq) if seq else F.lit(None).cast("long")).alias("high_water"),
    )
    rows.write.mode("errorifexists").parquet(path)
    facts = seen.get
    parts = [row.asDict() for row in part_listing(spark, path).orderBy("filename").collect()]
    manifest = {
        "vector_count": sum(p["rows"] for p in parts),
        "total_bytes": sum(p["bytes"] for p in parts),
        "parts": parts,
        "snapshot_high_water_seq": facts["high_water"],
        "input_dim": facts["high"],
        "started_at_unix_ms": started,
        "completed_at_unix_ms": int(time.time() * 1000),
    }
    write_text(spark, f"{path}/{MANIFEST}", json.dumps(manifest, indent=2))
    summary = f"# Export\n\n{manifest['vector_count']} vectors of dimension {facts['high']} in {len(parts)} Parquet parts.\n"
    write_text(spark, f"{path}/{README}", summary)
    return manifest
