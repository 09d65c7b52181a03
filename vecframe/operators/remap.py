"""New names for columns of a stored table, by writing only the files again that have the old ones."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecframe.sources import storage

#: Begun but not ended: names the files to move in and those to remove. Spark does not read names that begin so.
MARKER = "_remap.json"


def remap_files(spark: SparkSession, path: str, *, current: tuple[str, str], id_field: str | None = None, vector_field: str | None = None, reprocess: bool = False) -> dict:
    """Rename the key and vector columns of the Parquet files of a folder in place.

    ``current`` holds the confirmed (id, vector) names. Only files with values under an old name are written again, which must be asked for by
    ``reprocess``; the report counts them. All others keep name and time. A file that has both the old and the new name in use is refused.

    New files are written aside first. The exchange is listed in a marker before it begins, and an exchange that was cut off is ended by the next call, so no row is
    lost or doubled for good; readers between see both for the moments of the exchange.
    """
    if id_field is None and vector_field is None:
        raise ValueError("provide at least one of id_field or vector_field")
    path = path.rstrip("/")
    finish(spark, path)
    renames = {old: new for old, new in zip(current, (id_field, vector_field), strict=True) if new is not None and new != old}
    if not renames:
        return {"success": True, "files_rewritten": 0, "warning": "no-op: the names are the current ones"}
    table = spark.read.option("mergeSchema", "true").parquet(path)
    old = [c for c in renames if c in table.columns]
    if not old:
        return {"success": True, "files_rewritten": 0, "warning": f"no file has a column {sorted(renames)}"}
    affected = [r.file for r in _files_with(table, old).collect()]  # names of files, which the driver lists anyhow
    if not affected:
        return {"success": True, "files_rewritten": 0, "warning": f"no file has values of {old}"}
    if not reprocess:
        return {"success": False, "error": f"{len(affected)} source files at {path} must be rewritten; pass reprocess=True"}
    rows = spark.read.option("mergeSchema", "true").parquet(*affected)
    for name in old:
        if renames[name] in rows.columns and not rows.where(F.col(name).isNotNull() & F.col(renames[name]).isNotNull()).isEmpty():
            raise ValueError(f"files have both {name!r} and {renames[name]!r} in use")
        both = F.coalesce(F.col(name), F.col(renames[name])) if renames[name] in rows.columns else F.col(name)
        place = [both.alias(renames[name]) if c == name else F.col(c) for c in rows.columns if c != renames[name]]
        rows = rows.select(*place)
    mark = uuid.uuid4().hex
    aside = f"{path}/_remap-{mark}"
    rows.write.parquet(aside)
    new = [n for n in storage.names(spark, aside) if n.endswith(".parquet")]
    storage.write_text(spark, f"{path}/{MARKER}", json.dumps({"aside": aside, "new": new, "mark": mark, "old": affected}))
    finish(spark, path)
    return {"success": True, "files_rewritten": len(affected)}


def finish(spark: SparkSession, path: str) -> None:
    """End an exchange of files that was cut off; nothing to do if there is none."""
    marker = f"{path}/{MARKER}"
    if not storage.exists(spark, marker):
        return
    entry = json.loads(storage.read_text(spark, marker))
    for name in entry["new"]:
        storage.move(spark, f"{entry['aside']}/{name}", f"{path}/{entry['mark']}-{name}")
    for file in entry["old"]:
        storage.remove(spark, file)
    storage.remove(spark, entry["aside"])
    storage.remove(spark, marker)


def _files_with(table: DataFrame, names: list[str]) -> DataFrame:
    """Files that hold a value of any of the columns; only these columns are read."""
    counts = table.groupBy(F.col("_metadata.file_path").alias("file")).agg(*[F.count(n).alias(f"n{i}") for i, n in enumerate(names)])
    return counts.where(" or ".join(f"n{i} > 0" for i in range(len(names)))).select("file")
