"""Binary vector files: fvecs, bvecs, ivecs (a length before each row); fbin, u8bin, i8bin, npy (a header).

Rows have a fixed width, so a file is cut into byte ranges that tasks read on their own. Every
step is a Spark job over the file listing; the driver opens no file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vecframe.session import task_slots

# Element type per format; the first three repeat the dimension before each row,
# the next three start with two int32, the row count and the dimension.
ROW_PREFIXED = {"fvecs": "<f4", "bvecs": "u1", "ivecs": "<i4"}
HEADED = {"fbin": "<f4", "u8bin": "u1", "i8bin": "i1"}

RANGE_BYTES = 16 * 1024 * 1024
LAYOUT = "path string, size long, kind string, dim int, first_byte long, prefix int, width int, rows long"
CONTENT = "path string, id long, vector array<float>"


def open_file(path: str):
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:/") and not path.startswith("file://"):
            path = "file://" + path[len("file:"):]
        system, inner = fs.FileSystem.from_uri(path)
    else:
        system, inner = fs.LocalFileSystem(), path
    return system.open_input_file(inner)


def _layout_of(format: str):
    def layout(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path, size in zip(batch.column("path").to_pylist(), batch.column("size").to_pylist()):
                with open_file(path) as source:
                    found.append({"path": path, "size": size, **_header(source, format, size, path)})
            schema = pa.schema(
                [("path", pa.string()), ("size", pa.int64()), ("kind", pa.string()), ("dim", pa.int32()),
                 ("first_byte", pa.int64()), ("prefix", pa.int32()), ("width", pa.int32()), ("rows", pa.int64())]
            )
            yield pa.RecordBatch.from_pylist(found, schema=schema)

    return layout


def _header(source, format: str, size: int, path: str) -> dict:
    prefix, first_byte, rows = 0, 0, None
    if format in ROW_PREFIXED:
        kind, prefix = ROW_PREFIXED[format], 4
        dim = int(np.frombuffer(source.read(4), "<i4")[0])
    elif format in HEADED:
        kind, first_byte = HEADED[format], 8
        rows, dim = (int(x) for x in np.frombuffer(source.read(8), "<i4"))
    else:
        version = np.lib.format.read_magic(source)
        read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
        shape, by_column, dtype = read(source)
        if len(shape) != 2 or by_column or dtype.kind not in "fiu":
            raise ValueError(f"{path}: expected a two-dimensional numeric array in row order")
        (rows, dim), kind, first_byte = shape, dtype.str, source.tell()
    width = prefix + dim * np.dtype(kind).itemsize
    if dim < 1 or (size - first_byte) % width:
        raise ValueError(f"{path}: {size} bytes do not hold whole rows of dimension {dim}")
    held = (size - first_byte) // width
    if rows is not None and rows != held:
        raise ValueError(f"{path}: the header says {rows} rows, the file holds {held}")
    return {"kind": kind, "dim": dim, "first_byte": first_byte, "prefix": prefix, "width": width, "rows": held}


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in batch.to_pylist():
            with open_file(part["path"]) as source:
                source.seek(part["first_byte"] + part["start"] * part["width"])
                raw = np.frombuffer(source.read(part["count"] * part["width"]), np.uint8)
            raw = raw.reshape(part["count"], part["width"])
            if part["prefix"]:
                dims = np.ascontiguousarray(raw[:, :4]).view("<i4").ravel()
                if (dims != part["dim"]).any():
                    raise ValueError(f"{part['path']}: rows of different dimension")
            body = np.ascontiguousarray(raw[:, part["prefix"]:]).view(part["kind"]).astype(np.float32)
            offsets = np.arange(0, body.size + 1, part["dim"], dtype=np.int32)
            first = part["base"] + part["start"]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part["path"]] * part["count"]),
                    pa.array(np.arange(first, first + part["count"]), type=pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(body.reshape(-1))),
                ],
                names=["path", "id", "vector"],
            )


def read_matrices(spark: SparkSession, paths: list[str], format: str) -> DataFrame:
    """``id, vector, source_file``; ids count rows over all files in the order of their paths."""
    tasks = 3 * task_slots(spark)
    files = spark.read.format("binaryFile").load(paths).select("path", F.col("length").alias("size"))
    layout = files.repartition(tasks, "path").mapInArrow(_layout_of(format), LAYOUT)
    # One row per file: the only place where all of them pass one task.
    before = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    layout = layout.withColumn("base", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    per_range = F.greatest(F.lit(1), F.floor(F.lit(RANGE_BYTES) / F.col("width"))).cast("long")
    ranges = (
        layout.where("rows > 0")
        .withColumn("per_range", per_range)
        .withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.col("per_range"))))
        .withColumn("count", F.least(F.col("per_range"), F.col("rows") - F.col("start")))
        .drop("per_range", "size", "rows")
    )
    rows = ranges.repartition(tasks, "path", "start").mapInArrow(_decode, CONTENT)
    return rows.select("id", "vector", F.url_decode(F.element_at(F.split("path", "/"), -1)).alias("source_file"))
