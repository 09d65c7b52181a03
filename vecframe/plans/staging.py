"""Test data in the binary formats, written by tasks: one file per partition."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecframe.session import pieces
from vecframe.sources.matrices import HEADED, ROW_PREFIXED


def stage_files(df: DataFrame, folder: str, format: str, *, order: str, vector: str) -> None:
    """Write ``df``, ordered by ``order``, as ``part-<n>.<format>`` files.

    Arrow files hold all columns, the others the vectors alone. A task holds its piece, about 64 MiB,
    since some formats start with the number of rows. A file is written aside and then
    moved, so a task that runs twice leaves one whole file.
    """

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if batches:
            system, inner = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
            system.create_dir(inner, recursive=True)
            context = TaskContext.get()
            name = f"part-{context.partitionId():05d}"
            aside = f"{inner}/.{name}-{context.taskAttemptId()}"
            with system.open_output_stream(aside) as out:
                _write(out, batches, format, vector)
            system.move(aside, f"{inner}/{name}.{format}")
        yield pa.RecordBatch.from_arrays([pa.array([sum(b.num_rows for b in batches)])], names=["rows"])

    ordered = df.repartitionByRange(pieces(df, least=4), order).sortWithinPartitions(order)
    ordered.mapInArrow(save, "rows long").agg(F.sum("rows")).collect()


def _write(out, batches: list[pa.RecordBatch], format: str, vector: str) -> None:
    if format == "arrow":
        with pa.ipc.new_file(out, batches[0].schema) as writer:
            for batch in batches:
                writer.write_batch(batch)
        return
    rows = np.concatenate([np.stack(b.column(vector).to_numpy(zero_copy_only=False)) for b in batches])
    dim = np.full((len(rows), 1), rows.shape[1], dtype="<i4")
    if format == "npy":
        np.save(out, rows)
    elif format in HEADED:
        out.write(np.array(rows.shape, dtype="<i4").tobytes() + rows.astype(HEADED[format]).tobytes())
    else:
        body = np.ascontiguousarray(rows.astype(ROW_PREFIXED[format])).view("u1").reshape(len(rows), -1)
        out.write(np.hstack([dim.view("u1").reshape(len(rows), 4), body]).tobytes())
