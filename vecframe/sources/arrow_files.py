"""Arrow IPC and Feather files, one record batch at a time on the executors."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from vecframe.session import task_slots
from vecframe.sources.matrices import open_file


def _batch_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            with open_file(path) as source:
                count = pa.ipc.open_file(source).num_record_batches
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * count), pa.array(range(count), type=pa.int32())], names=["path", "batch"]
            )


def read_arrow(spark: SparkSession, paths: list[str], schema: T.StructType | None = None) -> DataFrame:
    """All record batches of the files. Footers are read in tasks, as are the batches themselves.

    Without a ``schema`` the first file's is taken; every file must have it.
    """
    files = spark.read.format("binaryFile").load(paths).select("path")
    if schema is None:
        first = files.orderBy("path").limit(1)
        found = first.mapInArrow(_schema_json, "schema string").collect()
        if not found:
            raise FileNotFoundError(f"no files at {paths}")
        schema = T.StructType.fromJson(json.loads(found[0].schema))
    expected = to_arrow_schema(schema)

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, number in zip(batch.column("path").to_pylist(), batch.column("batch").to_pylist()):
                with open_file(path) as source:
                    rows = pa.ipc.open_file(source).get_batch(number)
                columns = [rows.column(f.name).cast(f.type) for f in expected]
                yield pa.RecordBatch.from_arrays(columns, schema=expected)

    tasks = 3 * task_slots(spark)
    numbers = files.repartition(tasks, "path").mapInArrow(_batch_numbers, "path string, batch int")
    return numbers.repartition(tasks, "path", "batch").mapInArrow(load, schema)


def _schema_json(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            with open_file(path) as source:
                found = pa.ipc.open_file(source).schema
            plain = pa.schema([pa.field(f.name, _list_type(f.type)) for f in found])
            yield pa.RecordBatch.from_arrays([pa.array([from_arrow_schema(plain).json()])], names=["schema"])


def _list_type(kind: pa.DataType) -> pa.DataType:
    if pa.types.is_fixed_size_list(kind) or pa.types.is_large_list(kind):
        return pa.list_(kind.value_type)
    return kind
