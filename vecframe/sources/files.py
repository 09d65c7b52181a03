"""Reading vector tables from files, by format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecframe.operators.tables import check_filename
from vecframe.sources import arrow_files, matrices

# File extensions and the format each one stands for.
FORMATS = {
    "parquet": "parquet",
    "csv": "csv",
    "jsonl": "json",
    "json": "json",
    "arrow": "arrow",
    "feather": "arrow",
    "ipc": "arrow",
    "bvecs": "bvecs",
    "fvecs": "fvecs",
    "ivecs": "ivecs",
    "fbin": "fbin",
    "u8bin": "u8bin",
    "i8bin": "i8bin",
    "npy": "npy",
}
# Single-file codecs that are not split over tasks.
CONVERT_FIRST = {"npz", "h5", "hdf5", "hdf", "safetensors"}


def format_of(name: str) -> str:
    extension = name.rsplit(".", 1)[-1].lower() if "." in name else ""
    if extension in CONVERT_FIRST:
        raise ValueError(f"convert .{extension} files to parquet first")
    if extension not in FORMATS:
        raise ValueError(f"unsupported file extension .{extension}; supported: {', '.join(sorted(FORMATS))}")
    return FORMATS[extension]


def file_listing(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path, name, size, modified`` of the files; their content is not read.

    ``modified`` is ISO 8601 text.
    """
    files = spark.read.format("binaryFile").load(paths)
    return files.select(
        "path",
        F.url_decode(F.element_at(F.split("path", "/"), -1)).alias("name"),
        F.col("length").alias("size"),
        F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").alias("modified"),
    )


def refuse_empty(spark: SparkSession, paths: str | list[str]) -> None:
    """Fail if a file has no bytes. Spark's own listing leaves such files out, so the file system is asked."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for path in [paths] if isinstance(paths, str) else paths:
        pattern = hadoop.Path(path)
        system = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in system.globStatus(pattern) or []:
            for status in system.listStatus(found.getPath()):
                name = status.getPath().getName()
                if status.isFile() and status.getLen() == 0 and name[0] not in "_.":
                    raise ValueError(f"file {name!r} is empty")


def check_files(listing: DataFrame) -> DataFrame:
    """The listing, refused when a file is badly named or nothing is in any file.

    Spark lists no empty files; ``refuse_empty`` finds those among others.
    """
    bad = listing.where("not name rlike '^[a-zA-Z0-9._-]+$'").limit(1).collect()
    if bad:
        check_filename(bad[0]["name"])
    if listing.limit(1).isEmpty():
        raise ValueError("the files are empty")
    return listing


def read_vectors(
    spark: SparkSession,
    paths: str | list[str],
    *,
    format: str | None = None,
    schema: T.StructType | str | None = None,
    vector_field: str = "vector",
) -> DataFrame:
    """Files of one format as a table.

    CSV and JSON need a ``schema``, so that no pass is spent on guessing it. A CSV vector is a JSON
    array in text. Binary vector files give ``id`` (the row number over all files, by name),
    ``vector`` and ``source_file``.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    format = FORMATS[format] if format else format_of(paths[0].rstrip("/"))
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    refuse_empty(spark, paths)
    if format == "parquet":
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(*paths)
    if format in ("csv", "json"):
        if schema is None:
            raise ValueError(f"reading {format} needs a schema")
        if format == "json":
            return spark.read.schema(schema).json(paths)
        as_text = T.StructType(
            [T.StructField(f.name, T.StringType() if f.name == vector_field else f.dataType) for f in schema]
        )
        rows = spark.read.schema(as_text).option("header", True).option("escape", '"').csv(paths)
        parsed = F.from_json(F.col(vector_field), T.ArrayType(T.FloatType()), {"mode": "FAILFAST"})
        return rows.withColumn(vector_field, parsed)
    if format == "arrow":
        return arrow_files.read_arrow(spark, paths, schema)
    return matrices.read_matrices(spark, paths, format)


def to_rows(spark: SparkSession, *, path=None, vectors=None, dataframe=None, table=None, **options) -> DataFrame:
    """One of four ways to hand in rows: a path, a list of dicts, a pandas frame or an Arrow table."""
    given = [x for x in (path, vectors, dataframe, table) if x is not None]
    if len(given) != 1:
        raise ValueError("provide exactly one of path, vectors, dataframe or table")
    if path is not None:
        return read_vectors(spark, path, **options)
    if vectors is not None:
        if not vectors:
            raise ValueError("vectors must not be empty")
        for i, row in enumerate(vectors):
            for field in ("id", "vector"):
                if field not in row:
                    raise ValueError(f"vector {i} is missing {field!r}")
        schema = "key string, vector array<float>, metadata map<string,string>"
        rows = [
            (
                str(r["id"]),
                [float(x) for x in r["vector"]],
                {k: None if v is None else str(v) for k, v in (r.get("metadata") or {}).items()},
            )
            for r in vectors
        ]
        return spark.createDataFrame(rows, schema)
    rows = spark.createDataFrame(dataframe if dataframe is not None else table)
    if not rows.columns or rows.limit(1).isEmpty():
        raise ValueError("the rows given are empty")
    return rows
