"""Finding, confirming and changing the roles of columns: which is the key, which the vector."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOAT_TYPES = (T.FloatType, T.DoubleType)
INT_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
PROFILE = "state string, id_field string, vector_field string, dimension int, samples_analyzed long, pending_count long"


def profile_schema(df: DataFrame) -> DataFrame:
    """One row naming the likely key and vector columns.

    All candidates are measured in one aggregate; only the likeliest key is then checked exactly.
    A vector column is a numeric array of one length, floats before integers and long before short;
    a key column has no nulls and no repeats, columns named like an id first.
    """
    arrays = [
        f for f in df.schema
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, FLOAT_TYPES + INT_TYPES)
    ]
    plain = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType,) + INT_TYPES)]
    measures = [F.count("*").alias("rows")]
    for i, field in enumerate(arrays):
        size = F.when(F.col(field.name).isNotNull(), F.size(field.name))
        measures += [F.min(size).alias(f"low_{i}"), F.max(size).alias(f"high_{i}")]
    for i, name in enumerate(plain):
        measures += [F.count(name).alias(f"filled_{i}"), F.approx_count_distinct(name, 0.02).alias(f"distinct_{i}")]
    facts = df.agg(*measures).first()
    vectors = []
    for i, field in enumerate(arrays):
        if facts[f"high_{i}"] and facts[f"low_{i}"] == facts[f"high_{i}"]:
            whole = isinstance(field.dataType.elementType, INT_TYPES)
            vectors.append((whole, -facts[f"high_{i}"], i, field.name))
    vector = min(vectors) if vectors else None
    keys = []
    for i, name in enumerate(plain):
        if facts.rows and facts[f"filled_{i}"] == facts.rows and facts[f"distinct_{i}"] >= 0.9 * facts.rows:
            low = name.lower()
            keys.append((0 if low in ("id", "key") else 1 if low.endswith("id") else 2, i, name))
    key = next((name for _, _, name in sorted(keys) if _is_unique(df, name)), None)
    row = (
        "detected" if key and vector else "analyzing",
        key,
        vector[3] if vector else None,
        -vector[1] if vector else None,
        facts.rows,
        0,
    )
    return df.sparkSession.createDataFrame([row], PROFILE)


def _is_unique(df: DataFrame, name: str) -> bool:
    return df.groupBy(name).count().where("count > 1").limit(1).isEmpty()


def confirm_schema(df: DataFrame, *, id_field: str, vector_field: str, dimension: int | None = None) -> DataFrame:
    """``key``, ``vector`` as float array, and the other columns as metadata.

    With ``dimension`` given, a vector of another length fails the job.
    """
    if not id_field:
        raise ValueError("id_field is required")
    if not vector_field:
        raise ValueError("vector_field is required")
    for name in (id_field, vector_field):
        if name not in df.columns:
            raise ValueError(f"no column {name!r}")
    vector = F.col(vector_field).cast("array<float>")
    if dimension is not None:
        wrong = F.concat(F.lit(f"expected dimension {dimension}, found "), F.size(vector_field).cast("string"))
        vector = F.when(F.col(vector_field).isNull() | (F.size(vector_field) == dimension), vector).otherwise(
            F.raise_error(wrong).cast("array<float>")
        )
    rest = [c for c in df.columns if c not in (id_field, vector_field)]
    return df.select(F.col(id_field).alias("key"), vector.alias("vector"), *rest)


def remap_schema(
    path: str,
    target: str,
    df: DataFrame,
    *,
    current: tuple[str, str],
    id_field: str | None = None,
    vector_field: str | None = None,
    reprocess: bool = False,
) -> dict:
    """Give the key and vector columns of stored files new names, by rewriting them to ``target``.

    ``current`` holds the confirmed (id, vector) names. Rewriting must be asked for by
    ``reprocess``; a change of nothing, or one that finds no such column, succeeds with a warning.
    """
    if id_field is None and vector_field is None:
        raise ValueError("provide at least one of id_field or vector_field")
    renames = {
        old: new for old, new in zip(current, (id_field, vector_field)) if new is not None and new != old
    }
    if not renames:
        return {"success": True, "files_rewritten": 0, "warning": "no-op: the names are the current ones"}
    files = df.select(F.col("_metadata.file_path").alias("file")).distinct().count()
    if files and not reprocess:
        return {"success": False, "error": f"{files} source files at {path} must be rewritten; pass reprocess=True"}
    if not set(renames) & set(df.columns):
        return {"success": True, "files_rewritten": 0, "warning": f"no file has a column {sorted(renames)}"}
    df.withColumnsRenamed(renames).write.mode("overwrite").parquet(target)
    return {"success": True, "files_rewritten": files}


def mirror_id(df: DataFrame, *, key: str = "key", metadata: str = "metadata") -> DataFrame:
    """Put the key into the metadata map under ``id``, unless the caller already set one."""
    own = F.coalesce(F.col(metadata), F.create_map().cast("map<string,string>"))
    with_id = F.map_concat(F.create_map(F.lit("id"), F.col(key).cast("string")), own)
    return df.withColumn(metadata, F.when(F.map_contains_key(own, F.lit("id")), own).otherwise(with_id))


def promote_key(df: DataFrame, *, key: str = "key", metadata: str = "metadata") -> DataFrame:
    """The original key out of the metadata map; a map left empty becomes null."""
    has = F.coalesce(F.map_contains_key(F.col(metadata), F.lit("key_original")), F.lit(False))
    rest = F.map_filter(F.col(metadata), lambda name, _: name != "key_original")
    return df.withColumns(
        {
            key: F.when(has, F.try_element_at(F.col(metadata), F.lit("key_original"))).otherwise(F.col(key).cast("string")),
            metadata: F.when(~has, F.col(metadata)).when(F.size(rest) > 0, rest),
        }
    )
