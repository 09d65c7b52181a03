"""Metadata that keeps its types: a VARIANT column, filtered by value and type, with the key mirrored into it."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def typed_rows(spark: SparkSession, vectors: list[dict]) -> DataFrame:
    """Rows (key, vector, metadata) from dicts ``id, vector, metadata``; numbers, booleans, nulls, lists and objects in metadata stay what they are.

    The key is mirrored under ``id``, unless the metadata has one. Other values become text.
    """
    if not vectors:
        raise ValueError("vectors must not be empty")
    for i, row in enumerate(vectors):
        for field in ("id", "vector"):
            if field not in row:
                raise ValueError(f"vector {i} is missing {field!r}")
    rows = [(str(r["id"]), [float(x) for x in r["vector"]], json.dumps(r.get("metadata") or {}, default=str, allow_nan=False)) for r in vectors]
    plain = spark.createDataFrame(rows, "key string, vector array<float>, metadata string")
    return mirrored(plain.withColumn("metadata", F.parse_json("metadata")))


def with_typed_metadata(df: DataFrame, columns: list[str], *, metadata: str = "metadata") -> DataFrame:
    """The named columns folded into one VARIANT object, in their types."""
    if not columns:
        raise ValueError("name at least one column")
    return df.withColumn(metadata, F.to_variant_object(F.struct(*columns))).drop(*[c for c in columns if c != metadata])


def mirrored(df: DataFrame, *, key: str = "key", metadata: str = "metadata") -> DataFrame:
    """The key under ``id`` in the metadata, as text, unless there is one; null metadata counts as empty."""
    own = F.coalesce(F.to_json(metadata), F.lit("{}"))
    lead = F.to_json(F.struct(F.col(key).cast("string").alias("id")), {"ignoreNullFields": "false"})
    joined = F.concat(F.expr("left({0}, length({0}) - 1)".format("_lead")), F.when(F.col("_own") == "{}", "}").otherwise(F.concat(F.lit(","), F.expr("substring(_own, 2)"))))
    has = F.coalesce(F.try_variant_get(F.col(metadata), "$.id", "variant").isNotNull(), F.lit(False))
    mixed = df.withColumns({"_own": own, "_lead": lead, "_has": has})
    return mixed.withColumn(metadata, F.when(F.col("_has"), F.col(metadata)).otherwise(F.parse_json(joined))).drop("_own", "_lead", "_has")


def _at(name: str) -> str:
    quoted = name.replace("\\", "\\\\").replace('"', '\\"')
    if '"' in name or "\\" in name:
        raise ValueError(f"metadata name {quoted!r} cannot be asked for")
    return f'$["{name}"]'


def value(name: str, kind: str, *, metadata: str = "metadata") -> Column:
    """A metadata value as ``kind``; null where it is missing or cannot be one."""
    return F.try_variant_get(F.col(metadata), _at(name), kind)


def where_metadata(df: DataFrame, filter: dict[str, object], *, metadata: str = "metadata") -> DataFrame:
    """Rows whose metadata equals every given scalar in value and type: 3 is not "3", true is not 1, and 3 is 3.0. None asks for a missing or null value."""
    for name, wanted in filter.items():
        if isinstance(wanted, (dict, list, tuple, set)):
            raise ValueError(f"filter on {name!r} must be one scalar value")
        found = F.try_variant_get(F.col(metadata), _at(name), "variant")
        kind = F.schema_of_variant(found)
        if wanted is None:
            same = found.isNull() | F.is_variant_null(found)
        elif isinstance(wanted, bool):
            same = (kind == "BOOLEAN") & (value(name, "boolean", metadata=metadata) == wanted)
        elif isinstance(wanted, (int, float)):
            if isinstance(wanted, float) and not math.isfinite(wanted):
                raise ValueError(f"filter on {name!r} must be a finite number")
            number = "decimal(38,18)" if isinstance(wanted, int) and abs(wanted) < 10**19 else "double"
            same = kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)") & (value(name, number, metadata=metadata) == F.lit(wanted))
        else:
            same = (kind == "STRING") & (value(name, "string", metadata=metadata) == str(wanted))
        df = df.where(same)
    return df
