"""Vectors of whole numbers: scaling, packing into binary columns, exact squared distances."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Scaled components lie below this, so that squared distances of up to 256 components fit a long.
LIMIT = 1 << 27
#: Rows of one packed piece.
CHUNK = 256

FINITE = "size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"


def whole_numbers(rows: DataFrame, *, key: str, vector: str, scale: int, carry: dict[str, Column] | None = None) -> DataFrame:
    """Rows (id, *carry, q) with q = floor(scale x component); vectors that are null, empty or hold null or non-finite components go.

    A scaled component of 2^27 or more fails the job, since exact distances would leave the range of a long.
    """
    read = rows.select(F.col(key).alias("id"), *[c.alias(n) for n, c in (carry or {}).items()], F.col(vector).cast("array<double>").alias("v"))
    far = F.raise_error(F.lit("a vector component is too large for exact whole-number distances")).cast("int")
    whole = F.transform("v", lambda x: F.when(F.abs(x * scale) < LIMIT, F.floor(x * scale).cast("int")).otherwise(far))
    return read.where(FINITE).select("id", *(carry or {}), whole.alias("q"))


def packed(x: np.ndarray) -> bytes:
    """The numbers in the narrowest width that holds them all; ``unpacked`` tells it from the length."""
    most = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    return x.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(t).max)).tobytes()


def unpacked(data: bytes, *shape: int) -> np.ndarray:
    width = len(data) // math.prod(shape)
    return np.frombuffer(data, dtype=f"<i{width}").reshape(shape).astype(np.int64)


def matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), dim)


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances, (rows x centres): by a matrix product where doubles hold every term, else by differences."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * most * most * x.shape[1] < 1 << 53:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    out = np.zeros((len(x), len(c)), np.int64)
    for i in range(x.shape[1]):
        out += (x[:, i, None] - c[None, :, i]) ** 2
    return out
