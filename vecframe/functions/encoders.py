"""Encoders: objects that turn a text column into a vector column.

``HashEncoder`` needs no model. ``PooledEncoder`` hosts any token model: it is loaded once per
Python worker, and its output is mean-pooled over the real tokens and scaled to unit length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecframe.functions.text import basic_tokens, wordpiece_ids
from vecframe.operators.metrics import NORM_FLOOR
from vecframe.session import spread

FLOATS = T.ArrayType(T.FloatType())
DIMENSION = 384


class Encoder(Protocol):
    dimension: int

    def column(self, text: Column) -> Column: ...


def embed(df: DataFrame, text: str, encoder: Encoder, output: str = "vector") -> DataFrame:
    return spread(df).withColumn(output, encoder.column(F.col(text)))


class HashEncoder:
    """Signed feature hashing of the tokens, at unit length.

    The first four bytes of a token's md5 pick the element, the top bit of the fifth its sign. Each
    distinct token of a batch is hashed once; the rest is integer counting over the whole batch.
    """

    def __init__(self, dimension: int = DIMENSION):
        self.dimension = dimension

    def column(self, text: Column) -> Column:
        dimension = self.dimension

        @F.arrow_udf(FLOATS)
        def count(tokens: pa.Array) -> pa.Array:
            coded = tokens.flatten().dictionary_encode()
            digests = [hashlib.md5(token.encode()).digest() for token in coded.dictionary.to_pylist()]
            slots = np.array([int.from_bytes(d[:4], "big") % dimension for d in digests], dtype=np.int64)
            signs = np.array([1.0 if d[4] < 128 else -1.0 for d in digests])
            at = coded.indices.to_numpy(zero_copy_only=False)
            sums = np.zeros((len(tokens), dimension))
            if len(at):
                row = np.repeat(np.arange(len(tokens)), np.diff(tokens.offsets.to_numpy()))
                sums = np.bincount(row * dimension + slots[at], weights=signs[at], minlength=sums.size).reshape(sums.shape)
            return _unit_lists(sums)

        return count(basic_tokens(F.coalesce(text, F.lit(""))))


class PooledEncoder:
    """WordPiece ids through ``load()(ids, mask)``, which gives (texts, tokens, dimension) states."""

    def __init__(
        self, vocabulary: list[str], load: Callable[[], Callable[[np.ndarray, np.ndarray], np.ndarray]],
        dimension: int = DIMENSION, batch: int = 64,
    ):
        self.vocabulary, self.load, self.dimension, self.batch = vocabulary, load, dimension, batch

    def column(self, text: Column) -> Column:
        load, size, dimension = self.load, self.batch, self.dimension

        @F.pandas_udf(FLOATS)
        def pool(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for batch in batches:
                vectors: list[np.ndarray] = []
                for at in range(0, len(batch), size):
                    part = [np.asarray(ids) for ids in batch.iloc[at : at + size]]
                    ids = np.zeros((len(part), max(len(p) for p in part)), dtype=np.int64)
                    mask = np.zeros(ids.shape, dtype=np.int64)
                    for i, p in enumerate(part):
                        ids[i, : len(p)], mask[i, : len(p)] = p, 1
                    states = np.asarray(model(ids, mask), dtype=np.float64)
                    if states.shape != (*ids.shape, dimension):
                        raise ValueError(f"the model gave {states.shape}, expected {(*ids.shape, dimension)}")
                    weights = mask[:, :, None]
                    means = (states * weights).sum(axis=1) / np.maximum(weights.sum(axis=1), NORM_FLOOR)
                    vectors += list(_unit(means))
                yield pd.Series(vectors)

        return pool(wordpiece_ids(text, self.vocabulary))


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows**2).sum(axis=1, keepdims=True))
    return (rows / np.maximum(length, NORM_FLOOR)).astype(np.float32)


def _unit_lists(rows: np.ndarray) -> pa.Array:
    offsets = pa.array(np.arange(0, rows.size + 1, rows.shape[1]), type=pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(_unit(rows).reshape(-1)))
