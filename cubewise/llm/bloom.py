"""Bloom filters of row keys: which rows surely are in no group need not be moved.

A filter never misses a key that was put in; it only lets a few others pass, whose
rows then take the exact way, so results do not depend on it. It has some 16 bits a
key, up to ``MOST_BITS`` in all (16 MB, which the driver gathers and broadcasts);
beyond that it lets more rows pass and saves less.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_BITS = 1 << 27
BITS_PER_KEY = 16
HASHES = 4


def places(keys: np.ndarray, bits: int) -> np.ndarray:
    """HASHES x keys: each key's bit numbers."""
    out = np.empty((HASHES, len(keys)), np.uint64)
    h = keys.astype(np.int64).view(np.uint64)
    for n in range(HASHES):
        h = (h + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(31)
        out[n] = h % np.uint64(bits)
    return out


def keys_test(keys: DataFrame, most_bits: int = MOST_BITS) -> Callable[[np.ndarray], np.ndarray]:
    """A function for tasks: of an array of longs, which are among ``keys`` (one column
    of longs, none null), always true for those and seldom for others."""
    spark = keys.sparkSession
    count = keys.count()
    bits = 64
    while bits < min(count * BITS_PER_KEY, most_bits):
        bits *= 2

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(places(batch.column(0).to_numpy(zero_copy_only=False), bits))
            word, first = np.unique(at >> np.uint64(6), return_index=True)
            if len(word):
                value = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word.astype(np.int64)), pa.array(value.view(np.int64))], names=["word", "value"])

    table = (keys.mapInArrow(words, "word bigint, value bigint").groupBy("word")
             .agg(F.bit_or("value").alias("value")).toArrow())
    array = np.zeros(bits // 64, np.int64)
    array[table.column("word").to_numpy()] = table.column("value").to_numpy()
    shared = spark.sparkContext.broadcast(array.tobytes())

    def inside(values: np.ndarray) -> np.ndarray:
        filled = np.frombuffer(shared.value, np.uint64)
        out = np.ones(len(values), bool)
        for at in places(values, bits):
            out &= (filled[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out

    return inside


def keys_filter(keys: DataFrame, most_bits: int = MOST_BITS):
    """``keys_test`` as a function from a Column of type long to a boolean Column."""
    inside = keys_test(keys, most_bits)

    @F.pandas_udf("boolean")
    def among(values: pd.Series) -> pd.Series:
        return pd.Series(inside(values.to_numpy()))

    return among


def split_rows(rows: DataFrame, rank: Column, contested: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose rank is surely none of ``contested``, the others)."""
    among = keys_filter(contested)
    return rows.where(~among(rank)), rows.where(among(rank))
