"""A fixed-size filter of long numbers, to keep rows out of a shuffle.

The filter is a bitmap of `BITS` bits with two bits for each number: what is
broadcast has that size whatever the data. It only ever lets too much through;
an exact join follows. With very many numbers it lets everything through, and the
join alone does the work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 26


def places(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each number."""
    h = x.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(64 - BITS)).astype(np.int64), (h & np.uint64((1 << BITS) - 1)).astype(np.int64)


def build(numbers: DataFrame) -> Broadcast:
    """The bitmap of the only column of numbers, as packed bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << BITS - 3, np.uint8)
        for b in batches:
            for p in places(b.column(0).to_numpy(zero_copy_only=False)):
                np.bitwise_or.at(bits, p >> 3, (1 << (p & 7)).astype(np.uint8))
        words = bits.view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at])], ["__at", "__word"])

    found = numbers.mapInArrow(run, "__at long, __word long").groupBy("__at").agg(F.bit_or("__word").alias("__word"))
    words = np.zeros((1 << BITS) // 64, np.int64)
    for b in found.toArrow().to_batches():  # as many rows as the bitmap has words, at most
        words[b.column(0).to_numpy()] = b.column(1).to_numpy()
    return numbers.sparkSession.sparkContext.broadcast(words.view(np.uint8))


def test(bits: np.ndarray, x: np.ndarray) -> np.ndarray:
    a, b = places(x)
    return (bits[a >> 3] >> (a & 7) & bits[b >> 3] >> (b & 7) & 1).astype(bool)


def maybe(sent: Broadcast, column: str) -> Column:
    """Whether the numbers may be in the bitmap."""

    @F.pandas_udf("boolean")
    def run(x: pd.Series) -> pd.Series:
        return pd.Series(test(sent.value, x.to_numpy()))

    return run(F.col(column))
