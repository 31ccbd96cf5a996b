"""Shared pieces of the training-data operators: shared folder, word rules."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words: [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
#: A word, for the JVM's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only where that setting is missing and Spark runs in local mode (tests), a
    folder of this machine takes its place; on a cluster a missing setting is
    an error.
    """
    key = "spark.checkpoint.dir"
    found = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set(key, found)
    return found.rstrip("/")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """df, written once to the shared folder and read back.

    This cuts the lineage: a lost executor costs neither the work before it
    nor, where rows carry partition numbers, their meaning.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(name: str = "text") -> Column:
    """The column's text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: str) -> list[str]:
    """The words of a text, in order; equal to the matches of WORD."""
    for c in SPACES[1:]:
        if c in text:
            text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def lower_ascii(text: str) -> str:
    """text with A-Z in lower case and every other character as it is."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


_LOWER = {c: c + 32 for c in range(65, 91)}


def by_bytes(batch: pa.RecordBatch, column: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with about `limit` bytes of the column each, a row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def split_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words of the texts, all words in order as places in that list, and words per text."""
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    if "" in words:
        there = codes != words.index("")
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[there], minlength=len(sizes))
        codes = codes[there]
    return words, codes.astype(np.int64), sizes


GOLD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mix(x: np.ndarray) -> np.ndarray:
    """A scramble of 64-bit numbers that loses nothing."""
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Polynomial hashes, modulo 2^64, of stretches of a sequence, from one running sum."""

    BASE = 0xD1342543DE82EF95  # odd: it has an inverse

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Powers of the base and of its inverse, n of each at least."""
        if len(self.up) < n:
            n = max(n, 1 << 16)
            self.up, self.down = (np.cumprod(np.append(np.uint64(1), np.full(n - 1, b, np.uint64))) for b in (self.BASE, pow(self.BASE, -1, 1 << 64)))
        return self.up, self.down

    def stretches(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of each values[start:end]."""
        up, down = self.powers(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts])


rolling = Rolling()
#: A random number for each byte, A-Z like a-z.
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * GOLD)
_BYTES[65:91] = _BYTES[97:123]
#: Whether a byte separates words.
SPACE = np.isin(np.arange(256), [ord(c) for c in SPACES])


def word_places(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes, starts and ends of all words in them, and words per text."""
    none = np.zeros(0, np.int64)
    if not len(texts):
        return np.zeros(0, np.uint8), none, none, none
    wide = texts.cast(pa.large_binary())
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    low, high = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(wide.buffers()[2], np.uint8)[low:high] if high > low else np.zeros(0, np.uint8)
    offsets = offsets - low
    part = ~SPACE[data]
    begins, stops = part.copy(), part.copy()
    begins[1:] &= ~part[:-1]
    stops[:-1] &= ~part[1:]
    full = offsets[1:] > offsets[:-1]  # a word begins and ends with its text
    begins[offsets[:-1][full]] |= part[offsets[:-1][full]]
    stops[offsets[1:][full] - 1] |= part[offsets[1:][full] - 1]
    starts = np.flatnonzero(begins)
    return data, starts, np.flatnonzero(stops) + 1, np.diff(np.searchsorted(starts, offsets))


def word_hashes(texts: pa.Array, chunk: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts, with A-Z in lower case, one after another, and words per text."""
    data, starts, ends, sizes = word_places(texts)
    out, at = np.zeros(len(starts), np.uint64), 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + chunk, "right")))
        some = _BYTES[data[starts[at] : ends[stop - 1]]]
        out[at:stop] = rolling.stretches(some, starts[at:stop] - starts[at], ends[at:stop] - starts[at])
        at = stop
    return out, sizes


def remembered(words: list[str], known: dict, reading: Callable[[str], object], most: int = 120_000) -> list:
    """reading(word) of each word; known keeps those of the first `most` words a worker meets."""
    out = [known.get(w) for w in words]
    room = len(known) < most
    for i, x in enumerate(out):
        if x is None:
            out[i] = x = reading(words[i])
            if room:
                known[words[i]] = x
    return out
