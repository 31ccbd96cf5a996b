"""Quality classifier: hashed word n-grams, logistic regression, FTRL-proximal.

Features are hashed n-grams of two readings of the words: the word itself (ASCII
case and marks dropped; n = 1, 2) and its form (letter case, marks around it,
length class, whether it repeats the word before; n = 1, 2, 3). A feature's value
is its share of the text's n-grams of that kind, so a score is a sparse dot
product of bounded size for a text of any length. Nothing but the text is read.

Training runs in one task over the sparse rows, hashed where the texts lie, of at most
`limit` labelled rows, chosen by a hash of doc_id (all of them where there are fewer); the weights, 2^18 numbers, are
broadcast. Scoring is a map over all rows.

Defined cases: null or empty text has no features and scores the bias alone; a
null doc_id is not held out; without labelled rows every score is 0.5; several
labels of one row all count; repeated rows are scored alike; other columns are
ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.base import by_bytes, text_of, words_of

BITS, LIMIT, EPOCHS, THRESHOLD, HELD_OUT_MOD = 18, 8000, 4, 0.3, 5
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.0005, 0.001
#: Weight of each kind of n-gram: word 1, word 2, form 1, form 2, form 3.
KINDS = ((0, 1), (0, 2), (1, 1), (1, 2), (1, 3))
REMEMBERED, SLICE = 100_000, 1 << 20

_known: dict[str, tuple[int, int]] = {}
_MARKS = re.compile(r"\W*")


def _reading(word: str) -> tuple[int, int]:
    """32-bit hashes of the word and of its form."""
    head = _MARKS.match(word)[0]
    tail = _MARKS.match(word[::-1])[0][::-1] if len(head) < len(word) else ""  # one pass each, whatever the word
    core = word[len(head) : len(word) - len(tail)]
    case = "U" if core.isupper() and len(core) > 1 else "T" if core[:1].isupper() else "l" if core.islower() else "d" if core.isdigit() else "x"
    form = f"{head[:3]} {case}{min(len(core), 30) // 10} {tail[:3]}"
    return zlib.crc32(core.lower().encode()), zlib.crc32(form.encode(), 1)


def grams(texts: list[str], bits: int = BITS) -> list[list[np.ndarray]]:
    """For each kind of n-gram, each text's n-grams as feature numbers."""
    out: list[list[np.ndarray]] = [[] for _ in KINDS]
    mask, seen = np.uint64((1 << bits) - 1), _known
    for text in texts:
        words = words_of(text)
        for w in words:
            if w not in seen:
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen[w] = _reading(w)
        try:
            pairs = np.array([seen[w] for w in words], np.uint64).reshape(-1, 2)
        except KeyError:  # the words known so far were dropped half-way
            pairs = np.array([_reading(w) for w in words], np.uint64).reshape(-1, 2)
        same = np.zeros(len(pairs), np.uint64)
        same[1:] = pairs[1:, 0] == pairs[:-1, 0]
        readings = pairs[:, 0], pairs[:, 1] * np.uint64(2) + same
        for k, (which, n) in enumerate(KINDS):
            r = readings[which]
            h = np.full(max(0, len(r) - n + 1), k + 1, np.uint64)
            for i in range(n):
                h = (h ^ r[i : len(r) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            out[k].append((h >> np.uint64(20) & mask).astype(np.int64))
    return out


def features(text: str, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of one text."""
    ids, values = [], []
    for kind in grams([text], bits):
        found, n = np.unique(kind[0], return_counts=True)
        ids.append(found)
        values.append(n / max(1, n.sum()))
    ids, back = np.unique(np.concatenate(ids), return_inverse=True)
    return ids, np.bincount(back, np.concatenate(values), len(ids))


def with_bias(text: str, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """The text's features for training, the bias last."""
    i, v = features(text, bits)
    return np.append(i, 1 << bits).astype(np.int32), np.append(v, 1.0).astype(np.float32)


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last is the bias) by FTRL-proximal updates, one row (see with_bias) at a time, in the rows' order."""
    z, n = (np.zeros((1 << bits) + 1) for _ in range(2))
    for _ in range(epochs):
        for (i, v), y in zip(rows, labels):
            zi, ni = z[i], n[i]
            l1 = np.where(i == 1 << bits, 0, L1)
            wi = np.where(np.abs(zi) <= l1, 0, -(zi - np.sign(zi) * l1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
            g = (1 / (1 + np.exp(-np.clip(wi @ v, -35, 35))) - y) * v
            s = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[i], n[i] = zi + g - s * wi, ni + g * g
    l1 = np.full(len(z), L1)
    l1[-1] = 0
    w = np.where(np.abs(z) <= l1, 0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    return w.astype(np.float32)


def score(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Each text's probability of label 1."""
    bits = (len(weights) - 1).bit_length() - 1
    total = np.full(len(texts), float(weights[-1]))
    for kind in grams(texts, bits):
        sizes = np.array([len(x) for x in kind], np.int64)
        if sizes.sum():
            starts = np.cumsum(sizes) - sizes
            sums = np.add.reduceat(np.append(weights[np.concatenate(kind)].astype(np.float64), 0), starts)
            total += np.where(sizes > 0, sums, 0) / np.maximum(sizes, 1)
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("long").cast("string")), F.lit(HELD_OUT_MOD)) == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, limit: int = LIMIT) -> np.ndarray:
    """Weights from the labelled rows that aren't held out, at most `limit` of them by hash of doc_id."""
    usable = labels.select(F.col("doc_id").cast("long").alias("__id"), F.col("quality").cast("int").alias("__y")).filter("__id is not null and __y in (0, 1)")
    chosen = usable.filter(~held_out(F.col("__id"))).orderBy(F.xxhash64("__id"), "__id", "__y").limit(limit)  # bounds the broadcast
    rows = docs.select(F.col("doc_id").cast("long").alias("__id"), text_of().alias("__text")).join(F.broadcast(chosen), "__id")
    ordered = rows.select(F.xxhash64("__id", F.lit(1)).alias("__order"), "__y", "__text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in by_bytes(b, 2, SLICE):
                found = [with_bias(t) for t in some.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), *(pa.array([f[i].tobytes() for f in found], pa.binary()) for i in (0, 1))], ["__order", "__y", "__ids", "__values"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted(r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(4))))
        w = train([(np.frombuffer(r[2], np.int32), np.frombuffer(r[3], np.float32)) for r in got], [r[1] for r in got])
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary())], ["weights"])

    sparse = ordered.mapInArrow(hashed, "__order long, __y int, __ids binary, __values binary").repartition(1)
    found = sparse.mapInArrow(run, "weights binary").collect()
    return np.frombuffer(found[0][0], np.float32) if found else train([], [])


def scored(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """row (a struct of the columns of docs, whatever their names), score (double) and predicted (int)."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    rows = docs.select(F.struct("*").alias("row"))
    at = [c.lower() for c in docs.columns].index("text")  # read where it lies: a text goes to the worker once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = pa.RecordBatch.from_arrays([b.column(0), b.column(0).field(at)], ["row", "text"])
            for some in by_bytes(both, 1, SLICE):
                s = score([t or "" for t in some.column(1).to_pylist()], sent.value)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["row", "score", "predicted"])

    kind = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return rows.mapInArrow(run, kind)


def classify(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """docs with __score and __predicted; where docs has such a name (in any case), the new column's name gets more underscores."""
    taken, names = {c.lower() for c in docs.columns}, []
    for name in ("__score", "__predicted"):
        while name in taken:
            name += "_"
        names.append(name)
    return scored(docs, weights, threshold).select("row.*", F.col("score").alias(names[0]), F.col("predicted").alias(names[1]))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    weights = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return scored(slim, weights).select("row.doc_id", "row.held_out", "score", "predicted")
