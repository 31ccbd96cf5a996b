"""Language identification by hyperdimensional profiles.

Every letter has a fixed random vector of `dims` signs. A letter 3-gram (within a word,
its edges marked) binds its letters' vectors, each rotated by its place, by
multiplication; a text bundles its n-grams by addition; a language's prototype bundles
the n-grams of all texts that are labelled with it. A text gets the language whose
prototype has the largest cosine with its bundle; that cosine, 0 at least, is the score.

Learning is one pass over all labelled rows that aren't held out: tasks count n-grams
per language, bind and bundle each n-gram once and return a vector per language, which
Spark adds up (whole numbers: no order changes them). The prototypes, at most
`most` languages, are broadcast; scoring is a map over all rows.

Defined cases: null text, or text without a letter, is `und` with score 0, as is every
text when nothing was learned; a null doc_id is not held out; of equal cosines the
first language by code points wins; repeated rows are scored alike; labels of any
spelling are languages of their own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.base import GOLD, by_bytes, mix, text_of

DIMS, HELD_OUT_MOD, HELD_OUT = 1024, 3, 1
#: More languages than this are an error: the prototypes are broadcast.
MOST = 10_000
SLICE, CELLS, DENSE = 1 << 20, 1 << 22, 1 << 22

_letters = np.zeros(0, bool)


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    global _letters
    if not len(_letters):
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def letter_vectors(points: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """A vector of signs for each code point; 0 stands for a word's edge."""
    words = np.arange(dims // 64, dtype=np.uint64)
    bits = mix(mix((points.astype(np.uint64)[:, None] + np.uint64(1)) * GOLD) + words * GOLD)
    return np.unpackbits(bits.view(np.uint8), axis=1).astype(np.int8) * np.int8(2) - np.int8(1)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct 3-grams as rows of code points, and each occurrence's text and place in that list."""
    low = [t.lower() for t in texts]
    points = np.frombuffer(("\n".join(["", *low]) + "\n").encode("utf-32-le"), np.uint32)
    letter = letter_table()[points]
    stays = letter.copy()
    stays[1:] |= letter[:-1]
    stays[0] = True
    owner = np.repeat(np.arange(len(low), dtype=np.int32), np.fromiter(map(len, low), np.int64, len(low)) + 1)
    owner = np.append(np.int32(0), owner)[stays]
    symbols = np.where(letter, points, 0)[stays]
    used, codes = _numbered(symbols)
    k = len(used)
    at = np.flatnonzero(symbols)
    flat = (codes[at - 1] * k + codes[at]) * k + codes[at + 1]
    if k**3 <= DENSE:
        there = np.flatnonzero(np.bincount(flat, minlength=1))
        lut = np.zeros(k**3, np.int64)
        lut[there] = np.arange(len(there))
        places = lut[flat]
    else:
        there, places = np.unique(flat, return_inverse=True)
    return used[np.stack([there // (k * k), there // k % k, there % k], 1)], owner[at], places


def _numbered(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct symbols, 0 among them, and each one's number."""
    lut = np.zeros(int(symbols.max(initial=0)) + 1, np.int64)
    lut[symbols] = 1
    lut[0] = 1
    used = np.flatnonzero(lut)
    lut[used] = np.arange(len(used))
    return used, lut[symbols]


def bind(triples: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """The n-grams' vectors: letters rotated by two, one and no places, multiplied."""
    points, back = np.unique(triples, return_inverse=True)
    back = back.reshape(triples.shape)
    v = letter_vectors(points, dims)
    return np.roll(v, 2, 1)[back[:, 0]] * np.roll(v, 1, 1)[back[:, 1]] * v[back[:, 2]]


def bundles(texts: list[str], dims: int = DIMS) -> np.ndarray:
    """Each text's sum of n-gram vectors."""
    triples, owner, places = grams(texts)
    out = np.zeros((len(texts), dims), np.float32)
    if not len(triples):
        return out
    vectors = bind(triples, dims).astype(np.float32)
    step = max(1, CELLS // len(triples))
    for low in range(0, len(texts), step):
        n = min(step, len(texts) - low)
        a, b = np.searchsorted(owner, [low, low + n])
        counts = np.bincount((owner[a:b] - low).astype(np.int64) * len(triples) + places[a:b], minlength=n * len(triples))
        out[low : low + n] = counts.reshape(n, -1).astype(np.float32) @ vectors
    return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("long").cast("string")), F.lit(HELD_OUT_MOD)) == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, dims: int = DIMS, most: int = MOST) -> tuple[list[str], np.ndarray]:
    """The languages in order and their prototypes, from all labelled rows that aren't held out."""
    rows = docs.select(text_of().alias("text"), F.col("lang").cast("string").alias("lang"), held_out(F.col("doc_id")).alias("out")).filter("lang is not null and not out").select("text", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for some in by_bytes(batch, 0, SLICE):
                coded = some.column(1).dictionary_encode()
                triples, owner, places = grams(some.column(0).to_pylist())
                vectors, n = bind(triples, dims).astype(np.float64), len(triples)
                langs = coded.indices.to_numpy()[owner]
                for k, lang in enumerate(coded.dictionary.to_pylist()):
                    counts = np.bincount(places[langs == k], minlength=n)
                    sums[lang] = sums.get(lang, 0) + np.rint(counts @ vectors).astype(np.int64)
        if sums:
            values = pa.array(np.concatenate(list(sums.values())))
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.ListArray.from_arrays(pa.array(np.arange(len(sums) + 1, dtype=np.int32) * dims), values)], ["lang", "sums"])

    parts = rows.mapInArrow(run, "lang string, sums array<long>").select("lang", F.posexplode("sums").alias("dim", "x"))
    summed = parts.groupBy("lang", "dim").agg(F.sum("x").alias("x")).groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "x"))), lambda s: s["x"]).alias("sums"))
    found = summed.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} languages: their prototypes are broadcast, so their number is bounded")
    found = sorted((r["lang"], r["sums"]) for r in found)
    return [r[0] for r in found], np.array([r[1] for r in found], np.float64).reshape(-1, dims)


def predict(texts: list[str], langs: list[str], prototypes: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Each text's language and cosine."""
    if not langs:
        return ["und"] * len(texts), np.zeros(len(texts))
    got = bundles(texts, prototypes.shape[1]).astype(np.float64)
    sizes, own = np.linalg.norm(got, axis=1), np.linalg.norm(prototypes, axis=1)
    cosines = (got @ prototypes.T) / np.maximum(sizes[:, None], 1e-300) / np.maximum(own, 1e-300)
    best = cosines.argmax(1)
    has = np.array([h or any(c.isalpha() for c in t) for h, t in zip((sizes > 0).tolist(), texts)], bool)  # n-grams may cancel out
    return [langs[k] if h else "und" for k, h in zip(best.tolist(), has.tolist())], np.where(has, np.clip(cosines[np.arange(len(best)), best], 0, 1), 0.0)


def classify(docs: DataFrame, langs: list[str], prototypes: np.ndarray) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row."""
    sent = docs.sparkSession.sparkContext.broadcast((langs, prototypes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in by_bytes(batch, 2, SLICE):
                names, scores = predict(some.column(2).to_pylist(), *sent.value)
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "held_out", "lang_pred", "score"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), text_of().alias("text"))
    return slim.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return classify(docs, *fit(docs))
