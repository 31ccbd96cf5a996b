"""MinHash near-deduplication with HyperMinHash sketches.

A document's set is its distinct n-word shingles. A sketch splits the set's
64-bit hashes into 128 buckets by their first bits and keeps, for each bucket,
the leading-zero count and ten mantissa bits of the smallest rest: 16 bits a
register. Empty registers borrow from a full one, chosen by a hash of the bucket
number (optimal densification), so that small sets can be banded too.

1. Sketch: a map over whole texts. Documents with equal sets form a class.
2. Band: registers are banded by fours; 32 bands find a pair at similarity 0.8
   with probability 1 - 5e-8. Bands with one class are dropped. The classes of a
   band of at most `small` are all paired; in a larger band each class is paired
   with the band's first class and with the next one, in an order that differs
   from band to band.
3. Estimate: the share of equal registers, less the share expected from
   collisions of unrelated registers, must come within five deviations of the
   threshold (sets below `sure` shingles all pass).
4. Verify: each class's most similar candidate of smaller id is checked on the
   full sets of the two texts; components of the links found are contracted,
   and the remaining pairs between components are checked.
5. Large bands that still hold several components are compared in blocks: the
   band's rows outside its largest component, `block` at a time, with all its rows,
   `block` at a time. A task compares two blocks' whole sets and returns a pair for
   two components at most; these are verified as in 4. So no pair of a large band
   is left out, and no group's pairs are ever listed.

Components are tables throughout: each round hooks every root to its smallest
neighbour, then jumps pointers until all are roots.

Defined cases: null or empty text has an empty set, is linked with nothing and
kept; equal sets are similar whatever the order of their words; a null doc_id is
never another row's component, and its row is linked with equal sets alone; rows that
repeat a doc_id share that id's component, which links of each of their texts join; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.base import GOLD, by_bytes, lower_ascii, materialise, mix, text_of, word_hashes, words_of

BUCKET_BITS, MANTISSA_BITS, ROWS = 7, 10, 4
BUCKETS, BANDS = 1 << BUCKET_BITS, (1 << BUCKET_BITS) // ROWS
WORDS, SIMILARITY, SMALL, BLOCK, SURE = 5, 80, 16, 256, 256


def shingle_set(text: str, n: int) -> set[tuple[str, ...]]:
    """The distinct n-word shingles; of fewer words, the whole sequence."""
    words = words_of(lower_ascii(text))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(n))))


def shingle_hashes(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted 64-bit hashes of each text's shingle set."""
    h, sizes = word_hashes(texts)
    ends = np.cumsum(sizes)
    rolled = _rolled(h, n)
    out = []
    for end, size in zip(ends.tolist(), sizes.tolist()):
        start = end - size
        out.append(np.unique(rolled[start : end - n + 1] if size >= n else _rolled(h[start:end], size)))
    return out


def _rolled(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n word hashes."""
    out = np.full(max(0, len(h) - n + 1) if n else 0, n, np.uint64)
    for i in range(n if len(out) else 0):
        out = mix((out + GOLD) ^ h[i : len(h) - n + 1 + i])
    return out


def _borrow_order() -> np.ndarray:
    """For each attempt and bucket, the bucket to borrow from: the same for all documents."""
    at = np.arange(BUCKETS * 64, dtype=np.uint64).reshape(64, BUCKETS)
    return (mix(at * GOLD + GOLD) % np.uint64(BUCKETS)).astype(np.int64)


_BORROW = _borrow_order()


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Registers of each set of hashes, a row each; an empty set's are all zero."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.zeros((len(sets), BUCKETS), np.uint16)
    if not sizes.sum():
        return out
    h = np.concatenate(sets)
    bucket = (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    low = np.full(len(sets) * BUCKETS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(low, np.repeat(np.arange(len(sets)), sizes) * BUCKETS + bucket, h << np.uint64(BUCKET_BITS) | np.uint64(1))
    full = low != np.iinfo(np.uint64).max
    zeros = 63 - np.floor(np.log2(low.astype(np.float64))).astype(np.int64).clip(0, 63)
    zeros += (zeros < 63) & ((low << zeros.astype(np.uint64)) >> np.uint64(63) == 0)  # float rounding at powers of two
    mantissa = (low << np.minimum(zeros + 1, 63).astype(np.uint64)) >> np.uint64(64 - MANTISSA_BITS)
    regs = np.where(full, (zeros.clip(0, 62) + 1 << MANTISSA_BITS) | mantissa.astype(np.int64), 0).astype(np.uint16).reshape(-1, BUCKETS)
    there = regs != 0
    some = there.any(1)
    out[:] = regs
    for attempt in range(64):
        empty = (out == 0) & some[:, None]
        if not empty.any():
            break
        r, b = np.nonzero(empty)
        source = _BORROW[attempt][b]
        out[r, b] = np.where(there[r, source], regs[r, source], 0)
    r, b = np.nonzero((out == 0) & some[:, None])  # hardly ever: the next full bucket
    for i, j in zip(r, b):
        out[i, j] = regs[i, (j + 1 + np.argmax(there[i, (j + 1 + np.arange(BUCKETS)) % BUCKETS])) % BUCKETS]
    return out


def _collision_shares() -> np.ndarray:
    """For sets of 2^k hashes: the chance that a register of two unrelated ones is equal."""
    low = np.array([[2.0**-z * (1 + m / 2**MANTISSA_BITS) / 2 for m in range(2**MANTISSA_BITS)] for z in range(45)]).ravel()
    wide = np.repeat(2.0 ** -np.arange(1, 46) / 2**MANTISSA_BITS, 2**MANTISSA_BITS)
    out = []
    for k in range(41):
        n = max(1.0, 2.0**k / BUCKETS)
        p = np.exp(n * np.log1p(-low)) - np.exp(n * np.log1p(-np.minimum(low + wide, 1 - 1e-15)))
        out.append(float((p * p).sum()))
    return np.array(out)


_shares: list[np.ndarray] = []


def estimate(equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from numbers of equal registers, corrected for collisions."""
    if not _shares:
        _shares.append(_collision_shares())
    size = np.log2(np.maximum(1, np.sqrt(n_a.astype(float) * n_b))).round().astype(int).clip(0, 40)
    c = _shares[0][size]
    return (equal / BUCKETS - c) / (1 - c)


def _bands(regs: np.ndarray) -> np.ndarray:
    """64-bit keys of the bands, a row for each sketch."""
    wide = regs.reshape(-1, BANDS, ROWS).astype(np.uint64)
    out = np.arange(BANDS, dtype=np.uint64) * GOLD
    for i in range(ROWS):
        out = mix((out + GOLD) ^ wide[:, :, i])
    return out.view(np.int64)


def sketches(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, __set (digest of the whole set), __regs (packed registers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in by_bytes(b, 1, 2 << 20):
                sets = shingle_hashes(some.column(1), words)
                regs = sketch(sets)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()), pa.array([r.tobytes() for r in regs], pa.binary())],
                    ["doc_id", "n_shingles", "__set", "__regs"],
                )

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, "doc_id long, n_shingles long, __set binary, __regs binary")


def _banded(classes: DataFrame) -> DataFrame:
    """__band, __id for each band of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                keys = _bands(np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint16))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(b.column(0).to_numpy(), BANDS))], ["__band", "__id"])

    return classes.select("__id", "__regs").mapInArrow(run, "__band long, __id long")


def _similar(pairs: DataFrame, similarity: int) -> DataFrame:
    """pairs (with __n, __regs and __n2, __regs2) whose estimate comes near the threshold, with __est."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint16).reshape(-1, BUCKETS) for i in (3, 5))
            n, m = b.column(2).to_numpy(), b.column(4).to_numpy()
            est = estimate((x == y).sum(1), n, m)
            ok = _near(est, n, m, similarity)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(ok)), b.column(1).filter(pa.array(ok)), pa.array(est[ok])], ["__a", "__b", "__est"])

    return pairs.select("__a", "__b", "__n", "__regs", "__n2", "__regs2").mapInArrow(run, "__a long, __b long, __est double")


def _near(est: np.ndarray, n: np.ndarray, m: np.ndarray, similarity: int) -> np.ndarray:
    """Whether pairs may reach the threshold: by their sizes, and by the estimate less five deviations."""
    s = similarity / 100
    slack = 5 * (s * (1 - s) / BUCKETS) ** 0.5
    sized = 100 * np.minimum(n, m) >= similarity * np.maximum(n, m)
    return sized & ((est >= s - slack) | (np.minimum(n, m) < SURE))


def verify(pairs: DataFrame, docs: DataFrame, words: int, similarity: int) -> DataFrame:
    """The pairs (__a, __b) of doc_ids whose full shingle sets reach the similarity in percent."""
    texts = docs.select(F.col("doc_id").cast("long").alias("__a"), text_of().alias("__text"))
    both = pairs.select("__a", "__b").join(texts, "__a").join(texts.select(F.col("__a").alias("__b"), F.col("__text").alias("__text2")), "__b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                some, ok, last = b.slice(k, 256), [], (None, None)
                for x, y in zip(some.column(2).to_pylist(), some.column(3).to_pylist()):
                    if last[0] != x:
                        last = x, shingle_set(x, words)
                    s, t = last[1], shingle_set(y, words)
                    same = len(s & t)
                    ok.append(100 * same >= similarity * (len(s) + len(t) - same))
                yield pa.RecordBatch.from_arrays([some.column(i).filter(pa.array(ok)) for i in (0, 1)], ["__a", "__b"])

    return both.select("__a", "__b", "__text", "__text2").mapInArrow(run, "__a long, __b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """__id, __root: the smallest id reachable over links (__a, __b), for every linked id but the roots."""
    spark = links.sparkSession
    found = None
    links = materialise(links.filter("__a <> __b").select(F.least("__a", "__b").alias("__a"), F.greatest("__a", "__b").alias("__b")).distinct(), "links")
    while not links.isEmpty():
        # Each root hooks to its smallest neighbour, if that is smaller: a forest.
        hooks = materialise(links.groupBy(F.col("__b").alias("__id")).agg(F.min("__a").alias("__root")), "hooks")
        while True:
            up = hooks.select(F.col("__id").alias("__root"), F.col("__root").alias("__up"))
            jumped = materialise(hooks.join(up, "__root", "left").select("__id", F.coalesce("__up", "__root").alias("__root"), F.col("__up").isNotNull().alias("__moved")), "hooks")
            hooks = jumped.select("__id", "__root")
            if jumped.filter("__moved").isEmpty():
                break
        found = hooks if found is None else materialise(relabel(found, "__root", hooks).unionByName(hooks), "roots")
        links = materialise(_contract(links, hooks), "links")
    return found if found is not None else spark.createDataFrame([], "__id long, __root long")


def relabel(df: DataFrame, column: str, roots: DataFrame) -> DataFrame:
    """df with the ids of a column replaced by their roots."""
    r = roots.select(F.col("__id").alias(column), F.col("__root").alias("__new"))
    return df.join(r, column, "left").withColumn(column, F.coalesce("__new", column)).select(*df.columns)


def _contract(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    out = relabel(relabel(pairs.select("__a", "__b"), "__a", roots), "__b", roots).filter("__a <> __b")
    return out.select(F.least("__a", "__b").alias("__a"), F.greatest("__a", "__b").alias("__b")).distinct()


def _across(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends lie in different components."""
    ends = pairs.withColumns({"__x": F.col("__a"), "__y": F.col("__b")})
    return relabel(relabel(ends, "__x", roots), "__y", roots).filter("__x <> __y").drop("__x", "__y")


def _crowded(placed: DataFrame) -> DataFrame:
    """__band, __id, __root, __ku, __ka, __rest of bands that hold several components.

    __rest: not in the band's largest component. __ku and __ka: numbers of blocks
    for such rows, and for all rows.
    """
    sizes = placed.groupBy("__band", "__root").agg(F.count("*").alias("__n"))
    bands = sizes.groupBy("__band").agg(F.sum("__n").alias("__all"), F.max(F.struct("__n", "__root")).alias("__main"), F.count("*").alias("__roots")).filter("__roots > 1")
    bands = bands.select("__band", "__all", F.col("__main.__root").alias("__top"), (F.col("__all") - F.col("__main.__n")).alias("__few"))
    return placed.join(bands, "__band").withColumn("__rest", F.col("__root") != F.col("__top")).drop("__top")


def _blocks(crowded: DataFrame, docs: DataFrame, words: int, similarity: int, block: int) -> DataFrame:
    """Links between different components of a band, one for each two components of a group at most.

    The rows outside the largest component are dealt to blocks, and so are all
    rows; each block of the former meets each of the latter in a group of its own.
    There the sets' intersections come from products of 0/1 matrices.
    """
    k = lambda c: F.ceil(F.col(c) / F.lit(block)).cast("int")
    dealt = crowded.withColumns({"__i": F.pmod(F.xxhash64("__id"), k("__few")).cast("int"), "__j": F.pmod(F.xxhash64("__id"), k("__all")).cast("int")})
    every = F.sequence(F.lit(0), k("__few") - 1)
    left = dealt.filter("__rest").select("__band", "__id", "__root", F.lit(True).alias("__left"), "__i", F.explode(F.sequence(F.lit(0), k("__all") - 1)).alias("__j"))
    right = dealt.select("__band", "__id", "__root", F.lit(False).alias("__left"), F.explode(every).alias("__i"), "__j")
    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), text_of().alias("__text"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out: dict[tuple[int, int], tuple[float, int, int]] = {}
        one, two = (x.drop_duplicates(["__id", "__text"]) for x in (pdf[pdf["__left"]], pdf[~pdf["__left"]]))
        if len(one) and len(two):
            share = _similarities(*(shingle_hashes(pa.array(x["__text"], pa.string()), words) for x in (one, two)))
            ids, others, roots, theirs = (x.to_numpy() for x in (one["__id"], two["__id"], one["__root"], two["__root"]))
            for i, j in np.argwhere((share >= similarity / 100 - 1e-9) & (roots[:, None] != theirs[None, :])):
                key = (min(roots[i], theirs[j]), max(roots[i], theirs[j]))
                out[key] = max(out.get(key, (0.0, 0, 0)), (float(share[i, j]), int(min(ids[i], others[j])), int(max(ids[i], others[j]))))
        return pd.DataFrame([v[1:] for v in out.values()], columns=["__a", "__b"], dtype="int64")

    sent = left.unionByName(right).join(texts, "__id")
    return sent.groupBy("__band", "__i", "__j").applyInPandas(run, "__a long, __b long").distinct()


def _similarities(one: list[np.ndarray], two: list[np.ndarray], columns: int = 16384) -> np.ndarray:
    """Jaccard similarities of all sets of hashes in one with all in two."""
    known = np.unique(np.concatenate(one))
    same = np.zeros((len(one), len(two)))
    places = []
    for sets in (one, two):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        h = np.concatenate(sets)
        at = np.searchsorted(known, h).clip(0, len(known) - 1)
        there = known[at] == h
        order = np.argsort(at[there], kind="stable")
        places.append((row[there][order], at[there][order]))
    for low in range(0, len(known), columns):
        parts = []
        for (row, at), n in zip(places, (len(one), len(two))):
            a, b = np.searchsorted(at, (low, low + columns))
            m = np.zeros((n, columns), np.float32)
            m[row[a:b], at[a:b] - low] = 1
            parts.append(m)
        same += parts[0] @ parts[1].T
    n, m = np.array([len(s) for s in one])[:, None], np.array([len(s) for s in two])[None, :]
    return same / np.maximum(n + m - same, 1)


def mark(docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """A row for each row of docs: doc_id, n_shingles, component_id, kept."""
    sketched = materialise(sketches(docs, words), "sketches")
    firsts = materialise(sketched.filter("n_shingles > 0").groupBy("__set").agg(F.min("doc_id").alias("__id")).filter("__id is not null"), "sets")
    # Sets of up to 3 shingles reach 0.8 only with an equal set.
    least = similarity // max(1, 100 - similarity)
    able = sketched.filter(F.col("n_shingles") >= least).withColumnRenamed("doc_id", "__id").join(firsts, ["__set", "__id"], "left_semi")
    # Rows that repeat an id bring each their own sketch to its class.
    classes = materialise(able.groupBy("__id", "__set").agg(F.max("n_shingles").alias("__n"), F.max("__regs").alias("__regs")).drop("__set"), "classes")
    roots = _linked(classes, docs, words, similarity, small, block)
    named = relabel(firsts.withColumn("component_id", F.col("__id")), "component_id", roots).select("__set", "component_id")
    out = sketched.select("doc_id", "n_shingles", "__set").join(named, "__set", "left")
    out = out.withColumn("component_id", F.coalesce(F.when(F.col("n_shingles") > 0, F.col("component_id")), "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _linked(classes: DataFrame, docs: DataFrame, words: int, similarity: int, small: int, block: int) -> DataFrame:
    banded = _banded(classes)
    sizes = banded.groupBy("__band").agg(F.count("*").alias("__m")).filter("__m > 1")
    shared = materialise(banded.join(sizes, "__band"), "bands")
    few = shared.filter(F.col("__m") <= small)
    every = few.select("__band", F.col("__id").alias("__a")).join(few.select("__band", F.col("__id").alias("__b")), "__band").filter("__a < __b")
    many = shared.filter(F.col("__m") > small)
    first = many.groupBy("__band").agg(F.min("__id").alias("__a"))
    star = many.select("__band", F.col("__id").alias("__b")).join(first, "__band")
    spread = many.withColumn("__salt", F.pmod(F.xxhash64("__id"), F.ceil(F.col("__m") / F.lit(4096))))
    after = F.lead("__id").over(Window.partitionBy("__band", "__salt").orderBy(F.xxhash64("__band", "__id"), "__id"))
    chain = spread.select(F.col("__id").alias("__a"), after.alias("__b")).filter("__b is not null")
    pairs = every.select("__a", "__b").unionByName(star.select("__a", "__b")).unionByName(chain)
    pairs = pairs.filter("__a <> __b").select(F.least("__a", "__b").alias("__a"), F.greatest("__a", "__b").alias("__b")).distinct()
    left = classes.select(F.col("__id").alias("__a"), "__n", "__regs")
    right = classes.select(F.col("__id").alias("__b"), F.col("__n").alias("__n2"), F.col("__regs").alias("__regs2"))
    near = materialise(_similar(pairs.join(left, "__a").join(right, "__b"), similarity), "near")
    best = near.groupBy("__b").agg(F.max_by("__a", F.struct("__est", -F.col("__a"))).alias("__a")).select("__a", "__b")
    roots = _grown(None, verify(best, docs, words, similarity))
    rest = _across(near.select("__a", "__b").join(best, ["__a", "__b"], "left_anti"), roots)
    checked = verify(rest, docs, words, similarity)
    roots = _grown(roots, checked)
    placed = relabel(many.select("__band", "__id").withColumn("__root", F.col("__id")), "__root", roots)
    crowded = materialise(_crowded(placed), "crowded")
    if crowded.isEmpty():
        return roots
    return _grown(roots, verify(_blocks(crowded, docs, words, similarity, block), docs, words, similarity))


def _grown(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """roots with the components that the links join."""
    if roots is None:
        return components(links)
    more = components(_contract(links, roots))
    return materialise(relabel(roots, "__root", more).unionByName(more), "roots")


def keep(docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """The rows of docs that stay: of each component, those with its smallest doc_id; all columns, whatever their names."""
    gone = mark(docs, words, similarity).filter("not kept").select(F.col("doc_id").alias("id")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"))
    return rows.join(gone, "id", "left_anti").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return mark(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=2)
