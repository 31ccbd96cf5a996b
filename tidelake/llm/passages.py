"""Substring deduplication by compact windows.

A text is a sequence of hashed n-word shingles. Under one hash function, the node
of the Cartesian tree (smallest value on top) at position c spans the stretch
[l, r] in which c is the minimum: every subsequence of [l, r] that holds c has the
min-hash of c. Nodes whose span is at least the least passage are the compact
windows; a text has about 2n / t of them for a hash function.

1. Texts that are equal, but for white space, form a class; its first document
   stands for it. Copies are returned as membership.
2. The keys (min-hashes) of the windows of `HASHES` functions are counted; bitmaps of
   those that several texts have keep other windows where they are.
3. Windows of a key that at most `small` windows have are paired, all with all. An
   interval join per pair of texts keeps rectangles (window x window) that overlap,
   on both sides by the least passage, with those of `enough` functions.
4. The windows of larger groups are told apart by what lies around their c. A passage
   at 0.8 has a stretch of LONG = 21 shingles word for word, as each change costs some
   nine shingles on both sides; of each such stretch that holds a c, the run of RUN =
   11 shingles with the least hash is chosen, so that texts which share a stretch
   share a run. Texts of a run that at most `few` have are paired, all with all; of
   others, each with the run's first text.
5. Regions are verified on the full texts: stretches of shared shingles with a
   set similarity of `similarity` percent or more, of at least `least` words; where
   a stretch is not similar as a whole, its longest parts that are, then equal runs.
6. The members of a run that have a passage across it with the first text get its root.
   The others, but for those that share fewer shingles with all other members than a
   passage needs, are compared with `PIVOTS` members, and what a run's largest root
   then leaves out, `block` at a time, with all its members, `block` at a time. A
   task compares what lies around the run and returns a stretch for two roots at
   most; these are verified as in 5. So no member of a large group is left without a passage
   that it has with another, and no group's pairs are ever listed.

Defined cases: null or empty texts, and texts below `least` words, have no
passages and no copies; repeated passages inside one text don't count, and the first of them is the one reported against a twin; a null
doc_id is ignored; rows that repeat a doc_id and a text count once; a word repeated
over and over is a passage like others; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm import bitmap, near_dedup
from tidelake.llm.base import GOLD, SPACE, by_bytes, materialise, mix, rolling, shared_dir, text_of, word_hashes, word_places

HASHES, ENOUGH, WORDS, LEAST, SIMILARITY, SMALL, FEW, GAP, BLOCK = 5, 2, 5, 50, 80, 16, 64, 15, 512
#: Shingles of the runs by which large groups are told apart; two texts that share LONG shingles in a row share a chosen run.
RUN, LONG, AROUND, PIVOTS = 11, 21, 45, 64
#: Number, as of a hash function, of rectangles that need no support.
NEAR = 101
#: Rectangles of a pair up to which they are compared with those of other pairs in one go; keys in a group of the first pass; bytes of text in a slice.
MANY, KEYS, SLICE = 64, 1 << 21, 2 << 20


#: A map over texts (__id, __text), given a function over batches and the schema of its result.
Mapped = Callable[[Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], str], DataFrame]


def shingle_sequences(texts: pa.Array, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the n-word shingles of all texts, one after another, and shingles per text."""
    h, sizes = word_hashes(texts)
    at = np.arange(len(h) - n + 1) if len(h) >= n else np.zeros(0, np.int64)
    at = at[at + n <= np.repeat(np.cumsum(sizes), sizes)[: len(at)]]
    return rolling.stretches(h, at, at + n), np.maximum(0, sizes - n + 1)


def compact_windows(values: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """l, c, r (inclusive) of the Cartesian trees' nodes that span at least width.

    values: several texts, one after another; starts: where each one begins. Of
    equal values in a text, the first counts as smaller.
    """
    n = len(values)
    none = np.zeros(0, np.int64)
    ends = np.append(starts[1:], n)
    row = np.repeat(np.arange(len(starts)), ends - starts)
    # A node spans at least width if it is the minimum of a stretch of width.
    first = np.flatnonzero(np.arange(n) + width <= ends[row]) if n else none
    if not len(first):
        return none, none, none
    # The low bits give way to the place: no two values are equal, and a minimum tells where it is.
    low = np.uint64((1 << n.bit_length()) - 1)
    least, reach = (values & ~low) | np.arange(n, dtype=np.uint64), 1
    while 2 * reach <= width:  # minima of stretches of 2, 4, ...
        least, reach = np.minimum(least[:-reach], least[reach:]), 2 * reach
    c = (np.minimum(least[first], least[first + width - reach]) & low).astype(np.int64)
    c = c[np.append(True, c[1:] != c[:-1])]  # the minima's places never go back
    # What ends a node's span is a smaller value, whose own span holds this one: the nodes alone decide.
    own, owner = (values[c] & ~low) | c.astype(np.uint64), row[c]
    m = len(c)
    levels, longest = [own], int(np.bincount(owner - owner[0]).max())
    while 1 << len(levels) <= longest:
        half, last = 1 << (len(levels) - 1), levels[-1]
        wide = last.copy()
        np.minimum(last[: m - half], last[half:], out=wide[: m - half])
        levels.append(wide)
    begin, end = np.searchsorted(owner, owner, "left"), np.searchsorted(owner, owner, "right")
    left, right = np.arange(m), np.arange(m)
    for k in range(len(levels) - 1, -1, -1):
        step = 1 << k
        at = left - step
        left = np.where((at >= begin) & (levels[k][np.maximum(at, 0)] > own), at, left)
        at = right + step
        right = np.where((at < end) & (levels[k][np.minimum(right + 1, m - 1)] > own), at, right)
    before, after = np.append(-1, c[:-1])[left], np.append(c[1:], n)[right]
    return np.where(left > begin, before + 1, starts[owner]), c, np.where(right < end - 1, after - 1, ends[owner] - 1)


def text_windows(h: np.ndarray, sizes: np.ndarray, width: int, hashes: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For each hash function: text, key, l, c, r of the texts' compact windows; l, c, r count over all texts.

    h, sizes: shingle_sequences of the texts. Of windows with one key in a text whose whole spans
    are equal, the first stands for all: what they hold repeats inside the text.
    """
    starts = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(sizes)), sizes)
    for f in range(hashes if len(h) else 0):
        values = mix(h ^ mix(np.array([f + 1], np.uint64) * GOLD)[0])
        l, c, r = compact_windows(values, starts, width)
        some = _repeated(values[c])
        some = some[_repeated(values[c[some]] ^ mix(row[c[some]].astype(np.uint64) * GOLD))]  # in one text, and the few that another's meets by chance
        if len(some):
            kept = np.ones(len(c), bool)
            kept[some] = False
            kept[some[_firsts(row[c[some]], values[c[some]], rolling.stretches(h, l[some], r[some] + 1), (c - l)[some])]] = True
            l, c, r = l[kept], c[kept], r[kept]
        yield row[c], values[c].view(np.int64), l, c, r


def _repeated(x: np.ndarray) -> np.ndarray:
    """Places, in order, of the values that come more than once."""
    order = np.argsort(x)
    same = x[order[1:]] == x[order[:-1]]
    return np.sort(order[np.append(same, False) | np.append(False, same)[: len(x)]]) if same.any() else order[:0]


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """The first place of each distinct row of the columns."""
    order = np.lexsort(columns)
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[order[1:]] != c[order[:-1]] for c in columns], axis=0)
    return order[new]


def shared_keys(texts: Mapped, words: int, least: int, hashes: int, parts: int) -> DataFrame:
    """__key, __m: the windows' keys that several texts have, and how many windows have them.

    A task sends each key once for a slice of its texts, with the numbers of texts and windows, as
    arrays for each of `parts` parts; a part is sorted in one group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in by_bytes(b, 1, SLICE):
                got = [w[:2] for w in text_windows(*shingle_sequences(some.column(1), words), least - words + 1, hashes)]
                if not sum(len(w[0]) for w in got):
                    continue
                row, key = (np.concatenate(x) for x in zip(*got))
                order = np.lexsort((row, key))
                row, key = row[order], key[order]
                once = np.append(True, (row[1:] != row[:-1]) | (key[1:] != key[:-1]))[: len(key)]
                key, at, m = np.unique(key, return_index=True, return_counts=True)
                n = np.add.reduceat(once.astype(np.int64), at) if len(at) else m
                part = (mix(key.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                found, at = np.unique(part[order], return_index=True)
                cut = lambda x: [y.tobytes() for y in np.split(x[order], at[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(cut(key), pa.binary()), pa.array(cut(n.astype(np.int32)), pa.binary()), pa.array(cut(m.astype(np.int32)), pa.binary())], ["__part", "__keys", "__ns", "__ms"])

    def several(pdf: pd.DataFrame) -> pd.DataFrame:
        key = np.frombuffer(b"".join(pdf["__keys"]), np.int64)
        order = np.argsort(key, kind="stable")
        key = key[order]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
        n, m = (np.frombuffer(b"".join(pdf[c]), np.int32)[order].astype(np.int64) for c in ("__ns", "__ms"))
        n, m = (np.add.reduceat(x, starts) if len(x) else x for x in (n, m))
        return pd.DataFrame({"__key": key[starts][n > 1], "__m": m[n > 1]})

    sent = texts(run, "__part long, __keys binary, __ns binary, __ms binary")
    return sent.groupBy("__part").applyInPandas(several, "__key long, __m long")


def runs_around(h: np.ndarray, sizes: np.ndarray, c: np.ndarray, l: np.ndarray, r: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Text, hash, start, and hull of the spans l .. r, of the chosen runs of RUN shingles near the places c.

    Of each stretch of LONG shingles that holds a c, the run with the least hash is chosen: texts that
    share such a stretch share that run. Of equal runs in a text between equal neighbours, the first stands for all.
    A run of one shingle over and over is chosen last, and only where it goes on for width: a passage that
    has less of it has what lies beside it too.
    """
    none = np.zeros(0, np.int64)
    starts = np.cumsum(sizes) - sizes
    ends, row = starts + sizes, np.repeat(np.arange(len(sizes)), sizes)
    near, n = np.zeros(len(h) + 1, np.int64), LONG - RUN + 1
    low, high = np.maximum(starts[row[c]], c - LONG + 1), np.minimum(c, ends[row[c]] - LONG) + 1
    ok = low < high
    np.add.at(near, low[ok], 1)
    np.add.at(near, high[ok], -1)
    first = np.flatnonzero(np.cumsum(near)[:-1] > 0)
    if not len(first):
        return none, none, none, none, none
    at = np.arange(len(h) - RUN + 1)
    cut = np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))
    stretch = np.cumsum(cut) - 1
    even = stretch[at] == stretch[at + RUN - 1]
    hashed = rolling.stretches(h, at, at + RUN) >> np.uint64(1) | even.astype(np.uint64) << np.uint64(63)
    low_bits = np.uint64((1 << len(h).bit_length()) - 1)
    least, reach = (hashed & ~low_bits) | at.astype(np.uint64), 1
    while 2 * reach <= n:
        least, reach = np.minimum(least[:-reach], least[reach:]), 2 * reach
    p = np.unique((np.minimum(least[first], least[first + n - reach]) & low_bits).astype(np.int64))
    p = p[~even[p] | (np.bincount(stretch)[stretch[p]] >= width)]
    order = np.argsort(c, kind="stable")
    c = c[order]
    bounds = np.stack([np.searchsorted(c, p - LONG + RUN, "left"), np.searchsorted(c, p + LONG - 1, "right")], 1).ravel()
    low, high = (f.reduceat(np.append(x[order], x[order][-1:]), bounds)[::2] for f, x in ((np.minimum, l), (np.maximum, r)))
    p = np.where(even[p], np.flatnonzero(cut)[stretch[p]], p)
    own = row[p]
    around = rolling.stretches(h, np.maximum(starts[own], p - AROUND), np.minimum(ends[own], p + RUN + AROUND))
    once = np.sort(_firsts(own, hashed[p], around))
    p, own = p[once], own[once]
    low, high = np.maximum(low[once], starts[own]), np.minimum(high[once], ends[own] - 1)
    return own, hashed[p].view(np.int64), p - starts[own], np.minimum(low, p) - starts[own], np.maximum(high, p + RUN - 1) - starts[own]


def windows(texts: Mapped, keys: DataFrame, words: int, least: int, hashes: int, small: int) -> DataFrame:
    """__key, __id, __lr, __at: the windows with keys that up to `small` windows share (function, l and r packed; __at null),
    and the chosen runs around the windows of all larger groups (__key: the run's hash; hull of the spans; place)."""
    few, many = (bitmap.build(keys.filter(x).select("__key")) for x in (F.col("__m") <= small, F.col("__m") > small))
    names, width = ["__key", "__id", "__lr", "__at"], least - words + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in by_bytes(b, 1, SLICE):
                ids, hot = some.column(0).to_numpy(), []
                h, sizes = shingle_sequences(some.column(1), words)
                starts = np.cumsum(sizes) - sizes
                for f, (row, key, l, c, r) in enumerate(text_windows(h, sizes, width, hashes)):
                    ok = bitmap.test(few.value, key)
                    at = starts[row[ok]]
                    yield pa.RecordBatch.from_arrays([pa.array(key[ok]), pa.array(ids[row[ok]]), pa.array(f << 56 | l[ok] - at << 28 | r[ok] - at), pa.nulls(len(at), pa.int64())], names)
                    ok = bitmap.test(many.value, key)
                    hot.append((c[ok], l[ok], r[ok]))
                if hot:
                    row, key, at, l, r = runs_around(h, sizes, *(np.concatenate(x) for x in zip(*hot)), width)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, ids[row], NEAR << 56 | l << 28 | r, at)], names)

    return texts(run, "__key long, __id long, __lr long, __at long")


def _home(*keys: str) -> Column:
    """The place where a pair's texts meet: the group that pairs them, a large one before a small one, so that most pairs of a passage choose the same."""
    return F.shiftleft(F.least("__m", F.lit(255)).cast("long"), 48).bitwiseOR(F.xxhash64(*keys).bitwiseAND(F.lit((1 << 48) - 1)))


def _paired(rows: DataFrame) -> DataFrame:
    """Rectangles __a, __b, __lr, __lr2 of all pairs of texts in the groups by __key of rows, with their __home."""
    x = rows.select("__key", F.col("__id").alias("__a"), "__lr", _home("__key").alias("__home"))
    y = rows.select("__key", F.col("__id").alias("__b"), F.col("__lr").alias("__lr2"))
    return x.join(y, "__key").filter("__a < __b").drop("__key")


def _starred(rows: DataFrame, members: int = 256) -> DataFrame:
    """Rectangles of each text of a run with the run's first text; with the run, and its places __x and __y in the two texts. About `members` texts have a home in common."""
    first = rows.groupBy("__key").agg(F.min(F.struct("__id", "__lr", "__at")).alias("__f")).select("__key", F.col("__f.__id").alias("__a"), F.col("__f.__lr").alias("__lr"), F.col("__f.__at").alias("__x"))
    dealt = rows.withColumn("__block", F.pmod(F.xxhash64("__id"), F.ceil(F.col("__m") / F.lit(members)))).withColumn("__home", _home("__key", "__block"))
    return dealt.select("__key", F.col("__id").alias("__b"), F.col("__lr").alias("__lr2"), F.col("__at").alias("__y"), "__home").join(first, "__key").filter("__a <> __b")


def _crowded(runs: DataFrame, left: DataFrame) -> DataFrame:
    """__band (the run), __id, __node, __at, __root, __rest of the members of runs in which some, left (__key, __id, __at), have no passage with the first text."""
    nodes = runs.select(F.col("__key").alias("__band"), "__id", "__at").distinct()
    rest = left.select(F.col("__key").alias("__band"), "__id", "__at", F.lit(True).alias("__rest")).distinct()
    members = nodes.join(rest.select("__band").distinct(), "__band", "left_semi").join(rest, ["__band", "__id", "__at"], "left")
    rest = F.coalesce("__rest", F.lit(False))
    node = F.xxhash64("__band", "__id", "__at")
    return members.select("__band", "__id", node.alias("__node"), "__at", F.when(rest, node).otherwise(F.col("__band")).alias("__root"), rest.alias("__rest"))


def _sized(members: DataFrame) -> DataFrame:
    """members of runs that hold several roots, with __all and __few: how many there are, and how many of them are __rest."""
    sizes = members.groupBy("__band").agg(F.count("*").alias("__all"), F.count_if("__rest").alias("__few")).filter("__all > 1 and __few > 0")
    return members.join(sizes, "__band")


def _promising(spans: DataFrame) -> DataFrame:
    """The rows of spans without those __rest that have fewer distinct shingles in common with others of their run than a passage needs.

    The others have a passage with the run's first text: their shingles are only met, by hash, and not looked up again.
    """

    def shingles(rows: DataFrame, columns: str, schema: str) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for some in by_bytes(b, 1, SLICE):
                    sets = [np.unique(np.frombuffer(s, np.uint64)) for s in some.column(1).to_pylist()]
                    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
                    # Run and shingle as one number: where two pairs share one, a row stays too long, never the other way round.
                    key = mix(np.concatenate(sets) ^ mix(some.column(0).to_numpy().view(np.uint64) * GOLD)[row])
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *(c.take(pa.array(row)) for c in some.columns[2:])], ["__h", *columns.split()])

        return rows.select("__band", "__span", *columns.split()).mapInArrow(run, schema)

    met = shingles(spans, "__id __rest", "__h long, __id long, __rest boolean")
    common = met.groupBy("__h").agg(F.min("__id").alias("__p"), F.max("__id").alias("__q"), F.bool_or("__rest").alias("__asked")).filter("__p <> __q and __asked").select("__h")
    rest = spans.filter("__rest")
    counted = shingles(rest, "__node", "__h long, __node long").join(common, "__h").groupBy("__node").agg(F.count("*").alias("__n"))
    return spans.filter("not __rest").unionByName(rest.join(counted, "__node").filter("__n >= __need").select(spans.columns))


def _spans(crowded: DataFrame, texts: DataFrame, words: int, width: int, similarity: int) -> DataFrame:
    """The members of crowded runs with __lr and __span, the shingles around the run and their hashes, and __need, the distinct ones that a passage shares at least.

    A passage of more than 2 * width shingles has a half that is as similar; so what lies within
    2 * width of the run decides.
    """
    kinds = {"__band": "long", "__node": "long", "__root": "long", "__at": "long", "__rest": "boolean"}
    lists = _listed(crowded.select("__id", F.struct(*kinds).alias("__x")), "__x")
    near = texts.join(lists.hint("shuffle_hash"), "__id").select("__id", "__w", "__text")
    names = [*kinds, "__id", "__lr", "__need", "__span"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in by_bytes(b, 2, SLICE >> 3):
                h, sizes = shingle_sequences(some.column(2), words)
                starts = np.cumsum(sizes) - sizes
                own = np.repeat(np.arange(len(sizes)), pc.list_value_length(some.column(1)).to_numpy())
                cols = dict(zip(kinds, some.column(1).flatten().flatten()))
                at = cols["__at"].to_numpy()
                low, high = np.maximum(0, at - 2 * width), np.minimum(sizes[own] - 1, at + RUN + 2 * width)
                spans = [h[i:j] for i, j in zip((starts[own] + low).tolist(), (starts[own] + high + 1).tolist())]
                need = [int(np.ceil(similarity / 100 * _fewest(s, i, width) - 1e-9)) for s, i in zip(spans, (at - low).tolist())]
                yield pa.RecordBatch.from_arrays([*cols.values(), pa.array(some.column(0).to_numpy()[own]), pa.array(low << 28 | high), pa.array(need, pa.int64()), pa.array([s.tobytes() for s in spans], pa.binary())], names)

    return near.mapInArrow(run, ", ".join(f"{n} {kinds.get(n, 'long')}" for n in names[:-1]) + ", __span binary")


def _fewest(span: np.ndarray, at: int, width: int) -> int:
    """The least number of distinct shingles in a stretch of width of the span that holds the run at `at`."""
    order = np.argsort(span, kind="stable")
    again = np.flatnonzero(span[order][1:] == span[order][:-1]) + 1
    if not len(again):
        return width
    before = np.full(len(span), -1)  # where each shingle came last
    before[order[again]] = order[again - 1]
    return min((np.count_nonzero(before[w : w + width] < w) for w in range(max(0, at + RUN - width), min(at, len(span) - width) + 1)), default=width)


def _listed(rows: DataFrame, column: str, most: int = 1024) -> DataFrame:
    """__id, __w: lists of the column's values by __id, of about `most` values each, so that no list grows with the rows of an id."""
    sizes = rows.groupBy("__id").agg(F.ceil(F.count("*") / F.lit(most)).alias("__k"))
    salted = rows.join(sizes, "__id").withColumn("__salt", F.pmod(F.xxhash64(column), "__k"))
    return salted.groupBy("__id", "__salt").agg(F.collect_list(column).alias("__w")).drop("__salt")


def _common(one: list[np.ndarray], two: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Numbers of distinct hashes that each array of one has in common with each of two."""
    same = np.zeros((len(one), len(two)), np.float32)
    both = np.intersect1d(np.concatenate(one), np.concatenate(two))
    placed = []
    for some in (one, two):
        row, h = np.repeat(np.arange(len(some)), [len(x) for x in some]), np.concatenate(some)
        at = np.searchsorted(both, h).clip(0, max(0, len(both) - 1))
        there = both[at] == h if len(both) else np.zeros(len(h), bool)
        order = np.argsort(at[there], kind="stable")
        placed.append((row[there][order], at[there][order]))
    for low in range(0, len(both), columns):
        parts = []
        for (row, at), some in zip(placed, (one, two)):
            i, j = np.searchsorted(at, (low, low + columns))
            m = np.zeros((len(some), min(columns, len(both) - low)), np.float32)
            m[row[i:j], at[i:j] - low] = 1
            parts.append(m)
        same += parts[0] @ parts[1].T
    return same


def similar_spans(one: pd.DataFrame, two: pd.DataFrame, width: int, similarity: int) -> tuple[list[tuple[int, int, int, int]], dict[int, int]]:
    """a, b and packed stretches of passages around the run, for two roots at most, and what the roots so linked turn into.

    one, two: rows of __id, __root, __at, __lr, __need, __span.
    """
    mask, out, up = (1 << 28) - 1, [], {}
    spans = [[np.frombuffer(s, np.uint64) for s in side["__span"]] for side in (one, two)]
    need, ids, roots, lr, at = ([side[c].to_numpy() for side in (one, two)] for c in ("__need", "__id", "__root", "__lr", "__at"))
    roots, left = [r.copy() for r in roots], [x >> 28 & mask for x in lr]
    same = _common(*spans)
    ok = (same >= np.maximum(need[0][:, None], need[1][None, :])) & (ids[0][:, None] != ids[1][None, :])
    known = np.intersect1d(np.concatenate(spans[0]), np.concatenate(spans[1]))
    codes = [_coded(some, known) for some in spans]
    sets = np.zeros((len(spans[1]), len(known) + 1), bool)  # the last column is for what is not shared, and what fills up shorter spans
    np.put_along_axis(sets, codes[1], True, 1)
    sets[:, -1] = False
    again = [np.array([len(np.unique(x)) < len(x) for x in some]) for some in spans]
    for p in np.argsort(-ok.sum(1), kind="stable").tolist():
        some = np.flatnonzero(ok[p] & (roots[1] != roots[0][p]))
        if not len(some):
            continue
        s, c = spans[0][p], int(at[0][p] - left[0][p])
        own = np.zeros(len(known) + 1, bool)
        own[codes[0][p, : len(s)]] = True
        own[-1] = False
        gain = _gain(sets[np.ix_(some, codes[0][p, : len(s)])], np.full(len(some), len(s)), np.full(len(some), c), width, similarity)
        gain += _gain(own[codes[1][some]], np.array([len(spans[1][q]) for q in some]), (at[1] - left[1])[some], width, similarity)
        # Where shingles repeat, numbers of places say nothing of sets.
        some = some[(gain >= 0) | again[0][p] | again[1][some]]
        for q in some[np.argsort(-same[p, some], kind="stable")].tolist():
            x, y = sorted((int(roots[0][p]), int(roots[1][q])))
            if x == y:
                continue
            l, l2, c2 = int(left[0][p]), int(left[1][q]), int(at[1][q] - left[1][q])
            for b, e, b2, e2, _ in passages(s, spans[1][q], (0, len(s) - 1, 0, len(spans[1][q]) - 1), width, similarity):
                if b <= c <= e and b2 <= c2 <= e2:
                    for r in roots:
                        r[r == y] = x
                    up = {k: x if v == y else v for k, v in up.items()} | {y: x}
                    ends = sorted([(int(ids[0][p]), l + b << 28 | l + e), (int(ids[1][q]), l2 + b2 << 28 | l2 + e2)])
                    out.append((ends[0][0], ends[1][0], NEAR << 56 | ends[0][1], ends[1][1]))
                    break
    return out, up


def _coded(spans: list[np.ndarray], known: np.ndarray) -> np.ndarray:
    """A row for each span: places in known, len(known) for what isn't there and to fill up."""
    out = np.full((len(spans), max(map(len, spans))), len(known))
    for row, s in zip(out, spans):
        at = np.searchsorted(known, s)
        row[: len(s)] = np.where(np.append(known, np.uint64(0))[at] == s, at, len(known)) if len(known) else len(known)
    return out


def _gain(shared: np.ndarray, sizes: np.ndarray, at: np.ndarray, width: int, similarity: int) -> np.ndarray:
    """For each row of places, shared or not, the most that a stretch of width at least around the run at `at` can give to a passage.

    Two stretches with s shingles in common and d others on both sides are similar if
    (100 - similarity) * s >= similarity * d: half of the former for each side, less the latter on it, may sum up to 0.
    """
    score = np.where(shared, 100 - similarity, -2 * similarity).astype(np.int32)
    score[np.arange(score.shape[1]) >= sizes[:, None]] = -(1 << 20)
    sums = np.zeros((len(score), score.shape[1] + 1), np.int32)
    np.cumsum(score, axis=1, out=sums[:, 1:])
    best = np.maximum.accumulate(sums[:, ::-1], axis=1)[:, ::-1]  # the highest sum from here on
    starts = np.arange(max(0, score.shape[1] - width + 1))
    if not len(starts):
        return np.full(len(score), -(1 << 20))
    ends = np.minimum(np.maximum(at[:, None] + RUN, starts + width), score.shape[1])
    out = np.take_along_axis(best, ends, 1) - sums[:, starts]
    return np.where(starts <= at[:, None], out, -(1 << 20)).max(1)


_MEMBER = ["__band", "__id", "__root", "__at", "__lr", "__need", "__span"]


def _compared(left: DataFrame, right: DataFrame, keys: list[str], width: int, similarity: int) -> DataFrame:
    """__a, __b, __lr, __lr2 of passages between left and right in the groups by keys (__link), and __old, __new of the roots that they link (not __link)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["__id", "__at"], kind="stable")  # which links stand for a group mustn't depend on the order of arrival
        one, two = pdf[pdf["__left"]], pdf[~pdf["__left"]]
        out, up = similar_spans(one, two, width, similarity) if len(one) and len(two) else ([], {})
        rows = [(*x, 0, 0, True) for x in out] + [(0, 0, 0, 0, *x, False) for x in up.items()]
        return pd.DataFrame({c: pd.array([r[i] for r in rows], "int64" if i < 6 else bool) for i, c in enumerate(names)})

    names = ["__a", "__b", "__lr", "__lr2", "__old", "__new", "__link"]
    both = left.select(*_MEMBER, *keys[1:], F.lit(True).alias("__left")).unionByName(right.select(*_MEMBER, *keys[1:], F.lit(False).alias("__left")))
    # Without the exchange, all groups of a run would share the task of an earlier one by run.
    return both.repartition(*keys).groupBy(*keys).applyInPandas(run, "__a long, __b long, __lr long, __lr2 long, __old long, __new long, __link boolean")


def _pivoted(members: DataFrame, width: int, similarity: int, block: int, pivots: int = PIVOTS) -> DataFrame:
    """The members (with __few) of a run that have no root in common, `block` at a time, with some of its members: most find their root there."""
    k = F.ceil(F.col("__few") / F.lit(block)).cast("int")
    rank = F.row_number().over(Window.partitionBy("__band").orderBy(F.xxhash64("__node"), "__node"))
    some = members.withColumn("__rank", rank).filter(F.col("__rank") <= pivots)
    left = members.filter("__rest").withColumn("__i", F.pmod(F.xxhash64("__node"), k).cast("int"))
    return _compared(left, some.withColumn("__i", F.explode(F.sequence(F.lit(0), k - 1))), ["__band", "__i"], width, similarity)


def _blocks(members: DataFrame, width: int, similarity: int, block: int) -> DataFrame:
    """The members outside a run's largest root, dealt to blocks, with all members, dealt to blocks: each block against each in a group of its own."""
    k = lambda c: F.ceil(F.col(c) / F.lit(block)).cast("int")
    dealt = members.withColumns({"__i": F.pmod(F.xxhash64("__node"), k("__few")).cast("int"), "__j": F.pmod(F.xxhash64("__node"), k("__all")).cast("int")})
    left = dealt.filter("__rest").withColumn("__j", F.explode(F.sequence(F.lit(0), k("__all") - 1)))
    right = dealt.withColumn("__i", F.explode(F.sequence(F.lit(0), k("__few") - 1)))
    return _compared(left, right, ["__band", "__i", "__j"], width, similarity)


def regions(rects: np.ndarray, width: int, enough: int) -> list[tuple[int, int, int, int]]:
    """Regions (l, r, l2, r2), inclusive, that hold the rectangles supported by enough functions.

    rects: rows of function, l, r, l2, r2. A rectangle is supported by those that
    overlap it by width on both sides; one of NEAR needs no other.
    """
    rects = rects[np.argsort(rects[:, 1], kind="stable")]
    good = rects[:, 0] == NEAR
    for k in range(0, len(rects), 256):  # some rows with those that may overlap them
        f, l, r, l2, r2 = (x[:, None] for x in rects[k : k + 256].T)
        near = rects[(rects[:, 1] <= r.max()) & (rects[:, 2] >= l.min())]
        over = np.minimum(near[:, 2], r) - np.maximum(near[:, 1], l) + 1
        over2 = np.minimum(near[:, 4], r2) - np.maximum(near[:, 3], l2) + 1
        ok = (over >= width) & (over2 >= width)
        votes = sum((ok & (near[:, 0] == g)).any(1).astype(int) for g in np.unique(near[:, 0]))
        good[k : k + 256] |= votes >= enough
    return _covering(rects[good])


def _covering(rects: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Regions that hold the rectangles (rows of function, l, r, l2, r2, ordered by l); those that overlap share one."""
    out: list[list[int]] = []
    for _, l, r, l2, r2 in rects.tolist():
        for g in out:
            if l <= g[1] and l2 <= g[3] and g[2] <= r2:
                g[1], g[2], g[3] = max(g[1], r), min(g[2], l2), max(g[3], r2)
                break
        else:
            out.append([l, r, l2, r2])
    return [tuple(g) for g in out]


def _voted(rects: np.ndarray, sizes: np.ndarray, width: int, enough: int, most: int = 1 << 19) -> np.ndarray:
    """Which rectangles of many pairs, `sizes` of each one after another, are supported within their pair."""
    good = np.zeros(len(rects), bool)
    ends, squares = np.cumsum(sizes), np.cumsum(sizes * sizes)
    at = 0
    while at < len(sizes):  # some pairs at a time
        stop = max(at + 1, int(np.searchsorted(squares, (squares[at - 1] if at else 0) + most, "right")))
        base, some = ends[at] - sizes[at], sizes[at:stop]
        each = np.repeat(some, some)
        i = np.repeat(np.arange(len(each)), each)
        j = np.arange(len(i)) - np.repeat(np.cumsum(each) - each, each) + np.repeat(np.repeat(np.cumsum(some) - some, some), each)
        f, l, r, l2, r2 = np.ascontiguousarray(rects[base : ends[stop - 1]].T)
        ok = np.minimum(r[i], r[j]) - np.maximum(l[i], l[j]) + 1 >= width
        i, j = i[ok], j[ok]
        ok = np.minimum(r2[i], r2[j]) - np.maximum(l2[i], l2[j]) + 1 >= width
        votes = np.bincount(np.unique(i[ok] << 7 | f[j[ok]]) >> 7, minlength=len(each))
        good[base : ends[stop - 1]] = (votes >= enough) | (f == NEAR)
        at = stop
    return good


def _runs(places: np.ndarray, gap: int) -> list[tuple[int, int]]:
    if not len(places):
        return []
    cut = (places[1:] - places[:-1] > gap).nonzero()[0]
    return list(zip([int(places[0]), *places[cut + 1].tolist()], [*places[cut].tolist(), int(places[-1])]))


def passages(a: np.ndarray, b: np.ndarray, region: tuple[int, int, int, int], width: int, similarity: int) -> list[tuple[int, int, int, int, float]]:
    """start, end, start2, end2 (shingles, inclusive) and similarity of the passages of a region that pass on the full sets."""
    l, r, l2, r2 = region
    both = np.concatenate([a[l : r + 1], b[l2 : r2 + 1]])
    order, codes = np.argsort(both), np.zeros(len(both), np.int64)
    codes[order[1:]] = np.cumsum(both[order[1:]] != both[order[:-1]])
    x, y, most = codes[: r - l + 1], codes[r - l + 1 :], len(codes)

    def among(z: np.ndarray) -> np.ndarray:
        out = np.zeros(most, bool)
        out[z] = True
        return out

    out, long_y = [], None
    shared = among(y)[x].nonzero()[0]
    for s, e in _runs(shared, GAP):
        if e - s + 1 < width:
            continue
        known, mine = [], x[s : e + 1]
        for s2, e2 in _runs(among(mine)[y].nonzero()[0], GAP):
            if e2 - s2 + 1 < width:
                continue
            # Trim to what the two stretches share, then compare whole sets.
            theirs = among(y[s2 : e2 + 1])
            both = theirs[mine].nonzero()[0]
            p, q = s + both[0], s + both[-1]
            kept = among(x[p : q + 1])
            same, union = np.count_nonzero(kept & theirs), np.count_nonzero(kept | theirs)
            if q - p + 1 >= width and 100 * same >= similarity * union:
                out.append((int(l + p), int(l + q), l2 + s2, l2 + e2, same / union))
                known.append((int(p), int(q)))
        # What no stretch that is similar as a whole holds: its longest similar parts, then equal runs.
        for lo, hi in _left(s, e, known, width):
            if not _may_be_similar(_between(shared, lo, hi), width, similarity):
                continue
            for p, q, p2, q2, j in _similar_parts(x[lo : hi + 1], y, width, similarity):
                out.append((int(l + lo + p), int(l + lo + q), int(l2 + p2), int(l2 + q2), j))
                known.append((lo + p, lo + q))
        for lo, hi in _left(s, e, known, width):
            at = _between(shared, lo, hi)
            if not (at[width - 1 :] - at[: max(0, len(at) - width + 1)] == width - 1).any():
                continue  # not width shared ones in a row
            if long_y is None:
                long_y = np.unique(_long_runs(b[l2 : r2 + 1], width), return_index=True)
            out += [(l + p, l + q, l2 + p2, l2 + p2 + q - p, 1.0) for p, q, p2 in _equal_runs(a[l + lo : l + hi + 1], lo, width, *long_y)]
    return out


def _left(s: int, e: int, known: list[tuple[int, int]], width: int) -> list[tuple[int, int]]:
    """Stretches of width at least of s .. e that lie between those known."""
    out, at = [], s
    for p, q in [*sorted(known), (e + 1, e + 1)]:
        if p - at >= width:
            out.append((at, p - 1))
        at = max(at, q + 1)
    return out


def _between(places: np.ndarray, low: int, high: int) -> np.ndarray:
    i, j = np.searchsorted(places, (low, high + 1))
    return places[i:j]


def _may_be_similar(at: np.ndarray, width: int, similarity: int) -> bool:
    """Whether some stretch of width at least could reach the similarity, if the other text had what is shared (at the places at) and nothing else.

    The sum is that of _similar_parts. A chain has some of these places at most and loses on the other side too.
    """
    score = 100 * np.arange(len(at)) - similarity * (at - at[:1])
    high = np.maximum.accumulate(score[::-1])[::-1]
    end = np.searchsorted(at, at + (width - 1))
    end = end[end < len(at)]  # the first ones: at rises
    return bool((high[end] - score[: len(end)] >= similarity - 100).any())


def _chain(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in x with a place of the same code in y: of several, the one that goes on best from the place before."""
    order = np.argsort(y, kind="stable")
    sorted_y = y[order]
    low, high = np.searchsorted(sorted_y, x, "left"), np.searchsorted(sorted_y, x, "right")
    at = (high > low).nonzero()[0]
    low, high = low[at], high[at]
    where = order[low]
    many = (high - low > 1).nonzero()[0].tolist()
    if many:
        places, chosen, own = order.tolist(), where.tolist(), at.tolist()
        for k, i, j in zip(many, low[many].tolist(), high[many].tolist()):
            goal = own[k] + (chosen[k - 1] - own[k - 1] if k else 0)
            m = bisect_left(places, goal, i, j)  # equal codes keep their order: the nearest are those around it
            chosen[k] = places[m] if m == i or m < j and places[m] - goal < goal - places[m - 1] else places[m - 1]
        where = np.array(chosen)
    # Short strays from a diagonal that goes on after them count as not shared.
    while len(at):
        shifts = where - at
        cut = (np.abs(shifts[1:] - shifts[:-1]) > 2 * GAP).nonzero()[0] + 1
        short = ((cut[1:] - cut[:-1] <= GAP) & (np.abs(shifts[cut[:-1] - 1] - shifts[cut[1:]]) <= 2 * GAP)).nonzero()[0].tolist()
        if not short:
            break
        kept, last = np.ones(len(at), bool), -2
        for k in short:
            if k - 1 != last:  # of neighbours, every other one
                kept[cut[k] : cut[k + 1]] = False
                last = k
        at, where = at[kept], where[kept]
    return at, where


def _similar_parts(x: np.ndarray, y: np.ndarray, width: int, similarity: int) -> list[tuple[int, int, int, int, float]]:
    """Start, end, start2, end2 and similarity of the longest stretches of x, apart from each other, that reach the similarity with one of y.

    The codes that follow one another in both are a chain. same / (n + n2 - same) >= s means that
    (1 - s) * same >= s * (the codes not shared on both sides): in a sum that rises by the former and
    falls by the latter, the stretches that reach s are those that don't end below their start.
    """
    at, where = _chain(x, y)
    out, todo = [], []
    if len(at):
        steps, steps2 = at[1:] - at[:-1], where[1:] - where[:-1]
        cut = np.concatenate([[0], ((steps2 <= 0) | (steps2 > 4 * GAP) | (steps > 4 * GAP)).nonzero()[0] + 1, [len(at)]])
        long = at[cut[1:] - 1] - at[cut[:-1]] + 1 >= width
        todo = list(zip(cut[:-1][long].tolist(), cut[1:][long].tolist()))
        scores = (100 - similarity) * np.arange(len(at))
        scores[1:] -= similarity * np.cumsum(steps + steps2 - 2)
    while todo:
        i, j = todo.pop()
        if j - i < 2 or at[j - 1] - at[i] + 1 < width:
            continue
        score = scores[i:j]
        # The longest stretch k .. m with score[m] - score[k] + (100 - similarity) >= 0: ends by the highest score from there on.
        high = np.maximum.accumulate(score[::-1])[::-1]
        last = np.searchsorted(-high, -(score - (100 - similarity)), "right") - 1
        long = at[i + last] - at[i : j]
        k = int(np.argmax(long))
        m = i + int(last[k])
        k += i
        if at[m] - at[k] + 1 < width:
            continue
        p, q, p2, q2 = int(at[k]), int(at[m]), int(where[k]), int(where[m])
        one, two = set(x[p : q + 1].tolist()), set(y[p2 : q2 + 1].tolist())
        same = len(one & two)
        union = len(one) + len(two) - same
        if 100 * same >= similarity * union:
            out.append((p, q, p2, q2, same / union))
            todo += [(i, k), (m + 1, j)]
        elif m > k + 1:  # repeats inside it: its parts at the widest gap, and what lies beside it
            g = k + 1 + int(np.argmax(np.diff(at[k : m + 1]) + np.diff(where[k : m + 1])))
            todo += [(i, g), (g, j)]
    return out


def _equal_runs(x: np.ndarray, s: int, width: int, theirs: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int]]:
    """Stretches of x, which starts at s, whose every run of width is among theirs: start, end, where the first run starts there."""
    rx = _long_runs(x, width)
    at = np.minimum(np.searchsorted(theirs, rx), max(0, len(theirs) - 1))
    hits = np.flatnonzero(theirs[at] == rx) if len(theirs) else []
    return [(s + p, s + q + width - 1, int(first[at[p]])) for p, q in _runs(np.asarray(hits, np.int64), 1)]


def _long_runs(h: np.ndarray, width: int) -> np.ndarray:
    at = np.arange(max(0, len(h) - width + 1))
    return rolling.stretches(h, at, at + width)


def _digests(base: DataFrame, least: int) -> DataFrame:
    """__id, __same (digest of the text without white space), __n (words) of the texts of at least `least` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in by_bytes(b, 1):
                data, starts, stops, sizes = word_places(some.column(1))
                kept = data[~SPACE[data]].tobytes()  # all bytes of words
                ends = np.append(0, np.cumsum(stops - starts))[np.append(0, np.cumsum(sizes))]
                ok = np.flatnonzero(sizes >= least)
                same = [hashlib.sha256(kept[ends[i] : ends[i + 1]]).digest() for i in ok.tolist()]
                yield pa.RecordBatch.from_arrays([some.column(0).take(pa.array(ok)), pa.array(same, pa.binary()), pa.array(sizes[ok], pa.int64())], ["__id", "__same", "__n"])

    return base.mapInArrow(run, "__id long, __same binary, __n long")


def find(docs: DataFrame, words: int = WORDS, least: int = LEAST, similarity: int = SIMILARITY, hashes: int = HASHES, enough: int = ENOUGH, small: int = SMALL, few: int = FEW, block: int = BLOCK) -> DataFrame:
    """doc_id, twin_id, start, n_words, twin_start, twin_words, similarity, kind.

    kind `passage`: words start .. start + n_words - 1 of the document repeat in
    the twin, both the first documents of their class. kind `copy`: the document
    equals its class's first, twin_id.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("__id"), text_of().alias("__text")).filter("__id is not null")
    classes = materialise(_digests(base, least), "texts")
    firsts = classes.groupBy("__same").agg(F.min("__id").alias("__first"), F.count("*").alias("__k")).filter("__k > 1").drop("__k")
    copies = materialise(classes.join(firsts, "__same").filter("__id <> __first").select("__id", "__first", "__n").distinct(), "copies")
    texts, rows = _apart(base, copies)
    width = least - words + 1
    n = classes.agg(F.sum("__n")).first()[0] or 0
    parts = int(2 * hashes * n / width / KEYS) + 1  # a text of n words has about 2 n / width windows for a function
    parts = max(parts, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys = materialise(shared_keys(texts, words, least, hashes, parts), "keys")
    shared = materialise(windows(texts, keys, words, least, hashes, small), "windows")
    rare = shared.filter("__at is null").join(keys.filter(F.col("__m") <= small), "__key").drop("__at")
    runs = shared.filter("__at is not null")
    sizes = materialise(runs.groupBy("__key").agg(F.count("*").alias("__m")).filter("__m > 1"), "runs")
    common = runs.join(sizes.filter(F.col("__m") > few), "__key")
    rects = _paired(rare).unionByName(_paired(runs.join(sizes.filter(F.col("__m") <= few), "__key").drop("__at"))).unionByName(_starred(common), allowMissingColumns=True)
    stored = _stored(rows, least)
    checked = materialise(_checked(_supported(rects, width, enough), stored, words, least, similarity), "passages")
    found = checked.filter("kind = 'passage'")
    left = checked.filter("kind = 'open'").select(F.col("twin_id").alias("__key"), F.col("doc_id").alias("__id"), F.col("start").alias("__at"))
    if not left.isEmpty():
        spans = materialise(_spans(_crowded(common, left), stored, words, width, similarity), "spans")
        members = materialise(_promising(spans), "members")
        near = materialise(_pivoted(_sized(members), width, similarity, block), "pivoted")
        roots = materialise(near.filter("not __link").groupBy(F.col("__old").alias("__id")).agg(F.min("__new").alias("__root")), "roots")
        # Only what is compared again moves with its shingles.
        node = ["__band", "__id", "__at"]
        placed = near_dedup.relabel(members.select(*node, "__node", "__root").distinct(), "__root", near_dedup.relabel(roots, "__root", roots))
        again = members.select(*node, "__lr", "__need", "__span").join(near_dedup._crowded(placed), node)
        rects = near.unionByName(_blocks(again, width, similarity, block)).filter("__link").drop("__old", "__new", "__link")
        found = found.unionByName(_checked(_supported(rects, width, enough), stored, words, least, similarity)).distinct()
    zero, n = F.lit(0).cast("long"), F.col("__n")
    return found.unionByName(
        copies.select(F.col("__id").alias("doc_id"), F.col("__first").alias("twin_id"), zero.alias("start"), n.alias("n_words"), zero.alias("twin_start"), n.alias("twin_words"), F.lit(1.0).alias("similarity"), F.lit("copy").alias("kind"))
    )


def _apart(base: DataFrame, copies: DataFrame) -> tuple[Mapped, DataFrame]:
    """A map over the rows of base that are no copies, and these rows, of which Python sees the ids alone.

    A bitmap drops rows inside the map itself, so that a task needs one Python worker; what it can't
    rule out is joined once, and the few rows that are no copies after all are stored.
    """
    gone = bitmap.build(copies.select("__id"))
    rest = materialise(base.filter(bitmap.maybe(gone, "__id")).join(copies.select("__id").distinct(), "__id", "left_anti").select("__id", "__text"), "unsure")

    def mapped(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
        def sure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            slices = (some for b in batches for some in by_bytes(b, 1, SLICE))
            return run(b.filter(pa.array(~bitmap.test(gone.value, b.column(0).to_numpy()))) for b in slices)

        return base.select("__id", "__text").mapInArrow(sure, schema).unionByName(rest.mapInArrow(run, schema))

    return mapped, base.select("__id", "__text").filter(~bitmap.maybe(gone, "__id")).unionByName(rest)


def _stored(rows: DataFrame, least: int) -> DataFrame:
    """__id, __text of the texts that are no copies and long enough for a passage, stored in buckets by __id.

    Stretches are cut out of texts three times; from here on only what is wanted of them moves, not the texts.
    """
    spark = rows.sparkSession
    n, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"passages_texts_{uuid.uuid4().hex}"
    writer = rows.filter(F.char_length("__text") >= 2 * least - 1).repartition(n, "__id").write.format("parquet").option("compression", "zstd").option("path", f"{shared_dir(spark)}/llm-{name}")
    writer.bucketBy(n, "__id").saveAsTable(name)
    return spark.table(name)


def _supported(rects: DataFrame, width: int, enough: int) -> DataFrame:
    """__a, __b, __home, __regions (flat: l, r, l2, r2 of each), __runs (flat: run, its places) of the pairs of texts that have any; a pair's rectangles come one after another."""
    mask = (1 << 28) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []  # of the pair that may go on
        for b in batches:
            some = [pc.fill_null(b.column(i), -1).to_numpy() for i in range(8)]
            new = np.flatnonzero((some[0][1:] != some[0][:-1]) | (some[1][1:] != some[1][:-1])) + 1
            if held and len(some[0]) and (held[-1][0][-1], held[-1][1][-1]) != (some[0][0], some[1][0]):
                new = np.append(0, new)
            if len(new):
                yield joined([np.concatenate([*(h[i] for h in held), x[: new[-1]]]) for i, x in enumerate(some)])
                held = []
                some = [x[new[-1] :] for x in some]
            held.append(some)
        if held:
            yield joined([np.concatenate(x) for x in zip(*held)])

    def joined(columns: list[np.ndarray]) -> pa.RecordBatch:
        a, b, x, y, home, *runs = columns
        first = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(a)]
        starts, pair = np.flatnonzero(first), np.cumsum(first) - 1
        home = np.maximum.reduceat(home, starts) if len(starts) else home
        of = np.flatnonzero(runs[1] >= 0)
        held, bounds = np.stack([r[of] for r in runs], 1).ravel(), 3 * np.searchsorted(pair[of], np.arange(len(starts) + 1))
        order = np.lexsort((y, x, pair))
        x, y = x[order], y[order]
        once = np.append(True, (pair[1:] != pair[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1]))[: len(x)]
        x, y, pair = x[once], y[once], pair[once]
        rows = np.stack([x >> 56, x >> 28 & mask, x & mask, y >> 28 & mask, y & mask], 1)
        sizes = np.bincount(pair, minlength=len(starts))
        many = sizes > MANY  # these are compared one pair at a time
        good = np.ones(len(rows), bool)
        good[~many[pair]] = _voted(rows[~many[pair]], sizes[~many], width, enough)
        rows, pair = rows[good], pair[good]
        order = np.lexsort((rows[:, 1], pair))
        rows = rows[order]
        at = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])[: len(pair)])
        out = [(p, regions(r, width, enough) if many[p] else _covering(r)) for p, r in zip(pair[at].tolist(), np.split(rows, at[1:]))]
        out = [(p, g) for p, g in out if g]
        at, kind = np.array([starts[p] for p, _ in out], np.int64), pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(a[at]), pa.array(b[at]), pa.array(home[[p for p, _ in out]] if out else home[:0]), pa.array([[v for q in g for v in q] for _, g in out], kind), pa.array([held[bounds[p] : bounds[p + 1]] for p, _ in out], kind)], ["__a", "__b", "__home", "__regions", "__runs"])

    home = F.col("__home") if "__home" in rects.columns else F.xxhash64("__a", "__b").bitwiseAND(F.lit((1 << 48) - 1)).alias("__home")
    more = [F.col(c) if c in rects.columns else F.lit(None).cast("long").alias(c) for c in ("__key", "__x", "__y")]
    rows = rects.select("__a", "__b", "__lr", "__lr2", home, *more).repartition("__a", "__b").sortWithinPartitions("__a", "__b")
    return rows.mapInArrow(run, "__a long, __b long, __home long, __regions array<long>, __runs array<long>")


def _merged(stretches: list[int]) -> list[tuple[int, int]]:
    """First and last shingle of the stretches (packed), those that touch made one."""
    out: list[tuple[int, int]] = []
    for x in sorted(stretches):
        l, r = x >> 28, x & ((1 << 28) - 1)
        if out and l <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], r))
        else:
            out.append((l, r))
    return out


def _checked(supported: DataFrame, texts: DataFrame, words: int, least: int, similarity: int) -> DataFrame:
    """The passages of the pairs' regions, and rows of kind `open` (doc_id, run, start) for the runs of __b that none of them holds in both texts.

    A text's stretches are cut out once for each home, as shingle hashes, and meet the home's pairs there: no text
    is sent whole, and no stretch once for a pair. A home has the texts of one group, so its memory is bounded.
    """
    width = least - words + 1
    supported = materialise(supported, "regions")
    side = lambda text, i: supported.select(F.col(text).alias("__id"), "__home", F.explode(F.expr(f"transform(sequence(0, size(__regions) div 4 - 1), k -> shiftleft(__regions[4 * k + {i}], 28) | __regions[4 * k + {i + 1}])")).alias("__s"))
    wanted = side("__a", 0).unionByName(side("__b", 2)).groupBy("__id", "__home").agg(F.collect_set("__s").alias("__s"))
    lists = materialise(_listed(wanted.select("__id", F.struct("__home", "__s").alias("__x")), "__x"), "stretches")
    near = texts.join(lists.hint("shuffle_hash"), "__id").select("__id", "__w", "__text")
    names = ["__home", "__pair", "__a", "__b", "__list", "__runs", "__cut"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in by_bytes(batch, 2, SLICE >> 2):
                h, sizes = shingle_sequences(some.column(2), words)
                starts = (np.cumsum(sizes) - sizes).tolist()
                for id_, at, wanted in zip(some.column(0).to_pylist(), starts, some.column(1)):
                    homes, lists = wanted.values.flatten()
                    for k in range(0, len(homes), 256):
                        own = [_merged(x) for x in lists.slice(k, 256).to_pylist()]
                        n, none = len(own), pa.array([[]] * len(own), pa.list_(pa.int64()))
                        cuts = [b"".join(h[at + l : at + r + 1].tobytes() for l, r in x) for x in own]
                        packed = pa.array([[l << 28 | r for l, r in x] for x in own], pa.list_(pa.int64()))
                        yield pa.RecordBatch.from_arrays([homes.slice(k, 256), pa.array(np.zeros(n, bool)), pa.array(np.full(n, id_)), pa.array(np.zeros(n, np.int64)), packed, none, pa.array(cuts, pa.binary())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, home, held = [*[pa.int64()] * 6, pa.float64(), pa.string()], None, {}

        def stretch(text: int, l: int, r: int) -> np.ndarray:
            bounds, h = held[text]
            k = bisect_right(bounds[0], l) - 1
            at = bounds[1][k] + l - bounds[0][k]
            return h[at : at + r - l + 1]

        for batch in batches:
            for some in by_bytes(batch, 6, SLICE):
                for low in range(0, some.num_rows, 1024):
                    out = []
                    for at, pair, a, b, flat, runs, raw in zip(*(c.to_pylist() for c in some.slice(low, 1024).columns)):
                        if at != home:
                            home, held = at, {}
                        if not pair:
                            firsts = [x >> 28 for x in flat]
                            sizes = [(x & ((1 << 28) - 1)) - (x >> 28) + 1 for x in flat]
                            if 8 * sum(sizes) == len(raw):  # else another text under this id
                                held[a] = (firsts, [0, *accumulate(sizes)]), np.frombuffer(raw, np.uint64)
                            continue
                        known = len(out)
                        if a in held and b in held:
                            for l, r, l2, r2 in zip(*(flat[i::4] for i in range(4))):
                                for s, e, s2, e2, j in passages(stretch(a, l, r), stretch(b, l2, r2), (0, r - l, 0, r2 - l2), width, similarity):
                                    out.append((a, b, l + s, e - s + words, l2 + s2, e2 - s2 + words, j, "passage"))
                        for key, p, q in zip(runs[::3], runs[1::3], runs[2::3]):
                            if not any(o[2] <= p <= o[2] + o[3] - words and o[4] <= q <= o[4] + o[5] - words for o in out[known:]):
                                out.append((b, key, q, 0, 0, 0, 0.0, "open"))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 8, kinds)], result)

    result = ["doc_id", "twin_id", "start", "n_words", "twin_start", "twin_words", "similarity", "kind"]
    cuts = near.mapInArrow(cut, "__home long, __pair boolean, __a long, __b long, __list array<long>, __runs array<long>, __cut binary")
    pairs = supported.select("__home", F.lit(True).alias("__pair"), "__a", "__b", F.col("__regions").alias("__list"), "__runs", F.lit(None).cast("binary").alias("__cut"))
    both = cuts.unionByName(pairs).repartition("__home").sortWithinPartitions("__home", "__pair", "__a", "__b")
    return both.mapInArrow(run, "doc_id long, twin_id long, start long, n_words long, twin_start long, twin_words long, similarity double, kind string")


def groups(found: DataFrame) -> DataFrame:
    """doc_id, group_id of the documents that find tells of: the smallest doc_id that passages and copies lead to.

    Links of a large group connect its members without naming every pair; a group's members have its group_id in common.
    """
    links = found.select(F.col("doc_id").alias("__a"), F.col("twin_id").alias("__b"))
    members = links.select(F.col("__a").alias("doc_id")).union(links.select("__b")).distinct()
    return near_dedup.relabel(members.withColumn("group_id", F.col("doc_id")), "group_id", near_dedup.components(links))


def query(spark, sf_dir: str) -> DataFrame:
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
