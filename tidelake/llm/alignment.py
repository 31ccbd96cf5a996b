"""Cross-tokenizer alignment by the tokenizers' spans.

Tokenizer A (byte-level BPE) reads a space and the text, tokenizer B (pieces with byte
fallback) the text, to which it adds that space. The character offsets of A's tokens
and the byte spans of B's are coarse cuts: they tell which unit of the text a token
belongs to, also where a character is split into several tokens that share its span.
Inside a unit the tokens' decoded bytes refine them to exact byte ranges, and must give
the unit's bytes again. Offsets at which tokens of both end cut the tokens into groups;
within a group each of A's is linked with each of B's.

A unit is a run of spaces and line ends with the letters after it, or the marks that
follow the letters. No token of either vocabulary reaches over a unit's start (checked
for B's vocabulary when it is loaded; A splits there by its pattern), so units align by
themselves: a worker remembers units, encodes new ones in bulk and sums what it knows.
Texts with other white space, U+2581 or a unit that doesn't decode to itself are one
unit as a whole.

1. A map over the texts gives each one's sums and its distinct id pairs; it is written.
2. Tasks count the documents of each pair over many rows before Spark adds them up; the
   best count of each A id follows.
3. Up to `SENT` distinct pairs (counted first) are broadcast and a map scores the
   documents; more of them meet the documents' pairs in a shuffled join.

Defined cases: null or empty text, or text that either tokenizer doesn't give back byte
for byte, has no tokens: zeros and ''; repeated rows count as documents of their own; a
null doc_id stays null; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.base import by_bytes, materialise, text_of
from tidelake.llm.packing import PLAIN

#: Units and distinct pairs that a worker remembers; new units encoded at once; distinct pairs that may be broadcast; counts held by a task.
REMEMBERED, NUMBERED, CHUNK, SENT, HELD = 200_000, 1_000_000, 2000, 2_000_000, 4_000_000
SLICE, MARKS = 2 << 20, ".,!?;:#$%&*|"
#: Bits of B's id in a pair.
SHIFT = 20
#: White space other than space and line end, characters that some tables count as such, and B's sign for a space.
ODD = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u180e\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u200b\u2028\u2029\u202f\u205f\u3000\ufeff\u2581"

#: Those of them above ASCII need no look in a text of ASCII.
_PLAIN_ODD = [c for c in ODD if c.isascii()]

_aligners: dict[tuple[str, str], Aligner] = {}


def byte_of() -> dict[str, int]:
    """The byte for which each character of a byte-level vocabulary stands: printable Latin-1 stands for itself, the rest follows from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def _odd(text: str) -> bool:
    return any(c in text for c in (_PLAIN_ODD if text.isascii() else ODD))


class Grown:
    """A numpy array that grows at its end."""

    def __init__(self, kind):
        self.data, self.n = np.zeros(1 << 12, kind), 0

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.data):
            self.data = np.concatenate([self.data[: self.n], np.zeros(max(len(self.data), len(more)), self.data.dtype)])
        self.data[self.n : self.n + len(more)] = more
        self.n += len(more)


class Aligner:
    """Both tokenizers, and what is known of units."""

    def __init__(self, path_a: str, path_b: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker for each core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        from tokenizers.processors import ByteLevel

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.post_processor = ByteLevel(trim_offsets=False)
        self.b = SentencePieceProcessor(model_file=path_b)
        table, n = byte_of(), max(self.a.get_vocab().values()) + 1
        self.bytes_a: list[bytes] = [b""] * n
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in y], np.int64) for y in (self.bytes_a, self.bytes_b))
        self.names = [str(i) for i in range(max(n, len(pieces)))]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("a piece reaches over a space")
        both = re.compile(f"[{PLAIN}]([{re.escape(MARKS)}])")
        joined = {m for i, p in enumerate(pieces) if not self.b.is_byte(i) and not self.b.is_control(i) for m in both.findall(p)}
        marks = re.escape("".join(m for m in MARKS if m not in joined)) or "\n"
        self.units = re.compile(f"[ \n]+[{PLAIN}]++(?=[{marks}])|[ \n]+[^ \n]*|[{marks}][^ \n]*").findall
        self.remembered = remembered
        self.clear()

    def clear(self) -> None:
        """Forgets all units and pairs."""
        self.known: dict[str, int] = {}
        #: Of each unit: tokens of A, of B, groups, links, whether it decodes to itself; where its pairs start.
        self.facts = [Grown(np.int64) for _ in range(5)]
        #: Pairs are numbered as they are met: numbers by pair, pairs by number.
        self.numbers: dict[int, int] = {}
        self.values = Grown(np.int64)
        self.starts, self.pairs, self.times = Grown(np.int64), Grown(np.int32), Grown(np.int64)
        self.starts.add(np.zeros(1, np.int64))
        self.groups: list[bytes] = []

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A's ids and the characters where they start, B's ids and the bytes where they start."""
        e = self.a.encode(text, add_special_tokens=False)
        spans = self.b.encode(text, return_type="proto").pieces
        got = np.array([(p.id, p.begin) for p in spans], np.int64).reshape(-1, 2)
        return np.array(e.ids, np.int64), np.fromiter((o[0] for o in e.offsets), np.int64, len(e.ids)), got[:, 0], got[:, 1]

    def learn(self, units: list[str]) -> None:
        for k in range(0, len(units), CHUNK):
            self._learn(units[k : k + CHUNK])

    def _learn(self, units: list[str]) -> None:
        """Adds the units, in order. An x stands before them all, a line end before a unit that starts without white space: nothing reaches over either."""
        parts, owner = ["x"], [-1]
        for k, u in enumerate(units):
            if u[0] not in " \n":
                parts.append("\n")
                owner.append(-1)
            parts.append(u)
            owner.append(k)
        text, raw = "".join(parts), [p.encode() for p in parts]
        owner = np.array(owner)
        chars = np.cumsum([0, *map(len, parts)])
        ends = np.cumsum([0, *map(len, raw)])
        ids_a, from_a, ids_b, from_b = self.encode(text)
        ids_b, from_b = ids_b.copy(), from_b.copy()
        part_a = np.searchsorted(chars, from_a, "right") - 1  # the coarse cut
        part_b = np.searchsorted(ends, from_b, "right") - 1
        size_a, size_b = self.sizes_a[ids_a], self.sizes_b[ids_b]
        size_b[:1] -= 1  # the space that B adds before the x
        whole = b"".join(raw)
        same = np.array_equal(np.bincount(part_a, size_a, len(raw)), np.diff(ends)) and np.array_equal(np.bincount(part_b, size_b, len(raw)), np.diff(ends))
        same = same and b"".join(map(self.bytes_a.__getitem__, ids_a.tolist())) == whole and b"".join(map(self.bytes_b.__getitem__, ids_b.tolist())) == b" " + whole
        if not same:
            if len(units) > 1:
                self._learn(units[: len(units) // 2])
                self._learn(units[len(units) // 2 :])
            else:
                self._add(np.zeros((5, 1), np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), [b""])
            return
        end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)  # the refined cuts
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        n = len(cuts)
        many_a, many_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        unit = owner[np.searchsorted(ends, cuts, "left") - 1]
        real = unit >= 0
        facts = np.array([*(np.bincount(unit[real], x[real], len(units)).astype(np.int64) for x in (many_a, many_b, np.ones(n), many_a * many_b)), np.ones(len(units), np.int64)])
        a, b, group, times = _linked(ids_a, ids_b, group_a, group_b, many_a, many_b)
        keep = real[group]
        per = np.bincount(unit[group[keep]], minlength=len(units))
        stop_a, stop_b = np.cumsum(many_a).tolist(), np.cumsum(many_b).tolist()
        names_a, names_b = ([self.names[i] for i in x.tolist()] for x in (ids_a, ids_b))
        told: list[list[str]] = [[] for _ in units]
        i = j = 0
        for k, ia, ib in zip(unit.tolist(), stop_a, stop_b):
            if k >= 0:
                told[k].append((names_a[i] if ia == i + 1 else ",".join(names_a[i:ia])) + "|" + (names_b[j] if ib == j + 1 else ",".join(names_b[j:ib])))
            i, j = ia, ib
        self._add(facts, per, (a << SHIFT | b)[keep], times[keep], [";".join(x).encode() for x in told])

    def _add(self, facts, per, pairs, times, groups) -> None:
        for to, more in zip(self.facts, facts):
            to.add(more)
        self.starts.add(self.starts.data[self.starts.n - 1] + np.cumsum(per))
        met, back = np.unique(pairs, return_inverse=True)
        new = [p for p in met.tolist() if p not in self.numbers]
        self.numbers.update(zip(new, range(len(self.numbers), len(self.numbers) + len(new))))
        self.values.add(np.array(new, np.int64))
        pairs = np.fromiter(map(self.numbers.__getitem__, met.tolist()), np.int64, len(met))[back] if len(met) else pairs
        self.pairs.add(pairs)
        self.times.add(times)
        self.groups += groups

    def forget(self, n: int) -> None:
        """Leaves the first n units."""
        for x in self.facts:
            x.n = n
        self.starts.n = n + 1
        self.pairs.n = self.times.n = int(self.starts.data[n])
        del self.groups[n:]

    def align(self, texts: list[str], whole: bool = False) -> dict:
        """The texts' facts, group texts, and distinct pairs with how often each is linked (one text's after another's, `ends`)."""
        flat: list[str] = []
        sizes, alone = [], []
        for t in texts:
            if not t:
                sizes.append(0)
            elif whole or _odd(t):
                alone.append(len(flat))
                flat.append(" " + t)
                sizes.append(1)
            else:
                found = self.units(" " + t)
                flat += found
                sizes.append(len(found))
        had = len(self.groups)
        lone = set(alone)
        codes = [None if i in lone else c for i, c in enumerate(map(self.known.get, flat))] if lone else list(map(self.known.get, flat))
        new = list(dict.fromkeys(u for i, (u, c) in enumerate(zip(flat, codes)) if c is None and i not in lone)) if lone else list(dict.fromkeys(u for u, c in zip(flat, codes) if c is None))
        self.learn(new)
        self.known.update(zip(new, range(had, had + len(new))))
        for k, i in enumerate(alone):
            self._learn([flat[i]])
            codes[i] = had + len(new) + k
        if new:
            codes = [self.known[u] if c is None else c for u, c in zip(flat, codes)]
        out = self._summed(np.array(codes, np.int64), np.array(sizes, np.int64))
        stays = had + len(new) if had + len(new) <= self.remembered else had
        if stays == had:
            for u in new:
                del self.known[u]
        self.forget(stays)
        if len(self.numbers) > NUMBERED:
            self.clear()
        if not whole and not out["same"].all():
            out = self._again(texts, out)
        return out

    def _again(self, texts: list[str], out: dict) -> dict:
        """Texts with a unit that doesn't decode to itself, read as a whole."""
        bad = np.flatnonzero(~out["same"])
        more = self.align([texts[i] for i in bad], whole=True)
        pieces = [[x[a:b] for a, b in zip([0, *o["ends"][:-1]], o["ends"])] for o in (out, more) for x in (o["pairs"], o["times"])]
        for k, i in enumerate(bad.tolist()):
            for name in ("a", "b", "groups", "links", "same"):
                out[name][i] = more[name][k]
            out["told"][i] = more["told"][k]
            pieces[0][i], pieces[1][i] = pieces[2][k], pieces[3][k]
        out["ends"] = np.cumsum([len(x) for x in pieces[0]])
        return out | {"pairs": np.concatenate(pieces[0]), "times": np.concatenate(pieces[1])}

    def _summed(self, codes: np.ndarray, sizes: np.ndarray) -> dict:
        n = len(sizes)
        owner = np.repeat(np.arange(n), sizes)
        sums = [np.bincount(owner, x.data[codes], n).astype(np.int64) for x in self.facts]
        same = sums[4] == sizes
        stops = np.cumsum(sizes).tolist()
        each = codes.tolist()
        told = [b";".join(map(self.groups.__getitem__, each[a:b])) if ok else b"" for a, b, ok in zip([0, *stops], stops, same.tolist())]
        # Distinct units of each text, then the distinct pairs of those.
        key = owner * (len(self.groups) + 1) + codes
        key, often = np.unique(key, return_counts=True)
        owner, codes = key // (len(self.groups) + 1), key % (len(self.groups) + 1)
        often, owner, codes = (x[same[owner]] for x in (often, owner, codes))
        first, many = self.starts.data[codes], self.starts.data[codes + 1] - self.starts.data[codes]
        at = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        pairs, times = self.pairs.data[at], self.times.data[at] * np.repeat(often, many)
        width = len(self.numbers) + 1
        key = np.repeat(owner, many) * width + pairs
        if int(times.max(initial=0)) < 1 << 16 and n * width < 1 << 46:  # sorting one number is far faster than ordering two
            key = np.sort(key << 16 | times)
            key, times = key >> 16, key & 0xFFFF
        else:
            order = np.argsort(key, kind="stable")
            key, times = key[order], times[order]
        heads = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        times = np.add.reduceat(times, heads) if len(heads) else times
        key = key[heads]
        ends = np.searchsorted(key, (np.arange(n) + 1) * width)
        empty = ~same
        for x in sums[:4]:
            x[empty] = 0
        return dict(zip(("a", "b", "groups", "links"), sums)) | {"same": same, "told": told, "pairs": self.values.data[key % width], "times": times, "ends": ends}


def _linked(ids_a, ids_b, group_a, group_b, many_a, many_b):
    """Pairs of linked ids: a, b, group, and how often. In groups with far more links than tokens, equal ids are counted first."""
    times_a, times_b = np.ones(len(ids_a), np.int64), np.ones(len(ids_b), np.int64)
    if int((many_a * many_b).sum()) > 8 * (len(ids_a) + len(ids_b)) + 1000:
        (ids_a, group_a, times_a), (ids_b, group_b, times_b) = (_counted(*x) for x in ((ids_a, group_a), (ids_b, group_b)))
        many_b = np.bincount(group_b, minlength=len(many_b))
    start_b = np.cumsum(many_b) - many_b
    n = many_b[group_a]
    row = np.repeat(np.arange(len(ids_a)), n)
    other = np.repeat(start_b[group_a] - (np.cumsum(n) - n), n) + np.arange(len(row))
    return ids_a[row], ids_b[other], group_a[row], times_a[row] * times_b[other]


def _counted(ids: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key, n = np.unique(groups << 32 | ids, return_counts=True)
    return key & 0xFFFFFFFF, key >> 32, n


def aligner(path_a: str, path_b: str) -> Aligner:
    """This worker's aligner; it outlives tasks."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


def align(docs: DataFrame, path_a: str, path_b: str, groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs (A's id times 2^20 plus B's), times (links of each pair) of each row; groups: also their text."""
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"] + ["groups"] * groups

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        for batch in batches:
            for some in by_bytes(batch, 1, SLICE):
                got = own.align(some.column(1).to_pylist())
                digests = [hashlib.sha256(x).hexdigest() if x else "" for x in got["told"]]
                at = pa.array(np.append(0, got["ends"]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(at, pa.array(got[k])) for k in ("pairs", "times")]
                more = [pa.array([x.decode() for x in got["told"]], pa.string())] * groups
                yield pa.RecordBatch.from_arrays([some.column(0), *(pa.array(got[k]) for k in ("a", "b", "groups", "links")), pa.array(digests, pa.string()), *lists, *more], names)

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>" + ", groups string" * groups
    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, schema)


def pair_counts(rows: DataFrame, held: int = HELD) -> DataFrame:
    """pair, n: how many rows hold each pair; best: whether no pair of its A id is in more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def told():
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["pair", "n"])

        for batch in batches:
            new, n = np.unique(batch.column(0).flatten().to_numpy(), return_counts=True)
            keys, back = np.unique(np.concatenate([keys, new]), return_inverse=True)
            counts = np.bincount(back, np.concatenate([counts, n]), len(keys)).astype(np.int64)
            if len(keys) > held:
                yield told()
                keys, counts = keys[:0], counts[:0]
        if len(keys):
            yield told()

    n = materialise(rows.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    own = n.withColumn("__a", F.shiftright("pair", SHIFT))
    most = own.groupBy("__a").agg(F.max("n").alias("__most"))
    return own.join(most, "__a").select("pair", "n", (F.col("n") == F.col("__most")).alias("best"))


def score(rows: DataFrame, counts: DataFrame, sent: int = SENT) -> DataFrame:
    """rows with n_best and count_sum in place of pairs and times. rows are a stored table: they are read twice."""
    rest = [c for c in rows.columns if c not in ("pairs", "times")]
    if counts.count() <= sent:
        table = counts.toArrow().sort_by("pair")
        parts = rows.sparkSession.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("pair", "n", "best")))
        at = len(rest)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pairs, n, best = parts.value
            for b in batches:
                ends = np.cumsum(np.append(0, b.column(at).value_lengths().to_numpy()))
                times, place = b.column(at + 1).flatten().to_numpy(), np.searchsorted(pairs, b.column(at).flatten().to_numpy())
                sums = [np.diff(np.append(0, np.cumsum(times * x[place]))[ends]).astype(np.int64) for x in (best, n)]
                yield pa.RecordBatch.from_arrays([*b.columns[:at], *map(pa.array, sums)], [*rest, "n_best", "count_sum"])

        return rows.select(*rest, "pairs", "times").mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n in rest) + ", n_best long, count_sum long")
    each = rows.select("__row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("__row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    sums = each.join(counts, "pair").groupBy("__row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    return rows.select(*rest).join(sums, "__row", "left").fillna(0, ["n_best", "count_sum"])


def query(spark, sf_dir: str, path_a: str | None = None, path_b: str | None = None, sent: int = SENT) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = align(docs, path_a or str(public_tokenizers.path("byte_bpe_50k.json")), path_b or str(public_tokenizers.path("piece_bpe_32k.model")))
    rows = materialise(rows.withColumn("__row", F.monotonically_increasing_id()), "aligned")
    return score(rows, pair_counts(rows), sent).drop("__row")
