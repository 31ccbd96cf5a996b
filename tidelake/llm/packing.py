"""Packing by concatenate and cut.

Documents stand one after another, each as its token ids and an end id, and the
stream is cut into windows of `width` tokens. Pass 1 tokenises once, writes the
ids to the shared folder and numbers tokens inside each partition; prefix sums
over the partitions' totals (one number for each partition) give every partition
its place in the stream; pass 2 cuts each document at the window boundaries it
crosses, so no row ever meets another.

Defined cases: null or empty text is the end id alone; repeated rows are packed
as often as they occur; ids may be null; other columns are ignored, whatever their
names; an empty table gives no pieces.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.base import by_bytes, materialise, split_words, text_of

WIDTH, END_ID = 2048, 1
#: Words whose ids a worker remembers; later words are encoded batch by batch.
REMEMBERED = 150_000

#: Letters, for a regular expression, that stay one letter in lower case and in any normal form next to plain letters and ASCII marks.
PLAIN = "A-Za-zÀ-ÖØ-öø-įı-ɏΑ-ΡΣ-Ωα-ωЀ-џ"
_LETTERS = re.compile(f"[{PLAIN}]+")

_tokenizers: dict[str, WordEncoder] = {}


class WordEncoder:
    """A tokenizer that drops white space, applied word by word.

    Such a tokenizer never merges over white space, so the ids of a text are
    those of its words in order; a word is encoded once for many texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.kind = "<u2" if max(vocab.values()) < 1 << 16 else "<u4"
        self.last = np.zeros(max(vocab.values()) + 1, bool)  # ids that end a run of letters
        self.last[[i for piece, i in vocab.items() if piece.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and ids per text."""
        # ASCII marks between a plain letter or digit and a word's end are a piece of their own.
        words, codes, sizes = split_words(pc.replace_substring_regex(texts, f"([0-9{PLAIN}])([.,;:!?*#$%&]+)(\\s|$)", r"\1 \2 \3"))
        # ASCII letters count in lower case, but for the names of special tokens.
        given = pa.array(words, pa.string())
        low = pc.if_else(pc.match_substring(given, "<|"), given, pc.ascii_lower(given)).dictionary_encode()
        words, codes = low.dictionary.to_pylist(), low.indices.to_numpy()[codes]
        new = self._learn([w for w in words if w not in self.known])
        each = [self.known[w] for w in words]
        if len(self.known) > REMEMBERED:
            for w in new:
                del self.known[w]
        flat = np.frombuffer(b"".join(each), self.kind)
        count = np.array([len(x) for x in each], np.int32) // flat.itemsize
        n = count[codes]
        ends = np.cumsum(n)
        at = np.repeat((np.cumsum(count, dtype=np.int32) - count)[codes] - (ends - n).astype(np.int32), n)
        at += np.arange(len(at), dtype=np.int32)
        stops = np.append(0, ends)[np.cumsum(sizes)]
        return flat[at], np.diff(stops, prepend=0)

    def _learn(self, words: list[str]) -> list[str]:
        """Adds the words to those known."""
        runs = [w for w in words if _LETTERS.fullmatch(w)]
        for k in range(0, len(runs), 4096):
            self._learn_letters(runs[k : k + 4096])
        self._learn_each([w for w in words if w not in self.known])
        return words

    def _learn_letters(self, runs: list[str]) -> None:
        """Runs of plain letters, encoded as one text: each ends at an id that ends a word."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(runs)], add_special_tokens=False)[0].ids, self.kind)
        ends = (np.flatnonzero(self.last[ids]) + 1) * ids.itemsize
        if len(ends) != len(runs):
            return self._learn_each(runs)
        raw, stops = ids.tobytes(), ends.tolist()
        self.known.update(zip(runs, (raw[a:b] for a, b in zip([0, *stops], stops))))

    def _learn_each(self, words: list[str]) -> None:
        for word, found in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False), strict=True):
            self.known[word] = np.array(found.ids, self.kind).tobytes()


def encoder(path: str) -> WordEncoder:
    """This worker's encoder for the file; it outlives tasks."""
    if path not in _tokenizers:
        _tokenizers[path] = WordEncoder(path)
    return _tokenizers[path]


def tokenise(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, ids (binary), doc_tokens, __part, __at: tokens before it in its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, enc = TaskContext.get().partitionId(), 0, encoder(path)
        end, size = np.array([end_id], enc.kind).tobytes(), int(enc.kind[2])
        for batch in batches:
            for some in by_bytes(batch, 1):
                flat, sizes = enc.encode(some.column(1))
                stops = np.cumsum(sizes)
                raw, ends = flat.tobytes(), (stops * size).tolist()
                ids = [raw[a:b] + end for a, b in zip([0, *ends], ends)]
                starts = at + stops - sizes + np.arange(len(ids))
                at += len(flat) + len(ids)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(ids, pa.binary()), pa.array(sizes + 1), pa.array(np.full(len(ids), part, np.int32)), pa.array(starts)],
                    ["doc_id", "ids", "doc_tokens", "__part", "__at"],
                )

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, "doc_id long, ids binary, doc_tokens long, __part int, __at long")


def pack(docs: DataFrame, path: str, width: int = WIDTH, end_id: int = END_ID) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids (little-endian unsigned
    32-bit, as binary), doc_tokens, sequence_id, offset, padded_length.

    padded_length is the length of the piece's sequence once padded: the width,
    but a sequence whose length is a power of two stays as it is. Only the last
    sequence can be short.
    """
    kind = encoder(path).kind
    rows = materialise(tokenise(docs, path, end_id), "tokens")
    totals = {r["__part"]: r["n"] for r in rows.groupBy("__part").agg(F.sum("doc_tokens").alias("n")).collect()}
    places = dict(zip(sorted(totals), accumulate((totals[k] for k in sorted(totals)), initial=0)))
    whole, rest = divmod(sum(totals.values()), width)
    last = rest if rest & (rest - 1) == 0 else width
    placed = rows.sparkSession.sparkContext.broadcast(places)  # a number for each partition

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in by_bytes(batch, 1):
                yield cut(some)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.column(2).to_numpy()
        at = batch.column(4).to_numpy() + np.array([placed.value[p] for p in batch.column(3).to_pylist()], np.int64)
        first, stop = at // width, (at + n - 1) // width + 1
        row = np.repeat(np.arange(len(n)), stop - first)
        seq = np.arange(len(row)) - np.repeat(np.cumsum(stop - first) - (stop - first), stop - first) + first[row]
        low, high = np.maximum(at[row], seq * width), np.minimum(at[row] + n[row], (seq + 1) * width)
        start, length = low - at[row], high - low
        ids = [np.frombuffer(x, kind).astype("<u4") for x in batch.column(1).to_pylist()]
        pieces = [ids[r][s : s + m].tobytes() for r, s, m in zip(row.tolist(), start.tolist(), length.tolist())]
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(row)), pa.array(start), pa.array(length), pa.array(pieces, pa.binary()), pa.array(n[row]), pa.array(seq), pa.array(low - seq * width), pa.array(np.where(seq < whole, width, last))],
            ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "padded_length"],
        )

    return rows.mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, padded_length long")


def sequences(pieces: DataFrame, pad_id: int = 0) -> DataFrame:
    """sequence_id, ids: each sequence's pieces in order, padded to padded_length.

    A group is one window, so its size is bounded by the width.
    """

    def join(pdf):
        pdf = pdf.sort_values("offset")
        ids = np.frombuffer(b"".join(pdf["ids"]), "<u4")
        full = np.full(int(pdf["padded_length"].iloc[0]), pad_id, "<u4")
        full[: len(ids)] = ids
        return pdf.head(1)[["sequence_id"]].assign(ids=[full.astype(np.int64).tolist()])

    return pieces.groupBy("sequence_id").applyInPandas(join, "sequence_id long, ids array<long>")


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded_length")


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def query(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    return digests(pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), path or tokenizer_path()))
