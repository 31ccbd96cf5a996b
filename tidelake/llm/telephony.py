"""Media columns of telephony audio.

WAV bytes with mu-law, A-law or IMA ADPCM samples are read back into 16-bit PCM:
the two laws by lookup tables of 256 entries, ADPCM sample by sample with numpy
across all blocks of a batch at once. The PCM is resampled and stored as 16-bit
PCM WAV. Everything is a map over rows, about `SLICE` bytes of media at a time.

Defined cases: null or empty text is a payload of one unit of spaces; null media
gives null PCM and feature; columns named as those made here are replaced; equal texts give equal results; repeated rows and null ids are
rows like others; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.base import by_bytes, materialise, text_of

UNIT, RATE, PCM_RATE, SLICE = 192, 8000, 16000, 1 << 19
PCM, ALAW, ULAW, ADPCM = 1, 6, 7, 17  # format numbers of WAV files

# Fixed values of IMA ADPCM: step sizes, and moves of the step index by code.
STEPS = np.array(
    [7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767],
    np.int32,
)
MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8] * 2, np.int32)


def _ulaw_table() -> np.ndarray:
    c = ~np.arange(256) & 0xFF
    size = (((c & 15) << 3) + 132 << (c >> 4 & 7)) - 132
    return np.where(c & 128, -size, size).astype(np.int16)


def _alaw_table() -> np.ndarray:
    c = np.arange(256) ^ 0x55
    seg, low = c >> 4 & 7, (c & 15) << 4
    size = np.where(seg == 0, low + 8, (low + 264) << np.maximum(seg - 1, 0))
    return np.where(c & 128, size, -size).astype(np.int16)


ULAW_TABLE, ALAW_TABLE = _ulaw_table(), _alaw_table()


def wav(data: bytes, kind: int, rate: int = RATE, block: int = 1) -> bytes:
    """A mono WAV file of the encoded samples in data."""
    bits = {PCM: 16, ADPCM: 4}.get(kind, 8)
    align = {PCM: 2, ADPCM: block}.get(kind, 1)
    per_block = (block - 4) * 2 + 1
    count = {PCM: len(data) // 2, ADPCM: len(data) // max(block, 1) * per_block}.get(kind, len(data))
    each = rate * align // (per_block if kind == ADPCM else 1)
    fmt = struct.pack("<HHIIHH", kind, 1, rate, each, align, bits)
    fmt += b"" if kind == PCM else struct.pack("<HH", 2, per_block) if kind == ADPCM else struct.pack("<H", 0)
    chunks = [(b"fmt ", fmt), *([] if kind == PCM else [(b"fact", struct.pack("<I", count))]), (b"data", data)]
    body = b"WAVE" + b"".join(k + struct.pack("<I", len(v)) + v + b"\0" * (len(v) % 2) for k, v in chunks)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def read_wav(media: bytes) -> tuple[int, int, int, bytes]:
    """Format number, sample rate, block size and sample bytes of a WAV file."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, fmt = 12, None
    while at + 8 <= len(media):
        name, n = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            fmt = struct.unpack_from("<HHIIHH", media, at + 8)
        elif name == b"data" and fmt:
            return fmt[0], fmt[2], fmt[4], media[at + 8 : at + 8 + n]
        at += 8 + n + n % 2
    raise ValueError("a WAV file without samples")


def adpcm_blocks(blocks: np.ndarray) -> np.ndarray:
    """PCM of ADPCM blocks, a row each: (n, size) bytes to (n, (size - 4) * 2 + 1) samples."""
    raw = blocks.astype(np.int32)
    value = (raw[:, 0] | raw[:, 1] << 8).astype(np.int16).astype(np.int32)
    index = np.minimum(raw[:, 2], len(STEPS) - 1)
    codes = np.stack([raw[:, 4:] & 15, raw[:, 4:] >> 4], 2).reshape(len(raw), -1).T.copy()
    out = np.empty((len(codes) + 1, len(raw)), np.int16)
    out[0] = value
    for t, code in enumerate(codes):
        step = STEPS[index]
        move = (step >> 3) + (step & -(code >> 2 & 1)) + (step >> 1 & -(code >> 1 & 1)) + (step >> 2 & -(code & 1))
        value = np.clip(value + np.where(code & 8, -move, move), -32768, 32767)
        index = np.clip(index + MOVES[code], 0, len(STEPS) - 1)
        out[t + 1] = value
    return out.T


def decode(files: list[tuple[int, int, bytes]]) -> list[np.ndarray]:
    """PCM of each (format, block size, sample bytes); the ADPCM blocks of one size are decoded together."""
    out: list[np.ndarray | None] = [None] * len(files)
    blocks: dict[int, list[int]] = {}
    for i, (kind, block, data) in enumerate(files):
        codes = np.frombuffer(data, np.uint8)
        if kind == ULAW:
            out[i] = ULAW_TABLE[codes]
        elif kind == ALAW:
            out[i] = ALAW_TABLE[codes]
        elif kind == PCM:
            out[i] = np.frombuffer(data, "<i2").astype(np.int16)
        elif kind == ADPCM and block > 4:
            blocks.setdefault(block, []).append(i)
        else:
            raise ValueError(f"no decoder for format {kind}")
    for block, which in blocks.items():
        each = [len(files[i][2]) // block for i in which]
        whole = np.concatenate([np.frombuffer(files[i][2], np.uint8)[: n * block] for i, n in zip(which, each)]).reshape(-1, block)
        pcm, at = adpcm_blocks(whole), 0
        for i, n in zip(which, each):
            out[i] = pcm[at : at + n].reshape(-1)
            at += n
    return out


def resample(pcm: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Linear interpolation in whole numbers; the last sample is held."""
    if rate == to or not len(pcm):
        return pcm
    n = len(pcm) * to // rate
    if to == 2 * rate:
        wide = np.append(pcm, pcm[-1]).astype(np.int32)
        out = np.empty(n, np.int16)
        out[::2], out[1::2] = pcm, (wide[:-1] + wide[1:]) >> 1
        return out
    at = np.arange(n, dtype=np.int64) * rate
    low, part = at // to, at % to
    wide = np.append(pcm, pcm[-1]).astype(np.int64)
    return ((wide[low] * (to - part) + wide[low + 1] * part) // to).astype(np.int16)


def feature(pcm: np.ndarray) -> str:
    """Samples, peak, root mean square and sign changes, in whole numbers."""
    if not len(pcm):
        return "0/0/0/0"
    x = pcm.astype(np.int64)
    signs = pcm < 0
    return f"{len(x)}/{int(np.abs(x).max())}/{isqrt(int(np.dot(x, x)) // len(x))}/{int(np.count_nonzero(signs[1:] != signs[:-1]))}"


def expand(media: DataFrame, to: int = PCM_RATE, keep_pcm: bool = True) -> DataFrame:
    """media (column `media`: WAV bytes) with pcm (WAV of 16-bit PCM at rate `to`) and feature.

    feature describes the resampled PCM, read back from the bytes stored in pcm.
    """
    media = media.drop("pcm", "feature")
    names = [*media.columns, *(["pcm"] if keep_pcm else []), "feature"]
    schema = ", ".join(f"`{n}` {t}" for n, t in media.dtypes) + (", pcm binary" if keep_pcm else "") + ", feature string"
    at = media.columns.index("media")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in by_bytes(b, at, SLICE):
                got = some.column(at).to_pylist()
                read = [read_wav(m) for m in got if m is not None]
                stored = [wav(resample(x, r[1], to).astype("<i2").tobytes(), PCM, to) for x, r in zip(decode([(r[0], r[2], r[3]) for r in read]), read)]
                told = iter([feature(np.frombuffer(read_wav(s)[3], "<i2")) for s in stored])
                pcm = iter(stored)
                more = [pa.array([None if m is None else next(pcm) for m in got], pa.binary())] if keep_pcm else []
                yield pa.RecordBatch.from_arrays([*some.columns, *more, pa.array([None if m is None else next(told) for m in got], pa.string())], names)

    return media.mapInArrow(run, schema)


def store_texts(docs: DataFrame, kinds: tuple[int, ...] = (ULAW, ALAW, ADPCM)) -> DataFrame:
    """doc_id, n_bytes, media: each text's bytes, filled with spaces to a multiple of UNIT, as the encoded samples of a WAV file.

    The payload's checksum chooses the format among kinds; an ADPCM block is a unit.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in by_bytes(b, 1, SLICE):
                raw = [t.encode() for t in some.column(1).to_pylist()]
                full = [x + b" " * (max(UNIT, -(-len(x) // UNIT) * UNIT) - len(x)) for x in raw]
                media = [wav(x, kinds[zlib.crc32(x) % len(kinds)], RATE, UNIT) for x in full]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def describe(media: DataFrame) -> DataFrame:
    """media with payload_bytes, payload_sha256 and tail_crc32 of the sample bytes read back, media_bytes and media_sha256; without the bytes."""

    media = media.drop("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256")
    names = [*(c for c in media.columns if c != "media"), "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256"]
    schema = ", ".join(f"`{n}` {t}" for n, t in media.dtypes if n != "media") + ", payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string"
    at, kept = media.columns.index("media"), [i for i, c in enumerate(media.columns) if c != "media"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for m in b.column(at):
                m = m.as_py()
                if m is None:
                    rows.append((None,) * 5)
                    continue
                data = read_wav(m)[3]
                rows.append((len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-16:]), len(m), hashlib.sha256(m).hexdigest()))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in kept), *(pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 5, kinds))], names)

    return media.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    stored = materialise(store_texts(spark.read.parquet(f"{sf_dir}/documents.parquet")), "media")
    return describe(expand(stored, keep_pcm=False)).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
