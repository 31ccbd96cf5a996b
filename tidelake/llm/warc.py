"""WARC archives of pages, and their capture index by external merge.

1. Payloads of at least `least` bytes are grouped by digest; of equal ones, the
   largest page_id is written as response, the others as revisits of it.
2. Each task writes its pages as WARC records (a gzip member each) into archive
   segments, which go to the shared folder as rows of bytes.
3. The segments are read back and parsed; every task sorts its captures by URL
   key and timestamp: a locally sorted run of the index, written to the shared
   folder.
4. The runs are counted and dealt by ranges of (URL key, timestamp, page_id, run), so
   that a hot URL, or a capture that many runs have, is split too; there are so many ranges that each
   has about `RANGE` captures, however many there are in all. Inside a range, whose
   pieces of runs are its bounded buffer, a loser tree merges the pieces, which still
   are in order. Ranges in order give the global capture histories.

Only the groups' digests and ids are shuffled by payload; the join that brings
them to the pages is an ordinary one, whose hot digests adaptive execution splits.

Defined cases: null html is an empty payload; a null url has the empty key; a null
page_id is a revisit wherever its payload has a response, and is never one's
target; rows that repeat a page_id are records like others; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.base import materialise

LEAST, SEGMENT_BYTES, RANGE = 1000, 1 << 20, 50_000
_START = datetime(2024, 1, 1, tzinfo=UTC)
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FIELDS = "page_id long, url string, captured_at string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def url_key(url: Column) -> Column:
    """Sort key of a URL: host labels reversed, then port, path and query; scheme and fragment are dropped."""
    pattern = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://)?(?:[^/?#@]*@)?([^/:?#]*)(:[0-9]+)?([^#]*)"
    whole = F.coalesce(url, F.lit(""))
    host = F.array_join(F.reverse(F.split(F.lower(F.regexp_extract(whole, pattern, 1)), r"\.")), ",")
    return F.concat(host, F.regexp_extract(whole, pattern, 2), F.lit(")"), F.regexp_extract(whole, pattern, 3))


def _safe(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id: int | None, url: str | None, at: str, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP header, whose length is that of the full payload."""
    name = "" if page_id is None else page_id
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {at}"]
    head += [] if url is None else [f"WARC-Target-URI: {_safe(url)}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}"]
    head += [] if refers_to is None else [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_records(segment: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a segment."""
    while segment:
        member = zlib.decompressobj(31)
        raw = member.decompress(segment) + member.flush()
        segment = member.unused_data
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError("not a WARC record")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        n = int(fields["Content-Length"])
        if rest[n:] != b"\r\n\r\n":
            raise ValueError("a WARC record's length is wrong")
        yield fields, rest[:n]


def _page(field: str) -> int | None:
    number = field.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _capture(fields: dict[str, str], block: bytes) -> tuple:
    """The index entry of a record, with the digest checked where the payload is there."""
    head, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != length or hashlib.sha1(payload).digest() != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload isn't the one that was written")
    refers = _page(fields["WARC-Refers-To"]) if kind == "revisit" else None
    return _page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), fields["WARC-Date"], length, digest.hex(), kind, refers


def write_archives(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """archive (binary): segments of gzipped WARC records. The date of a capture is its page_id in seconds after 2024-01-01."""
    raw = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"))
    keyed = raw.withColumn("__sha", F.unhex(F.sha2("html", 256)))
    large = keyed.filter(F.octet_length("html") >= least)
    groups = large.groupBy("__sha").agg(F.max("page_id").alias("__first"), F.count("*").alias("__n")).filter("__n > 1 and __first is not null").drop("__n")
    linked = keyed.join(groups, "__sha", "left")
    other = F.col("__first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("__first"))
    rows = linked.select("page_id", "url", "html", F.when(other, F.col("__first")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for page, url, html, refers in zip(*(b.column(i).to_pylist() for i in range(4))):
                at = (_START + timedelta(seconds=abs(page or 0) % 10**9)).strftime("%Y-%m-%dT%H:%M:%SZ")
                pack = zlib.compressobj(4, zlib.DEFLATED, 31)
                held.append(pack.compress(record(page, url, at, html.encode(), refers)) + pack.flush())
                size += len(held[-1])
                if size >= SEGMENT_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["archive"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["archive"])

    return rows.mapInArrow(run, "archive binary")


def read_archives(archives: DataFrame) -> DataFrame:
    """A row for each record: its capture and the run (task) that read it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32()]
        names = ["page_id", "url", "captured_at", "payload_bytes", "payload_digest", "record_type", "refers_to", "__run"]
        for b in batches:
            for segment in b.column(0):
                rows = [(*_capture(f, block), part) for f, block in read_records(segment.as_py())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return archives.mapInArrow(run, f"{_FIELDS}, __run int")


class LoserTree:
    """Merges k lists of (key, row), each sorted by key: inner nodes hold losers, so that a step replays one path."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.at = [r for r in runs if r], [0] * sum(map(bool, runs))
        k = max(1, len(self.runs))
        self.losers, winners = [-1] * k, [-1] * k + list(range(len(self.runs))) + [-1] * (k - len(self.runs))
        for node in range(k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = winners[1] if k > 1 else winners[k]

    def _before(self, a: int, b: int) -> bool:
        if a < 0 or self.at[a] >= len(self.runs[a]):
            return False
        return b < 0 or self.at[b] >= len(self.runs[b]) or self.runs[a][self.at[a]][0] <= self.runs[b][self.at[b]][0]

    def __iter__(self) -> Iterator[tuple]:
        k, w = len(self.losers), self.winner
        while w >= 0 and self.at[w] < len(self.runs[w]):
            yield self.runs[w][self.at[w]]
            self.at[w] += 1
            node = (w + k) // 2
            while node:
                if self._before(self.losers[node], w):
                    self.losers[node], w = w, self.losers[node]
                node //= 2


def merge_index(captures: DataFrame, per_range: int = RANGE) -> DataFrame:
    """captures in order of url_key, captured_at and page_id, over ordered ranges of about per_range captures each."""
    order = ["url_key", "captured_at", "page_id"]
    runs = materialise(captures.withColumn("url_key", url_key(F.col("url"))).sortWithinPartitions(*order), "runs")
    names = [c for c in runs.columns if c != "__run"]
    place, key_at = names.index("page_id"), [names.index(c) for c in order[:2]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[list[tuple]]] = {}
        schema = None
        for b in batches:
            schema = b.schema
            columns = [b.column(b.schema.get_field_index(n)).to_pylist() for n in names]
            for number, row in zip(b.column(b.schema.get_field_index("__run")).to_pylist(), zip(*columns)):
                page = row[place]
                key = (*(row[i] for i in key_at), page is not None, page or 0)
                pieces = found.setdefault(number, [[]])
                if pieces[-1] and key < pieces[-1][-1][0]:  # another batch of the same run
                    pieces.append([])
                pieces[-1].append((key, row))
        merged, out = LoserTree([p for pieces in found.values() for p in pieces]), []
        kinds = [schema.field(n).type for n in names] if schema else []
        for _, row in merged:
            out.append(row)
            if len(out) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    ranges = max(1, -(-runs.count() // per_range))
    return runs.repartitionByRange(ranges, *order, "__run").mapInArrow(run, f"{_FIELDS}, url_key string")


def query(spark, sf_dir: str) -> DataFrame:
    archives = materialise(write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet")), "archives")
    return merge_index(read_archives(archives)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at")


SQL = r"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages
), g AS (
  SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS first FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to,
  array_to_string(list_reverse(string_split(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://)?(?:[^/?#@]*@)?([^/:?#]*)(:[0-9]+)?([^#]*)', 1)), '.')), ',')
    || regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://)?(?:[^/?#@]*@)?([^/:?#]*)(:[0-9]+)?([^#]*)', 2) || ')'
    || regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://)?(?:[^/?#@]*@)?([^/:?#]*)(:[0-9]+)?([^#]*)', 3) AS url_key,
  strftime(TIMESTAMP '2024-01-01' + to_seconds(abs(page_id) % 1000000000), '%Y-%m-%dT%H:%M:%SZ') AS captured_at
FROM g
"""
