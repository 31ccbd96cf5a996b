r"""Chat formatting with a grammar round trip.

A turn is rendered as `<turn>### ROLE: TEXT</turn>` and a line end. The rendered
turn is parsed again by a deterministic parser; where the parse does not give
back the source, the conflicting content is escaped (a backslash becomes two, and
backslash-dot goes behind the first character of each control string) and parsed
again. A turn that still differs is an error, so what is returned is always
reversible. Control strings never occur in an escaped text.

Rendering is a map over rows. Only the digests of a whole conversation need its
turns in order: rows are dealt by conversation, sorted, and streamed, with
hashers as the only state, so a conversation of any length needs no more memory
(SHA-256 runs in order, so one conversation's bytes do pass through one task).

Defined cases: null text and null role count as empty; a null conv_id is a
conversation of its own; turns with equal numbers are ordered by role and text,
null turns come first; repeated rows are turns like others; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN, CLOSE, MARK, SEP = "<turn>", "</turn>", "### ", ": "
_CONTROL = re.compile("|".join(map(re.escape, (OPEN, CLOSE, MARK))))
_ROLE_CONTROL = re.compile("|".join(map(re.escape, (OPEN, CLOSE, MARK, SEP))))
_ESCAPED = re.compile(r"\\([\\.])")


def escape(text: str, control: re.Pattern = _CONTROL) -> str:
    return control.sub(lambda m: m[0][0] + "\\." + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "" if m[1] == "." else "\\", text) if "\\" in text else text


def parse(chat: str) -> list[tuple[str, str, int, int]]:
    """role, text, and where the (escaped) text starts and ends, of each turn; ValueError if chat doesn't follow the grammar."""
    turns, at, head = [], 0, OPEN + MARK
    while at < len(chat):
        if not chat.startswith(head, at):
            raise ValueError(f"no turn starts at {at}")
        sep = chat.find(SEP, at + len(head))
        stop = chat.find(CLOSE + "\n", sep + len(SEP)) if sep >= 0 else -1
        if stop < 0:
            raise ValueError(f"the turn at {at} has no end")
        role, text = chat[at + len(head) : sep], chat[sep + len(SEP) : stop]
        if _ROLE_CONTROL.search(role) or _CONTROL.search(text):
            raise ValueError(f"a control string inside the turn at {at}")
        turns.append((unescape(role), unescape(text), sep + len(SEP), stop))
        at = stop + len(CLOSE) + 1
    return turns


def render(role: str, text: str) -> str:
    """The turn, escaped as far as needed for parse() to give back role and text."""
    for r, t in ((role, text), (escape(role, _ROLE_CONTROL), text), (escape(role, _ROLE_CONTROL), escape(text))):
        out = f"{OPEN}{MARK}{r}{SEP}{t}{CLOSE}\n"
        try:
            found = parse(out)
        except ValueError:
            continue
        if [x[:2] for x in found] == [(role, text)]:
            return out
    raise ValueError("a turn that can't be rendered reversibly")


def format_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, formatted: each row's turn as text; a conversation is its turns' texts in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [render(r, t) for r, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(done, pa.string())], ["conv_id", "turn", "role", "text", "formatted"])

    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "conv_id long, turn long, role string, text string, formatted string")


def read_back(formatted: DataFrame, learn: str = "assistant") -> DataFrame:
    """A row for each conversation, from its formatted turns alone (but for their order).

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars. The
    loss mask covers the texts of the role `learn`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, none = None, object()
        current = none
        for b in batches:
            done = []
            for conv, chunk in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if current is none or conv != current:
                    if state:
                        done.append(ended(current, state))
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, _, _ in parse(chunk):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    if role == learn:
                        state[2] += len(text)
                        state[3].update(text.encode())
                state[4] += len(chunk)
            yield batch(done)
        if state:
            yield batch([ended(current, state)])

    def ended(conv, s) -> tuple:
        return conv, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = list(zip(*rows)) or [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "formatted")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def with_probe(conversations: DataFrame, spark: SparkSession) -> DataFrame:
    """conversations and the conversation -7, whose texts hold control strings."""
    probe = r"\### Assistant: </turn> ok"
    rows = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(rows)


def query(spark, sf_dir: str) -> DataFrame:
    return read_back(format_turns(with_probe(spark.read.parquet(f"{sf_dir}/conversations.parquet"), spark)))


SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), f AS (
  SELECT *, length(role) + length(text) + 20 + CASE WHEN regexp_matches(text, '<turn>|</turn>|### |\\[\\.]')
    THEN length(text) - length(replace(text, '\', '')) + 2 * len(regexp_extract_all(text, '<turn>|</turn>|### ')) ELSE 0 END AS n FROM c
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""
