"""A Merkle manifest of a dataset, with a proof for every row, by pointer jumping.

A row's leaf is the digest of its fields; per language the leaves, in order, are hashed
upwards in runs of two until one digest, the subroot, remains; the subroots, in the
order of the languages, likewise give the root.

1. Order: leaves are sorted by range, so a language of any size spans many tasks; their
   ranks are prefix sums over (language, partition) totals.
2. Trees: blocks of 2^`BLOCK` neighbouring nodes are hashed `BLOCK` levels at a time, so
   a tree needs few rounds and a task's group is bounded.
3. Proofs: every node holds a segment: the siblings on its way to an ancestor, each with
   its side. A round joins the nodes with themselves, the ancestor's segment is appended
   and the distance doubles, until every leaf reaches its root. After r rounds only
   nodes at multiples of 2^r above the leaves go on, as no leaf meets the others. An
   ancestors' side of at most `SMALL` bytes, whose rows are counted, is broadcast: few
   ancestors have many leaves each. A larger one is joined by a shuffle; a key then has
   few rows.
4. The segments of the languages' trees and of the tree of subroots are joined; each row
   folds its (perhaps altered) leaf along them.

Defined cases: null fields count as `-`; a null language is a language of its own, the
first; rows that repeat a doc_id stand in the order of their leaves, equal rows side by
side; a null doc_id comes first and is never altered; a single row is its own subroot and
root, with the digest of nothing as its proof; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.base import materialise

#: Levels that a task hashes at once.
BLOCK = 10
SMALL = 1 << 20
TAMPER_MOD = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """`-` for null, else bytes of the value, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*(field(changed.get(c, F.col(c))) for c in FIELDS)), 256))


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """doc_id, lang, leaf, altered (the leaf after tampering, null where nothing was altered)."""
    plain = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"), F.col("n_chars").cast("long"), F.col("text").cast("string"))
    altered = F.when(tampered, leaf_digest(n_chars=F.col("n_chars") + 1))
    return plain.select("doc_id", "lang", leaf_digest().alias("leaf"), altered.alias("altered"))


def ranked(df: DataFrame, group: str, order: list[str], label: str) -> tuple[DataFrame, DataFrame]:
    """The rows with __part and __mid, sorted by group and order, and a row for each group and
    part: `first` (least __mid), `before` (rows of the group in earlier parts), `n` (rows of
    the group). A row's rank in its group is before + __mid - first.

    The window counts parts, not rows.
    """
    keys = [F.asc_nulls_first(c) for c in (group, *order)]
    numbered = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__mid", F.monotonically_increasing_id())
    rows = materialise(numbered.withColumn("__part", F.shiftright("__mid", 33).cast("int")), label)
    parts = rows.groupBy(group, "__part").agg(F.min("__mid").alias("first"), F.count("*").alias("here"))
    inside = Window.partitionBy(group)
    before = F.coalesce(F.sum("here").over(inside.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows, parts.select(group, "__part", "first", before.alias("before"), F.sum("here").over(inside).alias("n"))


def node(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above n leaves."""
    return (n - 1).bit_length()


def step(level: list[str], i: int) -> bytes:
    """The side (1: left, 2: right) and digest of the sibling of level[i]; a zero where it has none."""
    j = i ^ 1
    return b"\0" if j >= len(level) else bytes([1 + (j > i)]) + bytes.fromhex(level[j])


def grow(base: DataFrame, depth: int, block: int = BLOCK) -> tuple[list[DataFrame], list[DataFrame]]:
    """Nodes (g, level, idx, seg: their step) and tops (g, digest) of the trees over base (g, n, idx, digest).

    depth: the height of the largest tree.
    """
    nodes, tops, at = [], [], 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for g, n, blk, digests in zip(*(c.to_pylist() for c in batch.columns)):
                level = [d["digest"].hex() for d in digests]
                todo, first = min(block, height(n) - at), blk << block
                for k in range(todo):
                    out += [(g, n, at + k, (first >> k) + i, step(level, i), None) for i in range(len(level))]
                    level = [node(level[i : i + 2]) for i in range(0, len(level), 2)]
                out.append((g, n, at + todo, first >> todo, None, bytes.fromhex(level[0])))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))], ["g", "n", "level", "idx", "seg", "digest"])

    while True:
        blocks = base.groupBy("g", "n", F.shiftright("idx", block).alias("blk")).agg(F.array_sort(F.collect_list(F.struct("idx", "digest"))).alias("d"))
        made = materialise(blocks.select("g", "n", "blk", "d").mapInArrow(run, "g long, n long, level int, idx long, seg binary, digest binary"), "merkle-nodes")
        nodes.append(made.filter("seg is not null").select("g", "level", "idx", "seg"))
        ended = F.expr(f"cast(n as decimal(20,0)) <= {1 << (at + block)}")
        tops.append(made.filter(F.col("digest").isNotNull() & ended).select("g", "digest"))
        at += block
        if at >= depth:
            return nodes, tops
        base = made.filter(F.col("digest").isNotNull() & ~ended).select("g", "n", "idx", "digest")


def union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def climb(nodes: DataFrame, depth: int, small: int = SMALL) -> DataFrame:
    """g, idx, seg: each leaf's whole segment, by pointer jumping."""
    s = 1
    while s < depth:
        far = nodes.filter(f"level % {2 * s} = {s}").select("g", (F.col("level") - s).alias("level"), F.col("idx").alias("to"), F.col("seg").alias("more"))
        if far.count() * (33 * s + 20) <= small:
            far = F.broadcast(far)
        near = nodes.filter(f"level % {2 * s} = 0").withColumn("to", F.shiftright("idx", s))
        joined = near.join(far, ["g", "level", "to"], "left")
        nodes = materialise(joined.select("g", "level", "idx", F.when(F.col("more").isNull(), F.col("seg")).otherwise(F.concat("seg", "more")).alias("seg")), "merkle-climb")
        s *= 2
    return nodes.filter("level = 0").select("g", "idx", "seg")


def fold(leaf: str, segment: bytes) -> tuple[str, str]:
    """The root that the leaf leads to along the segment, and the digest of the segment's siblings."""
    at, siblings = 0, []
    while at < len(segment):
        side = segment[at]
        at += 1
        if side == 0:
            leaf = node([leaf])
            continue
        other = segment[at : at + 32].hex()
        at += 32
        siblings.append(other)
        leaf = node([other, leaf] if side == 1 else [leaf, other])
    return leaf, node(siblings)


def prove(docs: DataFrame, tampered: Column, block: int = BLOCK, small: int = SMALL) -> DataFrame:
    """doc_id, leaf, subroot, root, proof (binary: the siblings with their sides, leaf to root),
    proof_sha256, folded_root, verified of each row."""
    made = materialise(leaves(docs, tampered).withColumn("__row", F.monotonically_increasing_id()), "merkle-leaves")
    rows, parts = ranked(made, "lang", ["doc_id", "leaf", "__row"], "merkle-order")
    langs, places = ranked(parts.select("lang", "n").distinct().withColumn("__all", F.lit(0)), "__all", ["lang"], "merkle-langs")
    langs = _numbered(langs, places)
    sizes = langs.agg(F.max("n").alias("n"), F.count("*").alias("langs")).first()
    if not sizes["langs"]:
        return _folded(made.select("doc_id", "leaf", F.col("leaf").alias("start"), F.col("leaf").alias("subroot"), F.col("leaf").alias("root"), F.lit(b"").alias("seg")))
    parts = materialise(parts.drop("n").join(langs, parts["lang"].eqNullSafe(langs["lang"])).select(parts["lang"], "__part", "first", "before", "g", "n"), "merkle-parts")
    placed = rows.join(parts, rows["lang"].eqNullSafe(parts["lang"]) & (rows["__part"] == parts["__part"]))
    placed = placed.select("g", rows["__part"], "n", (F.col("before") + F.col("__mid") - F.col("first")).alias("idx"), "doc_id", "leaf", "altered")
    depth, top = height(sizes["n"]), height(sizes["langs"])
    nodes, subroots = grow(placed.select("g", "n", "idx", F.col("leaf").alias("digest")), depth, block)
    subroots = union(subroots)
    above, roots = grow(subroots.select(F.lit(0).cast("long").alias("g"), F.lit(sizes["langs"]).cast("long").alias("n"), F.col("g").alias("idx"), "digest"), top, block)
    root = union(roots).first()["digest"]
    # A row for each language and part: no key of the last joins has more rows than a part.
    tops = subroots.join(climb(union(above), top, small).select(F.col("idx").alias("g"), F.col("seg").alias("rest")), "g", "left")
    tops = parts.select("g", "__part").join(tops, "g").select("g", "__part", F.col("digest").alias("subroot"), F.coalesce("rest", F.lit(b"")).alias("rest"))
    ways = climb(union(nodes), depth, small)
    joined = placed.join(tops, ["g", "__part"]).join(ways, ["g", "idx"], "left")
    seg = F.concat(F.coalesce("seg", F.lit(b"")), "rest")
    return _folded(joined.select("doc_id", "leaf", F.coalesce("altered", "leaf").alias("start"), "subroot", F.lit(root).alias("root"), seg.alias("seg")))


def _numbered(langs: DataFrame, places: DataFrame) -> DataFrame:
    """lang, n, g: the language's place."""
    places = places.select("__part", "first", "before")
    return langs.join(places, "__part").select("lang", "n", (F.col("before") + F.col("__mid") - F.col("first")).alias("g"))


def _folded(rows: DataFrame) -> DataFrame:
    schema = "doc_id long, leaf string, subroot string, root string, proof binary, proof_sha256 string, folded_root string, verified boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hexed = [[x.hex() for x in b.column(i).to_pylist()] for i in (1, 2, 3, 4)]
            found = [fold(start, seg) for start, seg in zip(hexed[1], b.column(5).to_pylist())]
            ok = [f[0] == r for f, r in zip(found, hexed[3])]
            texts = [pa.array(x, pa.string()) for x in (hexed[0], hexed[2], hexed[3])]
            yield pa.RecordBatch.from_arrays([b.column(0), *texts, b.column(5), pa.array([f[1] for f in found], pa.string()), pa.array([f[0] for f in found], pa.string()), pa.array(ok, pa.bool_())], ["doc_id", "leaf", "subroot", "root", "proof", "proof_sha256", "folded_root", "verified"])

    return rows.mapInArrow(run, schema)


def tampered_rows() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(TAMPER_MOD)) == 0


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return prove(docs, tampered_rows()).drop("proof")


_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = " || ".join(_FIELD.format(c) for c in FIELDS)
_ALTERED = _LEAF.replace("CAST(n_chars AS", "CAST(n_chars + CASE WHEN crc % 7 = 0 THEN 1 ELSE 0 END AS")
SQL = f"""
WITH RECURSIVE crc AS (
  SELECT doc_id, source, lang, n_chars, text, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda d, k: xor(d >> 1, 3988292384 * (d & 1))))) AS crc
  FROM documents
), leaf AS (
  SELECT doc_id, sha256({_LEAF}) AS leaf, sha256({_ALTERED}) AS start,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, count(*) OVER (PARTITION BY lang) AS n, lang FROM crc
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaf
), tree AS (
  SELECT g, 0 AS level, idx, leaf AS h, n FROM placed
  UNION ALL
  SELECT g, level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (n + 1) // 2 FROM tree WHERE n > 1 GROUP BY g, level, idx // 2, n
), top AS (
  SELECT 0 AS level, g AS idx, h, (SELECT max(g) + 1 FROM placed) AS n FROM tree WHERE n = 1
  UNION ALL
  SELECT level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY level, idx // 2, n
), way AS (
  SELECT p.g, p.idx AS leaf_idx, s.level AS rung, (s.idx % 2 = 1) AS to_left, o.h AS sibling
  FROM placed p JOIN tree s ON s.g = p.g AND s.n > 1 AND s.idx = p.idx >> s.level LEFT JOIN tree o ON o.g = s.g AND o.level = s.level AND o.idx = xor(s.idx, 1)
  UNION ALL
  SELECT p.g, p.idx, 1000 + s.level, (s.idx % 2 = 1), o.h
  FROM placed p JOIN top s ON s.n > 1 AND s.idx = p.g >> s.level LEFT JOIN top o ON o.level = s.level AND o.idx = xor(s.idx, 1)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY g, leaf_idx ORDER BY rung) AS k FROM way
), folded AS (
  SELECT g, idx, 0 AS k, start AS h FROM placed
  UNION ALL
  SELECT f.g, f.idx, f.k + 1, sha256(CASE WHEN w.sibling IS NULL THEN f.h WHEN w.to_left THEN w.sibling || f.h ELSE f.h || w.sibling END)
  FROM folded f JOIN numbered w ON w.g = f.g AND w.leaf_idx = f.idx AND w.k = f.k + 1
), last AS (
  SELECT g, idx, arg_max(h, k) AS folded_root FROM folded GROUP BY g, idx
), proof AS (
  SELECT p.g, p.idx, sha256(coalesce(string_agg(w.sibling, '' ORDER BY w.k), '')) AS proof_sha256
  FROM placed p LEFT JOIN numbered w ON w.g = p.g AND w.leaf_idx = p.idx GROUP BY p.g, p.idx
)
SELECT p.doc_id, p.leaf, s.h AS subroot, r.h AS root, q.proof_sha256, l.folded_root, l.folded_root = r.h AS verified
FROM placed p JOIN tree s ON s.g = p.g AND s.n = 1 JOIN (SELECT h FROM top WHERE n = 1) r ON true
JOIN proof q ON q.g = p.g AND q.idx = p.idx JOIN last l ON l.g = p.g AND l.idx = p.idx
"""
