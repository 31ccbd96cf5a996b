"""Exact deduplication by skew-safe combining.

Texts are equal when identical after deleting spaces, tabs and line ends. The
whole job is DataFrame aggregation keyed by digest *and* content, so full
content is compared wherever rows meet:

1. local: each map task merges its own equal rows (map-side combine); a salt
   made from the task's number keeps later groups small;
2. salted: rows of one (digest, salt, content) merge, so a text that a third
   of all rows share is spread over `salts` tasks, each of which gets at most
   one row from a map task;
3. global: the at most `salts` winners of a text merge.

The winners (digest, id, size: no content) are joined to the rows by digest;
both sides come from plain exchanges, so adaptive execution splits a hot digest.

Defined cases: null text counts as empty; all empty texts are one group; a null
doc_id loses against any other; rows that repeat a doc_id and a text count as
members but only one of them is kept; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.base import SPACES, materialise, text_of

SALTS = 16
#: Room for any doc_id below the text length in a rank.
_ROOM = "cast('100000000000000000000' as decimal(21,0))"


def _sha256(norm: Column) -> Column:
    return F.unhex(F.sha2(norm, 256))


def _keyed(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    out = docs.select(F.col("doc_id").cast("long"), text_of().alias("__text"))
    out = out.select("doc_id", F.translate("__text", SPACES, "").alias("__norm"), F.char_length("__text").alias("__chars"))
    return out.withColumn("__digest", digest(F.col("__norm")))


def _groups(keyed: DataFrame, salts: int) -> DataFrame:
    """A row for each text: __digest, __norm, __rank of the row that stays, __size."""
    low = "coalesce(cast(9223372036854775807 as decimal(19,0)) - cast(doc_id as decimal(19,0)) + 1, cast(0 as decimal(21,0)))"
    ranked = keyed.withColumns({
        "__rank": F.expr(f"cast(cast(__chars as decimal(10,0)) * {_ROOM} + {low} as decimal(33,0))"),
        "__salt": F.pmod(F.spark_partition_id(), F.lit(salts)),
    })
    salted = ranked.groupBy("__digest", "__salt", "__norm").agg(F.max("__rank").alias("__rank"), F.count("*").alias("__size"))
    return salted.groupBy("__digest", "__norm").agg(F.max("__rank").alias("__rank"), F.sum("__size").alias("__size"))


def _light(groups: DataFrame, *more: str) -> DataFrame:
    rest = F.expr(f"__rank % {_ROOM}")
    keep = F.when(rest > 0, (F.lit(9223372036854775807).cast("decimal(19,0)") - rest + 1).cast("long"))
    return groups.select("__digest", keep.alias("keep_id"), F.col("__size").alias("group_size"), *more)


def mark(docs: DataFrame, salts: int = SALTS, digest: Callable[[Column], Column] = _sha256) -> DataFrame:
    """A row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    digest may be any function of the normalised text; texts that share a
    digest without being equal are told apart by their content.
    """
    keyed = _keyed(docs, digest)
    found = materialise(_light(_groups(keyed, salts)), "exact")
    rows = keyed.withColumn("text_sha256", F.sha2("__norm", 256))
    shared = found.groupBy("__digest").count().filter("count > 1").select("__digest")
    if shared.isEmpty():
        joined = rows.drop("__norm").join(found, "__digest")
    else:
        clash = _light(_groups(keyed.join(shared, "__digest", "left_semi"), salts), "__norm")
        apart = rows.join(clash, ["__digest", "__norm"]).drop("__norm")
        joined = rows.drop("__norm").join(found.join(shared, "__digest", "left_anti"), "__digest").unionByName(apart)
    first = F.row_number().over(Window.partitionBy("doc_id", "text_sha256").orderBy(F.desc("__chars")))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (first == 1)
    return joined.withColumn("kept", kept).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def keep(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows of docs that stay, with all their columns, whatever their names."""
    no_id = F.lit(-(1 << 63))
    kept = mark(docs, salts).filter("kept").select(F.coalesce("doc_id", no_id).alias("id"), F.col("text_sha256").alias("sha"))
    sha = F.sha2(F.translate(text_of(), SPACES, ""), 256)
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), no_id).alias("id"), sha.alias("sha"), F.char_length(text_of()).alias("chars"))
    first = F.row_number().over(Window.partitionBy("id", "sha").orderBy(F.desc("chars")))
    return rows.join(kept, ["id", "sha"], "left_semi").withColumn("first", first).filter("first = 1").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return mark(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
), g AS (
  SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id,
         CAST(count(*) OVER (PARTITION BY norm) AS BIGINT) AS group_size FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""
