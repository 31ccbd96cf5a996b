"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by (source, exact length). For each source the whole
repeats are fixed first; a bounded knapsack over the counts of lengths then
fits the remaining budget; seeded ranks pick that many documents of each length.
A source's counts are bounded by its distinct lengths, never by its rows, and
ranks are taken inside salted cells, so one source, or one length, may hold any
share of the rows. What reaches the driver is one line for each source.

Defined cases: null or empty text has size 0 and takes no words; a null source
is a source of its own, last in order; null doc_ids and repeated rows are rows
like others (of rows with one id, source and size, the first by text are taken more
often); an empty table gives an empty result; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

from math import floor, gcd

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.base import WORD, materialise, text_of

WEIGHTS, CAP, SEED, SALTS, DP_BUDGET = (5, 2, 1), 3, 20240229, 256, 1 << 15


def targets(sizes: list[int], weights: list[int], cap: int = CAP) -> list[float]:
    """Shares of sum(sizes) by weight; none above cap times its size, the excess reshared."""
    out, left, rest = [0.0] * len(sizes), set(range(len(sizes))), sum(sizes)
    while left:
        whole = sum(weights[i] for i in left)
        full = {i for i in left if rest * weights[i] >= cap * sizes[i] * whole}
        if not full:
            for i in left:
                out[i] = rest * weights[i] / whole
            break
        for i in full:
            out[i] = float(cap * sizes[i])
            rest -= cap * sizes[i]
        left -= full
    return out


def fit(sizes: np.ndarray, counts: np.ndarray, target: float, cap: int = CAP, budget: int = DP_BUDGET) -> tuple[int, np.ndarray]:
    """Repeats of every document, and how many documents of each size are taken once more.

    Words beyond the budget are shared out in proportion to the counts and then
    from the largest size down; the last `budget` words or so come from a bounded
    knapsack over bit sets of reachable sums, which finds the nearest sum there is.
    """
    total, extra = int(np.dot(sizes, counts)), np.zeros(len(sizes), np.int64)
    if total == 0:
        return 0, extra
    goal = round(target)
    repeats = min(cap, goal // total)
    rest = goal - repeats * total
    if repeats == cap or rest <= 0:
        return int(repeats), extra
    if rest > budget:
        extra = np.array([floor(int(c) * (rest - budget) // total) for c in counts], np.int64)
        rest -= int(np.dot(sizes, extra))
        for i in np.argsort(-sizes):
            if sizes[i] and rest > budget:
                q = min(int(counts[i] - extra[i]), (rest - budget) // int(sizes[i]))
                extra[i] += q
                rest -= q * int(sizes[i])
    for i, q in _knapsack([(i, int(sizes[i]), int(counts[i] - extra[i])) for i in np.argsort(-sizes) if sizes[i]], rest).items():
        extra[i] += q
    return int(repeats), extra


def _knapsack(items: list[tuple[int, int, int]], goal: int) -> dict[int, int]:
    """items: (key, size, count). How many of each key give the sum nearest to goal, the lower of two."""
    limit = 2 * goal
    mask, reach, steps = (1 << (limit + 1)) - 1, 1, []
    items = [(k, s, min(n, limit // s)) for k, s, n in items if n and s <= limit]
    unit = gcd(*(s for _, s, _ in items)) if items else 1
    close = min(goal % unit, -goal % unit)

    def nearest() -> int:
        low = (reach & ((1 << (goal + 1)) - 1)).bit_length() - 1
        high = reach >> goal
        over = (high & -high).bit_length() - 1 if high else limit
        return low if goal - low <= over else goal + over

    for key, size, n in items:
        step = 1
        while n:
            q = min(step, n)
            steps.append((key, size, q, reach))
            reach |= (reach << (size * q)) & mask
            n, step = n - q, step * 2
        if abs(nearest() - goal) == close:
            break
    best, out = nearest(), {}
    for key, size, q, before in reversed(steps):
        if not (before >> best) & 1:
            best -= size * q
            out[key] = out.get(key, 0) + q
    return out


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("__src"),
        F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("__hash"),
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED, salts: int = SALTS) -> DataFrame:
    """A row for each row of docs: doc_id, size, source_size, target, taken, times, __src."""
    spark = docs.sparkSession
    sized = materialise(_sized(docs, seed).withColumn("__salt", F.pmod("__hash", F.lit(salts)).cast("int")), "sizes")
    cells = materialise(sized.groupBy("__src", "size", "__salt").agg(F.count("*").alias("__n")), "cells")
    lengths = cells.groupBy("__src", "size").agg(F.sum("__n").alias("__n"))
    found = cells.groupBy("__src").agg(F.sum(F.col("size") * F.col("__n")).cast("long").alias("n")).collect()
    named = sorted(((r["__src"], r["n"]) for r in found), key=lambda x: (x[0] == "", x[0]))
    aims = targets([n for _, n in named], [weights[i % len(weights)] for i in range(len(named))], cap)
    aim = spark.createDataFrame([(k, n, t) for (k, n), t in zip(named, aims)], "__src string, source_size long, target double")

    def fitted(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size")
        repeats, extra = fit(pdf["size"].to_numpy(), pdf["__n"].to_numpy(), float(pdf["target"].iloc[0]), cap)
        return pdf[["__src", "size", "source_size", "target"]].assign(__repeats=repeats, __extra=extra)

    plan = lengths.join(aim, "__src").groupBy("__src").applyInPandas(fitted, "__src string, size long, source_size long, target double, __repeats int, __extra long")
    before = F.sum("__n").over(Window.partitionBy("__src", "size").orderBy("__salt")) - F.col("__n")
    cut = cells.withColumn("__before", before).join(plan, ["__src", "size"]).withColumn("__extra", F.greatest(F.lit(0), F.least("__n", F.col("__extra") - F.col("__before"))))
    cut = cut.select("__src", "size", "__salt", "source_size", "target", "__repeats", "__extra")
    rank = F.row_number().over(Window.partitionBy("__src", "size", "__salt").orderBy(F.xxhash64(F.lit(seed + 1), "__hash"), "doc_id"))
    out = sized.join(cut, ["__src", "size", "__salt"]).withColumn("times", F.col("__repeats") + (rank <= F.col("__extra")).cast("int"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "times", "__src")


def apply(docs: DataFrame, **kwargs) -> DataFrame:
    """docs with each row as often as the mix takes it, in its own columns, whatever their names."""
    keys, no_id = ["id", "src", "size", "nth"], F.lit(-(1 << 63))
    nth = lambda *order: F.row_number().over(Window.partitionBy(*keys[:3]).orderBy(*order))
    chosen = mix(docs, **kwargs).select(F.coalesce("doc_id", no_id).alias("id"), F.col("__src").alias("src"), "size", "times")
    chosen = chosen.withColumn("nth", nth(F.desc("times")))
    rows = docs.select(
        F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), no_id).alias("id"), F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("src"),
        F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"), F.xxhash64("text").alias("hash"), F.col("text").alias("text"),
    )
    rows = rows.withColumn("nth", nth("hash", "text")).drop("hash", "text")
    out = rows.join(chosen.filter("times > 0"), keys)
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("__src")
