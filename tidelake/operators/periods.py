"""Period maxima: days, months with a least separation, and fixed blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions import calendars as C
from tidelake.schema import FILL

MAX_ROUNDS, SEPARATION_H = 5, 24.0


def valid(value: Column) -> Column:
    """value, or null where it is fill or NaN."""
    return F.when(value < FILL / 2, value)


def with_owner(series: DataFrame, calendar: str | None = None) -> DataFrame:
    """series with owner_file and orphan.

    A file whose last instant is 1 January 00:00 yields that instant to the next
    file there is, whatever the convention; without a next one it is an orphan, a
    period of its own. There is a row for each file in what is broadcast.
    """
    files = series.groupBy("file_year").agg(F.max("time_h").alias("__last"))
    files = files.withColumn("__next", F.lead("file_year").over(Window.orderBy("file_year")))
    moved = (F.col("time_h") == F.col("__last")) & C.is_year_start(F.col("time_h"), calendar)
    joined = series.join(F.broadcast(files), "file_year")
    return joined.withColumns({"owner_file": F.when(moved, F.coalesce("__next", "file_year")).otherwise(F.col("file_year")), "orphan": moved & F.col("__next").isNull()}).drop("__last", "__next")


def _dated(series: DataFrame, calendar: str | None, convention: str | None) -> DataFrame:
    """series with owner_file, orphan and day: an orphan keeps its own date under any convention."""
    date = F.when(F.col("orphan"), C.date_of(F.col("time_h"), calendar, eps=0.0)).otherwise(C.date_of(F.col("time_h"), calendar, convention))
    return with_owner(series, calendar).withColumn("day", date)


def duplicate_periods(dated: DataFrame, period: str) -> DataFrame:
    """Periods that several files own."""
    unit = F.concat_ws("/", F.col("owner_file").cast("string"), F.col("orphan").cast("string"))
    return dated.groupBy(period).agg(F.countDistinct(unit).alias("n_files")).filter("n_files > 1")


def check_periods(dated: DataFrame, period: str, convention: str | None) -> None:
    """ValueError if several files own a period, which usually means the other convention."""
    found = duplicate_periods(dated, period).orderBy(period).limit(5).collect()
    if found:
        other = next(c for c in C.CONVENTIONS if c != (convention or C.DEFAULT_CONVENTION))
        raise ValueError(f"periods owned by several files, first {[tuple(r[0]) for r in found]}; the series may follow the convention {other!r}")


def _owners() -> list[Column]:
    """Aggregates: the least and the greatest owner of a period's rows."""
    owner = F.struct("owner_file", "orphan")
    return [F.min(owner).alias("__low"), F.max(owner).alias("__high")]


def _one_owner(result: Column, period: Column, convention: str | None) -> Column:
    """result, or an error where the period's rows of a node come from several files."""
    other = next(c for c in C.CONVENTIONS if c != (convention or C.DEFAULT_CONVENTION))
    said = F.concat(F.lit("periods owned by several files, one of them "), period.cast("string"), F.lit(f"; the series may follow the convention '{other}'"))
    return F.when(F.col("__low").eqNullSafe(F.col("__high")), result).otherwise(F.raise_error(said))


def _top(value: Column, time_h: Column) -> Column:
    """Aggregate: the largest valid value with its earliest time; null if none is valid."""
    v = valid(value)
    return F.max(F.when(v.isNotNull(), F.struct(v.alias("v"), (-time_h).alias("h"))))


def daily_max(series: DataFrame, calendar: str | None = None, convention: str | None = None, check: bool | str = True) -> DataFrame:
    """node_id, y, m, d, value, time_h: each day's maximum and its first time; null for a day without a valid value.

    check: a day that several files own is an error: True asks before (a job of its own, over
    all nodes together), "inside" while the maxima are taken (no further scan, node by node).
    """
    dated = _dated(series, calendar, convention)
    if check is True:
        check_periods(dated, "day", convention)
    best = dated.groupBy("node_id", "day").agg(_top(F.col("value"), F.col("time_h")).alias("b"), *(_owners() if check == "inside" else []))
    if check == "inside":
        best = best.withColumn("b", _one_owner(F.col("b"), F.col("day"), convention))
    return best.select("node_id", "day.y", "day.m", "day.d", F.col("b.v").alias("value"), (-F.col("b.h")).alias("time_h"))


def monthly_max_raw(series: DataFrame, calendar: str | None = None, convention: str | None = None) -> DataFrame:
    """node_id, y, m, value, time_h: each month's maximum, without the separation rule."""
    dated = _dated(series, calendar, convention)
    best = dated.groupBy("node_id", "day.y", "day.m").agg(_top(F.col("value"), F.col("time_h")).alias("b"))
    return best.select("node_id", "y", "m", F.col("b.v").alias("value"), (-F.col("b.h")).alias("time_h"))


def month_candidates(series: DataFrame, rounds: int = MAX_ROUNDS, calendar: str | None = None, convention: str | None = None, check: bool | str = True) -> DataFrame:
    """node_id, ym, cands: each month's 2 * rounds + 1 largest valid values, the earliest first among equals.

    A month loses at most `rounds` values to the month before and as many to the
    next, so no more can ever be asked for. The rank filter runs before the shuffle.
    check: as in daily_max; "inside" ranks the rows of each owner, so that a second one is seen.
    """
    dated = _dated(series, calendar, convention).withColumn("month", F.struct("day.y", "day.m"))
    if check is True:
        check_periods(dated, "month", convention)
    inside, most = check == "inside", 2 * rounds + 1
    owner = ["owner_file", "orphan"] if inside else []
    rows = dated.select("node_id", (F.col("month.y") * 12 + F.col("month.m") - 1).alias("ym"), valid(F.col("value")).alias("v"), F.col("time_h").alias("h"), *owner)
    rank = F.row_number().over(Window.partitionBy("node_id", "ym", *owner).orderBy(F.desc_nulls_last("v"), "h"))
    top = rows.withColumn("__rank", rank).filter(F.col("__rank") <= most)
    kept = F.filter(F.array_sort(F.collect_list(F.struct("__rank", "v", "h"))), lambda c: c["v"].isNotNull())
    got = top.groupBy("node_id", "ym").agg(kept.alias("cands"), *(_owners() if inside else []))
    return got.select("node_id", "ym", _one_owner(F.col("cands"), F.col("ym"), convention).alias("cands")) if inside else got


def separate(candidates: DataFrame, hours: float = SEPARATION_H, rounds: int = MAX_ROUNDS) -> DataFrame:
    """node_id, y, m, value, time_h, adjusted, n_excluded, residual_violation: monthly maxima at least `hours` apart.

    Months of a node are folded in order, over gaps too: while the maxima of two
    neighbours are closer than `hours`, the smaller one (of equal ones, the
    earlier month's) gives way to its month's next value, `rounds` times at most;
    then the earlier month is final. A month that was final is not looked at
    again, and what is still too close after the last round stays, marked.
    Nodes are independent: a task takes the same step for all of a batch at once.
    """
    months = candidates.groupBy("node_id").agg(F.array_sort(F.collect_list(F.struct("ym", "cands"))).alias("ms"))
    field = lambda name: F.flatten(F.transform("ms", lambda m: F.transform(m["cands"], lambda c: c[name])))
    rows = months.select("node_id", F.col("ms.ym").alias("ym"), F.transform("ms", lambda m: F.size(m["cands"])).alias("n"), field("v").alias("v"), field("h").alias("h"))
    kind = dict(rows.dtypes)["v"].removeprefix("array<").removesuffix(">")
    names = ["node_id", "ym", "value", "time_h", "n_excluded", "residual_violation"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                node, ym, n, v, h = batch.slice(low, 512).columns
                values, times = v.flatten(), h.flatten()
                count = n.value_lengths().to_numpy()
                pointer, bad = fold(count, n.flatten().to_numpy(), values.to_numpy(zero_copy_only=False), times.to_numpy(zero_copy_only=False), hours, rounds)
                sizes = n.flatten().to_numpy()
                at = pa.array(np.cumsum(sizes) - sizes + pointer, mask=pointer >= sizes)
                yield pa.RecordBatch.from_arrays([node.take(pa.array(np.repeat(np.arange(len(count)), count))), ym.flatten(), values.take(at), times.take(at), pa.array(pointer.astype(np.int32)), pa.array(bad)], names)

    got = rows.mapInArrow(run, f"node_id {dict(rows.dtypes)['node_id']}, ym {dict(rows.dtypes)['ym'].removeprefix('array<').removesuffix('>')}, value {kind}, time_h double, n_excluded int, residual_violation boolean")
    return got.select("node_id", F.floor(F.col("ym") / 12).cast("int").alias("y"), (F.pmod("ym", F.lit(12)) + 1).cast("int").alias("m"), "value", "time_h", (F.col("n_excluded") > 0).alias("adjusted"), "n_excluded", "residual_violation")


def fold(count: np.ndarray, sizes: np.ndarray, values: np.ndarray, times: np.ndarray, hours: float, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """How many values each month gave up, and whether it stays too close to the next.

    count: months of each node; sizes: candidates of each month; values, times: those of all months, one after another.
    """
    total, wide = len(sizes), max(2 * rounds + 2, int(sizes.max(initial=0)) + 1)
    v, h = np.full((total, wide), np.nan), np.full((total, wide), np.nan)  # comparisons with what isn't there are false
    row = np.repeat(np.arange(total), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    v[row, place], h[row, place] = values, times
    pointer, bad, first = np.zeros(total, np.int64), np.zeros(total, bool), np.cumsum(count) - count

    def close(p: np.ndarray, c: np.ndarray) -> np.ndarray:
        return np.abs(h[c, pointer[c]] - h[p, pointer[p]]) < hours

    for i in range(1, int(count.max(initial=0))):
        cur = first[count > i] + i
        prev = cur - 1
        for _ in range(rounds):
            hit = close(prev, cur)
            if not hit.any():
                break
            loses = v[prev, pointer[prev]] <= v[cur, pointer[cur]]
            pointer[prev] += hit & loses
            pointer[cur] += hit & ~loses
        bad[prev] = close(prev, cur)
    return pointer, bad


def monthly_max(series: DataFrame, hours: float = SEPARATION_H, rounds: int = MAX_ROUNDS, calendar: str | None = None, convention: str | None = None, check: bool | str = True) -> DataFrame:
    return separate(month_candidates(series, rounds, calendar, convention, check), hours, rounds)


def adjustment_counts(monthly: DataFrame) -> DataFrame:
    """n_events: exclusions in all; n_node_months: node-months that had any."""
    return monthly.agg(F.coalesce(F.sum("n_excluded"), F.lit(0)).cast("long").alias("n_events"), F.count_if("adjusted").alias("n_node_months"))


def block_max(series: DataFrame, hours: int = 72) -> DataFrame:
    """node_id, block, value, time_h, center_h: maxima of blocks of so many hours, counted from the series' first hour."""
    first = series.agg(F.min("time_h").alias("__first"))  # one row
    rows = series.crossJoin(F.broadcast(first)).withColumn("block", F.floor((F.col("time_h") - F.col("__first")) / hours).cast("long"))
    best = rows.groupBy("node_id", "block", "__first").agg(_top(F.col("value"), F.col("time_h")).alias("b"))
    return best.select("node_id", "block", F.col("b.v").alias("value"), (-F.col("b.h")).alias("time_h"), (F.col("__first") + (F.col("block") + 0.5) * hours).alias("center_h"))
