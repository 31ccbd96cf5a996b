"""Monthly maxima of a stream of files, with the separation rule as keyed state.

A node's state is what the batch form folds over: the month before, whose value is still
open to the month after it, and the month that is being filled, each as its largest values (never
more than 2 * rounds + 1). A row of a later month closes the one being filled: the two are
settled, the earlier is final and leaves, the later takes its place. An event-time timer
closes both when the watermark passes the month that could follow, so the last months
of a node that falls silent come out too; months that far apart can't be too close.

A year's file may end with the first instant of the next; that instant waits in its
month for the next file, which owns it. A month that rows of two files claim
otherwise is an error, as in the batch form.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidelake.functions import calendars as C
from tidelake.operators.periods import MAX_ROUNDS, SEPARATION_H, fold, valid

RESULT = "node_id long, ym int, value double, time_h double, n_excluded int, residual_violation boolean"
#: The state: for the month before (p) and the month being filled (c), its number, values and times in order of rank; values that the month before gave up; the file that owns the other.
STATE = "p_ym int, p_v array<double>, p_h array<double>, p_gone int, c_ym int, c_v array<double>, c_h array<double>, owner int"


class MonthlyMaxima(StatefulProcessor):
    def __init__(self, hours: float, rounds: int):
        self.hours, self.rounds = hours, rounds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("months", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        given = pd.concat(list(rows))
        held = list(self.state.get()) if self.state.exists() else [None, [], [], 0, None, [], [], None]
        out: list[tuple] = []
        last = given.groupby("file_year")["h"].transform("max")
        given = given.assign(owner=np.where(given["starts_year"] & (given["h"] == last), -1, given["file_year"]))
        for ym, month in given.sort_values(["ym", "h"], kind="stable").groupby("ym"):
            owners = set(month["owner"]) - {-1}
            if held[4] is None or ym > held[4]:
                held = self._closed(held, out)
                held[4], held[5], held[6], held[7] = int(ym), [], [], None
            elif ym < held[4]:
                raise ValueError(f"month {ym} of node {key[0]} is closed: files must come in their order")
            if held[7] is not None:
                owners.add(held[7])
            if len(owners) > 1:
                raise ValueError(f"month {ym} is owned by several files: {sorted(owners)}")
            held[7] = int(next(iter(owners))) if owners else None
            some = month.dropna(subset=["v"])
            v, h = np.append(held[5], some["v"]).astype(float), np.append(held[6], some["h"]).astype(float)
            order = np.lexsort((h, -v))[: 2 * self.rounds + 1]
            held[5], held[6] = v[order].tolist(), h[order].tolist()
        self.state.update(tuple(held))
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(self._ends(held[4]))
        yield self._frame(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        if self.state.exists():
            held = self._closed(list(self.state.get()), out)
            if held[0] is not None:
                out.append(self._final(held, False))
            self.state.clear()
        yield self._frame(key, out)

    def close(self) -> None:
        pass

    def _ends(self, ym: int) -> int:
        """Milliseconds at which the month after next begins, and a day: nothing that could be too close comes after that."""
        year, month = divmod(ym + 2, 12)
        return int(pd.Timestamp(year, month + 1, 2).timestamp() * 1000)

    def _closed(self, held: list, out: list[tuple]) -> list:
        """The state after the month being filled is complete: the month before it is final."""
        if held[4] is None:
            return held
        gone = 0
        if held[0] is not None:
            sizes = np.array([len(held[1]) - held[3], len(held[5])])
            values, times = (np.array([*a[held[3] :], *b]) for a, b in ((held[1], held[5]), (held[2], held[6])))
            pointer, bad = fold(np.array([2]), sizes, values, times, self.hours, self.rounds)
            held[3] += int(pointer[0])
            gone = int(pointer[1])
            out.append(self._final(held, bool(bad[0])))
        return [held[4], held[5], held[6], gone, None, [], [], None]

    def _final(self, held: list, bad: bool) -> tuple:
        k = held[3]
        there = k < len(held[1])
        return held[0], held[1][k] if there else None, held[2][k] if there else None, k, bad

    def _frame(self, key, out: list[tuple]) -> pd.DataFrame:
        columns = list(zip(*out)) or [()] * 5
        return pd.DataFrame({
            "node_id": pd.array([key[0]] * len(out), "int64"), "ym": pd.array(columns[0], "int32"), "value": pd.array(columns[1], "Float64"), "time_h": pd.array(columns[2], "Float64"),
            "n_excluded": pd.array(columns[3], "int32"), "residual_violation": pd.array(columns[4], bool),
        })


def monthly_max_stream(series: DataFrame, hours: float = SEPARATION_H, rounds: int = MAX_ROUNDS, convention: str | None = None, late: str = "0 seconds") -> DataFrame:
    """node_id, y, m, value (double), time_h, adjusted, n_excluded, residual_violation of a stream of series rows, file by file in order.

    Standard calendars (the watermark is a timestamp); hours up to 28 days. Needs the RocksDB state store.
    """
    if hours > 28 * 24:
        raise ValueError("a stream closes months a month after them, so they can be kept apart by 28 days at most")
    month = C.month_of(F.col("time_h"), None, convention)
    rows = series.withColumn("ts", C.timestamp_of(F.col("time_h")).cast("timestamp")).withWatermark("ts", late)
    rows = rows.select("node_id", "ts", "file_year", (month["y"] * 12 + month["m"] - 1).cast("int").alias("ym"), valid(F.col("value")).cast("double").alias("v"), F.col("time_h").alias("h"), C.is_year_start(F.col("time_h")).alias("starts_year"))
    got = rows.groupBy("node_id").transformWithStateInPandas(MonthlyMaxima(hours, rounds), RESULT, "Append", "eventTime")
    return got.select("node_id", F.floor(F.col("ym") / 12).cast("int").alias("y"), (F.pmod("ym", F.lit(12)) + 1).cast("int").alias("m"), "value", "time_h", (F.col("n_excluded") > 0).alias("adjusted"), "n_excluded", "residual_violation")
