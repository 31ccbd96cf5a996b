"""Harmonic detiding: least squares over the whole record, the tide subtracted.

The model's columns are 1, f cos(arg) and f sin(arg) for each constituent, and the
share of the record's length. A'A depends on the times alone; A'Y is summed per
node over packed node-years, and each node's coefficients are solved where its row
lies, against the one small matrix. Nothing per node reaches the driver.
f and u change by windows of 240 h from a file's first hour, whenever a node's own
series starts, and hold for the middle of a window's times.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions import calendars as C
from tidelake.operators.periods import valid
from tidelake.sources import scratch

NODAL_HOURS = 240.0

# Rates in degrees an hour of tau, s, h, p and p1, and the constituents' Doodson numbers for them.
RATES = np.array([15 - 0.5490165 + 0.0410686, 0.5490165, 0.0410686, 0.0046418, 0.00000196])
CONSTITUENTS = {
    "MSM": (0, 1, -2, 1, 0), "MM": (0, 1, 0, -1, 0), "MSF": (0, 2, -2, 0, 0), "MF": (0, 2, 0, 0, 0),
    "alpha1": (1, -4, 2, 1, 0), "2Q1": (1, -3, 0, 2, 0), "sigma1": (1, -3, 2, 0, 0), "Q1": (1, -2, 0, 1, 0), "rho1": (1, -2, 2, -1, 0), "O1": (1, -1, 0, 0, 0),
    "tau1": (1, -1, 2, 0, 0), "beta1": (1, 0, -2, 1, 0), "NO1": (1, 0, 0, 1, 0), "chi1": (1, 0, 2, -1, 0), "pi1": (1, 1, -3, 0, 1), "P1": (1, 1, -2, 0, 0),
    "S1": (1, 1, -1, 0, 1), "K1": (1, 1, 0, 0, 0), "psi1": (1, 1, 1, 0, -1), "phi1": (1, 1, 2, 0, 0), "theta1": (1, 2, -2, 1, 0), "J1": (1, 2, 0, -1, 0),
    "SO1": (1, 3, -2, 0, 0), "OO1": (1, 3, 0, 0, 0), "upsilon1": (1, 4, 0, -1, 0),
    "OQ2": (2, -3, 0, 3, 0), "epsilon2": (2, -3, 2, 1, 0), "2N2": (2, -2, 0, 2, 0), "mu2": (2, -2, 2, 0, 0), "N2": (2, -1, 0, 1, 0), "nu2": (2, -1, 2, -1, 0),
    "H1": (2, 0, -1, 0, 1), "M2": (2, 0, 0, 0, 0), "H2": (2, 0, 1, 0, -1), "MKS2": (2, 0, 2, 0, 0), "lambda2": (2, 1, -2, 1, 0), "L2": (2, 1, 0, -1, 0),
    "T2": (2, 2, -3, 0, 1), "S2": (2, 2, -2, 0, 0), "R2": (2, 2, -1, 0, -1), "K2": (2, 2, 0, 0, 0), "MSN2": (2, 3, -2, -1, 0), "eta2": (2, 3, 0, -1, 0),
    "MO3": (3, -1, 0, 0, 0), "M3": (3, 0, 0, 0, 0), "SO3": (3, 1, -2, 0, 0), "MK3": (3, 1, 0, 0, 0), "SK3": (3, 3, -2, 0, 0),
    "MN4": (4, -1, 0, 1, 0), "M4": (4, 0, 0, 0, 0), "SN4": (4, 1, -2, 1, 0), "MS4": (4, 2, -2, 0, 0), "MK4": (4, 2, 0, 0, 0), "S4": (4, 4, -4, 0, 0), "SK4": (4, 4, -2, 0, 0),
    "2MK5": (5, 1, 0, 0, 0), "2SK5": (5, 5, -4, 0, 0),
    "2MN6": (6, -1, 0, 1, 0), "M6": (6, 0, 0, 0, 0), "2MS6": (6, 2, -2, 0, 0), "2MK6": (6, 2, 0, 0, 0), "2SM6": (6, 4, -4, 0, 0), "MSK6": (6, 4, -2, 0, 0),
    "3MK7": (7, 1, 0, 0, 0), "M8": (8, 0, 0, 0, 0),
}
# The annual and semi-annual constituents, which are no tide.
EXCLUDED = ("Sa", "Ssa")
# Longitude of the moon's node in degrees at 1900-01-01 00:00, and its rate in degrees an hour.
NODE_START, NODE_RATE = 259.157, -0.00220641
# f = a + b cos N and u = c sin N (degrees) of the lunar constituents.
NODAL = {
    "MM": (1.0, -0.130, 0.0), "MF": (1.043, 0.414, -23.7), "O1": (1.009, 0.187, 10.8), "K1": (1.006, 0.115, -8.9), "J1": (1.013, 0.168, -12.9),
    "OO1": (1.103, 0.650, -36.7), "M2": (1.0, -0.037, -2.1), "K2": (1.024, 0.286, -17.7), "M3": (1.0, -0.056, -3.2),
}
# The products of those that the others follow.
_FOLLOWS = {
    "MSM": {"MM": 1}, "MSF": {"M2": 1}, "alpha1": {"O1": 1}, "2Q1": {"O1": 1}, "sigma1": {"O1": 1}, "Q1": {"O1": 1}, "rho1": {"O1": 1}, "tau1": {"O1": 1}, "beta1": {"O1": 1}, "NO1": {"O1": 1},
    "chi1": {"J1": 1}, "theta1": {"J1": 1}, "SO1": {"O1": 1}, "upsilon1": {"OO1": 1}, "OQ2": {"O1": 2}, "epsilon2": {"M2": 1}, "2N2": {"M2": 1}, "mu2": {"M2": 1}, "N2": {"M2": 1}, "nu2": {"M2": 1},
    "H1": {"M2": 1}, "H2": {"M2": 1}, "MKS2": {"M2": 1, "K2": 1}, "lambda2": {"M2": 1}, "L2": {"M2": 1}, "MSN2": {"M2": 2}, "eta2": {"K2": 1},
    "MO3": {"M2": 1, "O1": 1}, "SO3": {"O1": 1}, "MK3": {"M2": 1, "K1": 1}, "SK3": {"K1": 1}, "MN4": {"M2": 2}, "M4": {"M2": 2}, "SN4": {"M2": 1}, "MS4": {"M2": 1}, "MK4": {"M2": 1, "K2": 1}, "SK4": {"K2": 1},
    "2MK5": {"M2": 2, "K1": 1}, "2SK5": {"K1": 1}, "2MN6": {"M2": 3}, "M6": {"M2": 3}, "2MS6": {"M2": 2}, "2MK6": {"M2": 2, "K2": 1}, "2SM6": {"M2": 1}, "MSK6": {"M2": 1, "K2": 1}, "3MK7": {"M2": 3, "K1": 1}, "M8": {"M2": 4},
}


def speed(name: str) -> float:
    """Degrees an hour."""
    return float(np.dot(RATES, CONSTITUENTS[name]))


def resolvable(total_hours: float, names: list[str] | None = None) -> list[str]:
    """The constituents that turn more than twice in the record."""
    return [n for n in names or list(CONSTITUENTS) if 720.0 < total_hours * speed(n)]


def resolvable_in(total_hours: Column, names: list[str] | None = None) -> Column:
    """resolvable as an array column, for records of total_hours each."""
    turns = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(speed(n)).alias("speed")) for n in names or CONSTITUENTS))
    return F.transform(F.filter(turns, lambda x: total_hours * x["speed"] > 720.0), lambda x: x["name"])


def nodal(name: str, time_h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Factor f and phase u (degrees) at the times."""
    node = np.radians(NODE_START + NODE_RATE * time_h)
    f, u = np.ones_like(time_h), np.zeros_like(time_h)
    for part, power in (_FOLLOWS.get(name) or ({name: 1} if name in NODAL else {})).items():
        a, b, c = NODAL[part]
        f = f * (a + b * np.cos(node)) ** power
        u = u + power * c * np.sin(node)
    return f, u


def design(time_h: np.ndarray, middle: np.ndarray, t0: float, total_hours: float, names: list[str]) -> np.ndarray:
    """Rows of the model for the times; f and u are those of their windows' middles."""
    h = time_h - t0
    out = [np.ones_like(h)]
    for n in names:
        f, u = nodal(n, middle)
        arg = np.radians(speed(n) * h + u)
        out += [f * np.cos(arg), f * np.sin(arg)]
    return np.stack([*out, h / total_hours], 1)


def window_middles(series: DataFrame, hours: float = NODAL_HOURS) -> DataFrame:
    """file_year, __start, __mids: each file's first hour, and the middles of its windows of `hours` from there.

    The middle of a window lies between its first and its last time; one without times has its plain middle. There is a row for each file.
    """
    starts = series.groupBy("file_year").agg(F.min("time_h").alias("__start"))
    k = F.floor((F.col("time_h") - F.col("__start")) / hours).cast("int")
    each = series.join(F.broadcast(starts), "file_year").groupBy("file_year", "__start", k.alias("__k")).agg(((F.min("time_h") + F.max("time_h")) / 2).alias("__mid"))
    known = each.groupBy("file_year", "__start").agg(F.map_from_entries(F.collect_list(F.struct("__k", "__mid"))).alias("__m"), F.max("__k").alias("__n"))
    plain = lambda i: F.col("__start") + (i + 0.5) * hours
    return known.select("file_year", "__start", F.transform(F.sequence(F.lit(0), "__n"), lambda i: F.coalesce(F.try_element_at("__m", i), plain(i))).alias("__mids"))


def _known_middles(series: DataFrame) -> DataFrame:
    """window_middles, computed once: a row for each file comes to the driver."""
    found = window_middles(series)
    return series.sparkSession.createDataFrame(found.collect(), found.schema)


def _middles(ts: np.ndarray, start: float, mids: np.ndarray) -> np.ndarray:
    return mids[np.floor((ts - start) / NODAL_HOURS).astype(np.int64)]


class _Designs:
    """Design matrices of the time axes that rows of one file share: one at a time, built again only where file or axis changes."""

    def __init__(self, t0: float, total: float, names: list[str]):
        self.fit, self.key, self.ts, self.a = (t0, total, names), None, np.zeros(0), np.zeros((0, 0))

    def same(self, year: int, ts: np.ndarray) -> bool:
        return self.key == year and len(ts) == len(self.ts) and np.array_equal(ts, self.ts)

    def of(self, year: int, ts: np.ndarray, start: float, mids: np.ndarray) -> np.ndarray:
        ts = np.asarray(ts, float)
        if not self.same(year, ts):
            self.key, self.ts, self.a = year, ts, design(ts, _middles(ts, start, np.asarray(mids, float)), *self.fit)
        return self.a

    def blocks(self, pdf: pd.DataFrame, most: int = 256) -> Iterator[tuple[slice, np.ndarray]]:
        """Stretches of at most `most` rows that share file and axis, and their design: one product serves them all."""
        years, axes = pdf["file_year"].to_numpy(), [np.asarray(x, float) for x in pdf["__ts"]]
        at = 0
        while at < len(pdf):
            a = self.of(years[at], axes[at], pdf["__start"].iloc[at], pdf["__mids"].iloc[at])
            stop = at + 1
            while stop < len(pdf) and stop - at < most and self.same(years[stop], axes[stop]):
                stop += 1
            yield slice(at, stop), a
            at = stop


def record(series: DataFrame) -> tuple[float, float]:
    """First hour of the record and hours from first to last."""
    row = series.agg(F.min("time_h").alias("a"), F.max("time_h").alias("b")).first()
    return row["a"], row["b"] - row["a"]


def pack(series: DataFrame, mids: DataFrame | None = None) -> DataFrame:
    """A row for each node and file: __ts and __vs, its times in order and their values (null where missing), and its file's __start and __mids.

    Rows are dealt by node and stand in the order of the files, so that those of one file, whose
    times are mostly the same, follow one another.
    """
    rows = F.array_sort(F.collect_list(F.struct("time_h", valid(F.col("value")).cast("double").alias("v"))))
    packed = series.groupBy("node_id", "file_year").agg(rows.alias("__r")).join(F.broadcast(window_middles(series) if mids is None else mids), "file_year")
    out = packed.select("node_id", "file_year", F.col("__r.time_h").alias("__ts"), F.col("__r.v").alias("__vs"), "__start", "__mids")
    return out.sortWithinPartitions("file_year", F.hash("__ts"))


def axis_of(series: DataFrame) -> DataFrame:
    """file_year, time_h: the distinct times of each file."""
    return series.select("file_year", "time_h").distinct()


def file_matrices(axis: DataFrame, t0: float, total: float, names: list[str], mids: DataFrame | None = None) -> DataFrame:
    """file_year, a: A'A over the distinct times of each file (row by row), summed in tasks first."""
    mids = window_middles(axis) if mids is None else mids
    at = F.floor((F.col("time_h") - F.col("__start")) / NODAL_HOURS).cast("int")
    rows = axis_of(axis).join(F.broadcast(mids), "file_year").select("file_year", "time_h", F.get("__mids", at).alias("__mid"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for pdf in parts:
            for year, of_year in pdf.groupby("file_year"):
                for k in range(0, len(of_year), 8192):
                    part = of_year.iloc[k : k + 8192]
                    a = design(part["time_h"].to_numpy(), part["__mid"].to_numpy(), t0, total, names)
                    sums[year] = sums.get(year, 0) + a.T @ a
        if sums:
            yield pd.DataFrame({"file_year": list(sums), "a": [x.ravel() for x in sums.values()]})

    each = rows.mapInPandas(run, "file_year int, a array<double>").select("file_year", F.posexplode("a")).groupBy("file_year", "pos").agg(F.sum("col").alias("x"))
    return each.groupBy("file_year").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda c: c["x"]).alias("a"))


def normal_matrix(series: DataFrame, t0: float, total: float, names: list[str], mids: DataFrame | None = None) -> np.ndarray:
    """A'A over the distinct times of each file: a small matrix a file comes back."""
    k = 2 * len(names) + 2
    return sum((np.array(r["a"]).reshape(k, k) for r in file_matrices(series, t0, total, names, mids).orderBy("file_year").collect()), np.zeros((k, k)))


def file_sums(packed: DataFrame, t0: float, total: float, names: list[str]) -> DataFrame:
    """node_id, file_year, __aty: A'Y of each node's part of each file. Missing values count as 0."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        designs = _Designs(t0, total, names)
        for pdf in parts:
            sums: list[np.ndarray] = []
            for rows, a in designs.blocks(pdf):
                sums += list(np.nan_to_num(np.array([np.asarray(v, float) for v in pdf["__vs"].iloc[rows]])) @ a)
            yield pdf[["node_id", "file_year"]].assign(__aty=sums)

    return packed.mapInPandas(run, "node_id long, file_year int, __aty array<double>")


def added(sums: DataFrame, width: int) -> DataFrame:
    """node_id, __aty: the arrays of each node, added up in the order of the files."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("file_year", "__aty"))), lambda x: x["__aty"])
    add = F.aggregate(ordered, F.array_repeat(F.lit(0.0), width), lambda s, x: F.zip_with(s, x, lambda p, q: p + q))
    return sums.groupBy("node_id").agg(add.alias("__aty"))


def node_sums(packed: DataFrame, t0: float, total: float, names: list[str]) -> DataFrame:
    """node_id, __aty: A'Y of each node. Missing values count as 0."""
    return added(file_sums(packed, t0, total, names), 2 * len(names) + 2)


def solved(sums: DataFrame, ata: np.ndarray, allow_rank_deficient: bool = False) -> DataFrame:
    """node_id, __c: the coefficients of sums (node_id, __aty) against the shared A'A, each where its row lies."""
    if np.linalg.matrix_rank(ata, hermitian=True) < len(ata) and not allow_rank_deficient:
        raise ValueError(f"the record can't tell {len(ata) // 2 - 1} constituents apart; pass fewer, or allow_rank_deficient=True")
    inverse = np.linalg.pinv(ata, hermitian=True) if allow_rank_deficient else np.linalg.inv(ata)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pdf[["node_id"]].assign(__c=[inverse @ np.asarray(y) for y in pdf["__aty"]])

    return sums.mapInPandas(run, "node_id long, __c array<double>")


def coefficients(series: DataFrame, names: list[str] | None = None, allow_rank_deficient: bool = False, per_node_mask: bool = False, mids: DataFrame | None = None, packed: DataFrame | None = None) -> tuple[DataFrame, dict]:
    """node_id, __c (coefficients), and what the fit rests on: t0, total_hours, constituents.

    By default a missing value counts as 0 against the full A'A that all nodes
    share; per_node_mask fits each node to its own valid hours instead.
    """
    axis = scratch.stored(axis_of(series), "axis")
    t0, total = record(axis)
    names = resolvable(total, names)
    mids = _known_middles(axis) if mids is None else mids
    packed = pack(series, mids) if packed is None else packed
    sums, info = node_sums(packed, t0, total, names), {"t0": t0, "total_hours": total, "constituents": names}
    matrices = file_matrices(axis, t0, total, names, mids)
    ata = normal_matrix(axis, t0, total, names, mids)
    if np.linalg.matrix_rank(ata, hermitian=True) < len(ata) and not allow_rank_deficient:
        raise ValueError(f"a record of {total:g} h can't tell {len(names)} constituents apart; pass fewer, or allow_rank_deficient=True")
    if per_node_mask:
        return _masked(packed, sums, axis, matrices, t0, total, names), info
    return solved(sums, ata, allow_rank_deficient), info


def _masked(packed: DataFrame, sums: DataFrame, axis: DataFrame, matrices: DataFrame, t0: float, total: float, names: list[str]) -> DataFrame:
    """node_id, __c: each node's fit to its own valid hours, by changing the files' shared A'A.

    A node's A'A is that of its files less the products of the rows that it lacks (and plus those of times that it has twice):
    a change of as low a rank as there are such hours. Where it lacks more than half of a file, the rows that it has
    are multiplied instead, as a small difference of large sums would lose their digits. A'Y is that of
    the shared fit, in which missing values are 0. What the tasks need of all files is a row a file.
    """
    k = 2 * len(names) + 2
    times = axis.groupBy("file_year").agg(F.array_sort(F.collect_list("time_h")).alias("ts"))
    mids = packed.select("file_year", "__start", "__mids").dropDuplicates(["file_year"])
    found = times.join(matrices, "file_year").join(mids, "file_year").collect()
    files = packed.sparkSession.sparkContext.broadcast({r["file_year"]: (np.array(r["ts"]), np.array(r["a"]).reshape(k, k), r["__start"], np.array(r["__mids"])) for r in found})

    def differing(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            ats, ns = [], []
            for year, ts, vs in zip(pdf["file_year"], pdf["__ts"], pdf["__vs"]):
                full = files.value[year][0]
                here = np.bincount(np.searchsorted(full, np.asarray(ts, float)[~np.isnan(np.asarray(vs, float))]), minlength=len(full))
                most = np.count_nonzero(here != 1) > len(full) // 2
                ats.append(np.flatnonzero(here if most else here != 1).astype(np.int32))
                ns.append((here if most else here - 1)[ats[-1]].astype(np.int32))
                if most:  # told by a first place below 0
                    ats[-1], ns[-1] = np.append(np.int32(-1), ats[-1]), np.append(np.int32(0), ns[-1])
            yield pdf[["node_id", "file_year"]].assign(ats=ats, ns=ns)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            out = []
            for aty, own in zip(pdf["__aty"], pdf["files"]):
                ata = np.zeros((k, k))
                for part in own:
                    full, shared, start, middles = files.value[part["file_year"]]
                    at, n = np.asarray(part["ats"]), np.asarray(part["ns"], float)
                    if len(at) and at[0] < 0:
                        at, n = at[1:], n[1:]
                    else:
                        ata += shared
                    rows = design(full[at], _middles(full[at], start, middles), t0, total, names)
                    ata += (rows * n[:, None]).T @ rows
                out.append(np.linalg.lstsq(ata, np.asarray(aty), rcond=None)[0])
            yield pdf[["node_id"]].assign(__c=out)

    each = packed.mapInPandas(differing, "node_id long, file_year int, ats array<int>, ns array<int>")
    own = each.groupBy("node_id").agg(F.array_sort(F.collect_list(F.struct("file_year", "ats", "ns"))).alias("files"))
    return sums.join(own, "node_id").mapInPandas(run, "node_id long, __c array<double>")


def subtract(packed: DataFrame, fitted: DataFrame, info: dict) -> DataFrame:
    """node_id, file_year, time_h, value (float): the packed series less the tide of the fitted coefficients; null where it was missing."""
    t0, total, used = info["t0"], info["total_hours"], info["constituents"]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        designs = _Designs(t0, total, used)
        for pdf in parts:
            left: list[np.ndarray] = []
            for rows, a in designs.blocks(pdf):
                values = np.array([np.asarray(v, float) for v in pdf["__vs"].iloc[rows]])
                left += list(values - np.stack(pdf["__c"].iloc[rows].to_list()) @ a.T)
            yield pdf[["node_id", "file_year", "__ts"]].assign(__ys=left)

    joined = packed.join(fitted, "node_id").sortWithinPartitions("file_year", F.hash("__ts"))
    done = joined.mapInPandas(run, "node_id long, file_year int, __ts array<double>, __ys array<double>")
    rows = done.select("node_id", "file_year", F.explode(F.arrays_zip("__ts", "__ys")).alias("r"))
    return rows.select("node_id", "file_year", F.col("r.__ts").alias("time_h"), F.nanvl("r.__ys", F.lit(None)).cast("float").alias("value"))


def check_calendar(calendar: str | None) -> None:
    if C.calendar_name(calendar) != "standard":
        raise ValueError(f"detiding needs a standard calendar, not {calendar!r}")


def fit(series: DataFrame, calendar: str | None = None, names: list[str] | None = None, **options) -> tuple[DataFrame, DataFrame, dict]:
    """The packed series, stored once for both passes, the coefficients and what they rest on."""
    check_calendar(calendar)
    mids = _known_middles(series)
    packed = scratch.stored(pack(series, mids), "packed")
    return packed, *coefficients(series, names, mids=mids, packed=packed, **options)


def detide(series: DataFrame, calendar: str | None = None, names: list[str] | None = None, **options) -> DataFrame:
    """node_id, file_year, time_h, value (float): the series less its fitted tide; null where it was missing."""
    return subtract(*fit(series, calendar, names, **options))


def harmonic_sums(series: DataFrame, name: str = "M2") -> DataFrame:
    """n and the sums of cos, sin, their products and their products with the value, for one constituent per node: its normal equations, JVM-side."""
    w = np.radians(speed(name))
    c, s, v = F.cos(F.col("time_h") * w), F.sin(F.col("time_h") * w), F.col("value")
    sums = {"s_c": c, "s_s": s, "s_cc": c * c, "s_ss": s * s, "s_cs": c * s, "s_y": v, "s_cy": c * v, "s_sy": s * v}
    return series.groupBy("node_id").agg(F.count("*").alias("n"), *(F.sum(x).alias(k) for k, x in sums.items()))


def harmonic_fit(series: DataFrame, name: str = "M2") -> DataFrame:
    """node_id, mean, cos_amp, sin_amp of mean plus one constituent, from the 3 x 3 normal equations in closed form."""
    n, a, b, p, q, r, y, cy, sy = (F.col(c).cast("double") for c in ("n", "s_c", "s_s", "s_cc", "s_ss", "s_cs", "s_y", "s_cy", "s_sy"))
    m00, m01, m02 = p * q - r * r, b * r - a * q, a * r - b * p
    m11, m12, m22 = n * q - b * b, a * b - n * r, n * p - a * a
    det = n * m00 + a * m01 + b * m02
    ok = F.abs(det) > 1e-6
    out = {"mean": (m00 * y + m01 * cy + m02 * sy) / det, "cos_amp": (m01 * y + m11 * cy + m12 * sy) / det, "sin_amp": (m02 * y + m12 * cy + m22 * sy) / det}
    return harmonic_sums(series, name).select("node_id", "n", *(F.when(ok, x).alias(k) for k, x in out.items()))


def linear_trend(series: DataFrame) -> DataFrame:
    """node_id, slope and intercept of the value over hours."""
    return series.groupBy("node_id").agg(F.regr_slope("value", "time_h").alias("slope"), F.regr_intercept("value", "time_h").alias("intercept"))


def nodal_window(series: DataFrame, hours: float = NODAL_HOURS) -> DataFrame:
    """series with nodal_window: the number of its window from its file's first hour."""
    starts = series.groupBy("file_year").agg(F.min("time_h").alias("__start"))
    return series.join(F.broadcast(starts), "file_year").withColumn("nodal_window", F.floor((F.col("time_h") - F.col("__start")) / hours).cast("long")).drop("__start")
