import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelake.functions import calendars as C
from tidelake.functions import naming
from tidelake.operators import extract, periods, spatial, stations, tides
from tidelake.plans import metadata, steps
from tidelake.schema import FILL, SERIES, check_dimensions, index_scheme
from tidelake.sources import files, sinks
from tidelake.streaming import incremental

H79 = 79 * 365 * 24 + 19 * 24.0  # 1979-01-01 00:00


def series(spark, rows):
    return spark.createDataFrame([(n, y, float(t), None if v is None else float(v)) for n, y, t, v in rows], SERIES)


def shifted_years(spark):
    out = []
    for year, start, n in ((1979, H79, 8760), (1980, H79 + 8760, 8784)):
        out += [(node, year, start + h, 100.0 if year == 1979 and h == n else 0.0) for node in (0, 1) for h in range(1, n + 1)]
    return series(spark, out)


def instant_years(spark):
    g = np.random.default_rng(3)
    return series(spark, [(0, y, s + h, g.normal()) for y, s, n in ((1979, H79, 8760), (1980, H79 + 8760, 8784)) for h in range(n)])


def test_conventions():
    assert C.epsilon("end") == 1.0 and C.epsilon("instant") == 0.0 and C.epsilon(None) == 0.0
    with pytest.raises(ValueError):
        C.epsilon("middle")
    assert check_dimensions(("time", "node")) and not check_dimensions(("node", "time"))
    with pytest.raises(ValueError):
        check_dimensions(("time", "station"))
    assert index_scheme(None)["base"] == 1
    with pytest.raises(ValueError):
        index_scheme("other")


def test_dates(spark):
    df = spark.createDataFrame([(24.0 * (360 * 78 + 59),), (24.0 * 59,), (24.0 * 58,)], "t double")
    got = df.select(C.date_of(F.col("t"), "360_day").alias("a"), C.date_of(F.col("t"), "noleap").alias("b"), C.date_of(F.col("t"), "360_day", "end").alias("c")).collect()
    assert tuple(got[0]["a"]) == (1978, 2, 30) and tuple(got[1]["b"]) == (1900, 3, 1) and tuple(got[2]["b"]) == (1900, 2, 28)
    assert tuple(got[1]["c"]) == (1900, 2, 29)
    for cal in ("standard", "360_day", "noleap", "all_leap", "julian"):
        d = C.date_of_day(F.col("id"), cal)
        back = spark.range(-800, 60000, 37).select("id", C.day_of_date(d["y"], d["m"], d["d"], cal).alias("again"))
        assert back.filter("id <> again").count() == 0
    x = spark.range(1).select(C.axis_hours(F.lit(2.0), "days since 1900-01-02 06:00:00").alias("h"), C.is_year_start(F.lit(H79)).alias("y"), C.is_year_start(F.lit(H79 + 1)).alias("n")).first()
    assert x["h"] == 78.0 and x["y"] and not x["n"]
    with pytest.raises(ValueError):
        C.calendar_name("lunar")


def test_carry_moves_the_last_instant(spark):
    days = periods.daily_max(shifted_years(spark)).filter("node_id = 0").collect()
    by = {(r["y"], r["m"], r["d"]): r["value"] for r in days}
    assert len(days) == 365 + 366 + 1
    assert by[1980, 1, 1] == 100 and by[1979, 12, 31] == 0 and by[1981, 1, 1] == 0
    months = {(r["y"], r["m"]): r["value"] for r in periods.monthly_max(shifted_years(spark)).filter("node_id = 0").collect()}
    assert len(months) == 25 and months[1980, 1] == 100 and months[1979, 12] == 0


def test_duplicates_are_an_error(spark):
    assert periods.daily_max(instant_years(spark)).count() == 365 + 366
    with pytest.raises(ValueError, match="instant"):
        periods.daily_max(instant_years(spark), convention="end")


def test_missing_values_keep_their_period(spark):
    s = series(spark, [(0, 1979, H79 + 1, FILL), (0, 1979, H79 + 2, float("nan")), (0, 1979, H79 + 30, 2), (0, 1979, H79 + 25, 2), (0, 1979, H79 + 50, None)])
    got = {r["d"]: (r["value"], r["time_h"]) for r in periods.daily_max(s).collect()}
    assert got == {1: (None, None), 2: (2.0, H79 + 25), 3: (None, None)}


def fold(months, hours, rounds=5):
    """The separation rule over whole lists of (hour, value), one list a month."""
    def best(cands, gone):
        left = [(-v, h) for h, v in cands if (h, v) not in gone]
        return (min(left)[1], -min(left)[0]) if left else None

    gone = [set() for _ in months]
    for i in range(1, len(months)):
        for _ in range(rounds):
            p, c = best(months[i - 1], gone[i - 1]), best(months[i], gone[i])
            if not p or not c or abs(p[0] - c[0]) >= hours:
                break
            gone[i - 1 if p[1] <= c[1] else i].add(p if p[1] <= c[1] else c)
    return [(best(m, g), len(g)) for m, g in zip(months, gone)]


def test_separation_against_a_plain_fold(spark):
    rng, rows, want = random.Random(7), [], {}
    for node in range(60):
        months, h = [], H79
        for m, n in enumerate((31, 28, 31, 30, 31, 30)):
            hours = sorted(rng.sample(range(n * 24), rng.choice((2, 5, 40))))
            months.append([(h + x, float(rng.choice((1, 2, 3, 9)))) for x in hours])
            rows += [(node, 1979, t, v) for t, v in months[-1]]
            h += n * 24
        want[node] = fold(months, 400)
    got = {}
    for r in periods.monthly_max(series(spark, rows), hours=400).orderBy("node_id", "y", "m").collect():
        got.setdefault(r["node_id"], []).append(((r["time_h"], r["value"]) if r["value"] is not None else None, r["n_excluded"]))
    assert got == want


def test_nearest_against_brute_force(spark):
    g = np.random.default_rng(5)
    pts = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(g.uniform(-180, 180, 60), g.uniform(-85, 85, 60)))] + [(60, 0.0, 0.0), (61, 0.0, 0.0)]
    mesh = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(g.uniform(-180, 180, 300), g.uniform(-85, 85, 300)))]
    got = {r["point_id"]: (r["node_index"], r["dist_km"]) for r in spatial.nearest(spark.createDataFrame(pts, "point_id long, lon double, lat double"), spark.createDataFrame(mesh, "node_index long, lon double, lat double"), max_km=1e6, cell_km=100.0).collect()}
    xyz = lambda r: 6371 * np.array([np.cos(np.radians(r[2])) * np.cos(np.radians(r[1])), np.cos(np.radians(r[2])) * np.sin(np.radians(r[1])), np.sin(np.radians(r[2]))])
    for p in pts:
        d = [np.linalg.norm(xyz(p) - xyz(m)) for m in mesh]
        assert got[p[0]][0] == int(np.argmin(d)) and abs(got[p[0]][1] - min(d)) < 1e-6
    assert len(got) == 62


def test_detiding_recovers_a_surge(spark):
    t = np.arange(0, 8766.0)
    x = H79 + t
    surge = 0.4 * np.exp(-(((t - 4000) / 30) ** 2))
    begin = x[0] + np.floor(t / 240) * 240
    middle = (begin + np.minimum(begin + 239, x[-1])) / 2
    a = tides.design(x, middle, x[0], t[-1], ["M2", "K1", "O1"])
    level = a @ np.array([0.3, 0.8, -0.4, 0.2, 0.1, 0.05, -0.1, 0.0]) + surge
    s = series(spark, [(7, 1979, h, v) for h, v in zip(x, level)] + [(8, 1979, h, None if i % 50 == 0 else v) for i, (h, v) in enumerate(zip(x, level))])
    for options in ({}, {"per_node_mask": True}):
        got = tides.detide(s, **options).filter("node_id = 7").orderBy("time_h").toPandas()["value"].to_numpy()
        full = tides.design(x, middle, x[0], t[-1], tides.resolvable(t[-1]))
        want = level - full @ np.linalg.lstsq(full, level, rcond=None)[0]
        assert np.abs(got - want).max() < 1e-5 and np.abs(got - surge).max() < 0.05
    masked = tides.detide(s, per_node_mask=True).filter("node_id = 8")
    assert masked.filter("value is null").count() == len(x[::50])
    with pytest.raises(ValueError):
        tides.detide(s, "360_day")
    with pytest.raises(ValueError):
        tides.detide(s.filter(F.col("time_h") < H79 + 160))
    assert abs(tides.speed("M2") - 28.9841) < 1e-3 and abs(tides.speed("K1") - 15.0411) < 1e-3 and len(tides.CONSTITUENTS) == 65


def test_windows_are_those_of_the_file(spark):
    """Nodes that start late, with MM and MF, against least squares written out in numpy."""
    g = np.random.default_rng(8)
    rows, names = [], ["MM", "MF"]
    for node, late in ((0, 0), (1, 130), (2, 517)):
        for year, start in ((1979, H79), (1980, H79 + 8760)):
            rows += [(node, year, start + h, g.normal()) for h in range(late, 8760, 3)]
    s = series(spark, rows)
    ts = np.array(sorted({(y, t) for _, y, t, _ in rows}))
    middle = {}
    for y, first in ((1979, H79), (1980, H79 + 8760)):
        own = ts[ts[:, 0] == y, 1]
        for k in np.unique(np.floor((own - first) / 240)):
            some = own[np.floor((own - first) / 240) == k]
            middle[y, int(k)] = (some.min() + some.max()) / 2
    mid = lambda y, t: middle[y, int((t - (H79 if y == 1979 else H79 + 8760)) // 240)]
    t0, total = ts[:, 1].min(), float(np.ptp(ts[:, 1]))

    def columns(pairs):
        h, m = np.array([t for _, t in pairs]) - t0, np.radians(tides.NODE_START + tides.NODE_RATE * np.array([mid(y, t) for y, t in pairs]))
        out = [np.ones_like(h)]
        for n in names:
            a, b, c = tides.NODAL[n]
            arg = np.radians(tides.speed(n) * h + c * np.sin(m))
            out += [(a + b * np.cos(m)) * np.cos(arg), (a + b * np.cos(m)) * np.sin(arg)]
        return np.stack([*out, h / total], 1)

    full = columns([(int(y), t) for y, t in ts])
    got = {(r["node_id"], r["file_year"], r["time_h"]): r["value"] for r in tides.detide(s, names=names).collect()}
    assert len(got) == len(rows)
    values = {(n, y, t): np.float64(np.float32(v)) for n, y, t, v in rows}
    for node in range(3):
        own = [(y, t) for n, y, t, _ in rows if n == node]
        a, v = columns(own), np.array([values[node, y, t] for y, t in own])
        want = v - a @ np.linalg.solve(full.T @ full, a.T @ v)
        assert np.abs(want - [got[node, y, t] for y, t in own]).max() < 1e-5


def test_extract(spark):
    mesh = spark.createDataFrame([(5, 1979, H79 + h, -99999.0 if h == 1 else h / 3) for h in range(4)] + [(6, 1979, H79, 1.0)], "node_index long, file_year int, time_h double, value double")
    nodes = spark.createDataFrame([(0, 5), (1, 5)], "node_id long, node_index long")
    got = extract.extract(mesh, nodes, "1979-01-01 00:00:00", "1979-01-01 02:00:00").collect()
    assert len(got) == 6 and sum(r["value"] is None for r in got) == 2
    assert extract.extract_sparse(mesh, nodes).count() == 4


GAUGE = "\n".join(["# SITE NAME: Abc", "# SITE CODE: A1", "# COUNTRY: X", "# LATITUDE 10.5", "# LONGITUDE: -3.25", "# START DATE/TIME 2000/01/01 00:00:00", "# END DATE/TIME 2001/01/01 00:00:00", "# TIME ZONE HOURS none", "# DATUM INFORMATION: Z0"] + ["#"] * 32)


def test_gauges(spark, tmp_path):
    data = ["2000/01/01 02:00:00 1.5 1 1", "2000/01/01 01:00:00 -99.9999 1 1", "2000/01/01 03:00:00 2.5 1 0", "2000/13/01 03:00:00 2.5 1 1", "2000/01/02 00:00:00 3.0 1 1"]
    (tmp_path / "a").write_text(GAUGE + "\n" + "\n".join(data))
    (tmp_path / "b").write_text(GAUGE.replace("# LATITUDE 10.5", "# LATITUDE north"))
    cat = files.station_catalogue(spark, str(tmp_path)).collect()
    assert len(cat) == 1
    r = cat[0]
    assert (r["site_name"], r["latitude"], r["longitude"], r["start_date"], r["timezone"], r["datum"]) == ("Abc", 10.5, -3.25, "2000/01/01", 0.0, "Z0")
    assert files.station_catalogue(spark, str(tmp_path), "2005-01-01", "2006-01-01").count() == 0
    assert sorted(x["sea_level"] for x in files.read_gauges(spark, str(tmp_path)).collect()) == [1.5, 3.0]
    assert files.read_gauges(spark, str(tmp_path), "2000-01-01 00:00:00", "2000-01-01 23:00:00").count() == 1


def test_skill(spark):
    rows = [(0, float(h), float(h % 7), float(h % 5)) for h in range(30)] + [(1, float(h), 1.0, 1.0) for h in range(5)] + [(2, float(h), 1.0, 2.0) for h in range(24)]
    df = spark.createDataFrame(rows, "k long, hour double, m double, o double")
    got = {r["k"]: r for r in stations.skill(df.select("k", "hour", F.col("m").alias("value")), df.select("k", "hour", F.col("o").alias("value")), ["k"]).collect()}
    assert set(got) == {0, 2} and got[2]["corr"] is None and got[2]["scatter_index"] is None and got[2]["bias"] == -1
    m, o = np.arange(30) % 7.0, np.arange(30) % 5.0
    assert got[0]["rmse"] == round(float(np.sqrt(((m - o) ** 2).mean())), 4) and got[0]["corr"] == round(float(np.corrcoef(m, o)[0, 1]), 4)


def test_names_and_metadata(tmp_path):
    meta = metadata.load(None, {"scenario": "S", "unknown": "x"}, group_name="G", climate_forcing="F", location="GESLA")
    assert naming.file_name(meta, "Hourly", "WaterLevel", 1979) == "twl_1hr_G_F_S_GESLA_197901-197912.nc"
    assert naming.time_range("1947-2025") == "194701-202512" and naming.time_range("197903") == "197903-197903"
    assert meta["forcing"] == "F" and "unknown" not in meta
    (tmp_path / "m.yaml").write_text("scenario: Y\nlicense: ''\nextra: 1\n")
    got = metadata.load(str(tmp_path / "m.yaml"), {"scenario": "S"}, scenario="", location="L")
    assert got["scenario"] == "Y" and got["extra"] == 1 and got["location"] == "L"
    for bad in ({}, {"group_name": "a_b", "climate_forcing": "F", "scenario": "S", "location": "L"}):
        with pytest.raises(ValueError):
            naming.check_naming(metadata.load(None, None, **bad))
    attrs = metadata.attributes(meta, "t", "s", "Hourly", "WaterLevel")
    assert attrs["institution_id"] == "G" and attrs["datum"] == "LMSL" and metadata.inherited(attrs)["group_name"] == "G"
    assert naming.point_set("GESLA")[1] == "GESLA" and naming.point_set("Q") == ("Q points", "Q")


def test_steps_end_to_end(spark, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame([(i, float(i), 10.0, 5.0) for i in range(4)], "node_index long, lon double, lat double, depth double").write.parquet(f"{d}/mesh")
    h = np.arange(0, 24 * 120)
    rows = [(i, 1979, H79 + float(k), float(np.cos(k / 12.4 * 2 * np.pi) + i)) for i in range(4) for k in h]
    spark.createDataFrame(rows, "node_index long, file_year int, time_h double, value double").write.partitionBy("file_year").parquet(f"{d}/in")
    (tmp_path / "p.csv").write_text(" Longitude , LATITUDE\n1.01,10\n3.0,10.01\n1.01,10\n")
    fields = {"group_name": "G", "climate_forcing": "F", "scenario": "S", "location": "L"}
    hourly = steps.extract(spark, f"{d}/p.csv", f"{d}/mesh", f"{d}/in", d, **fields)
    assert files.read_series(spark, hourly, [1979]).count() == 3 * len(h) and spark.read.parquet(f"{hourly}.nodes").count() == 3
    surge = steps.detide(spark, hourly, d, allow_rank_deficient=True)
    assert "ssgh_1hr_G_F_S_L_197901-197912" in surge and spark.read.parquet(surge).agg(F.max(F.abs("value"))).first()[0] < 0.2
    daily = steps.daily_max(spark, hourly, "WaterLevel", d)
    monthly = steps.monthly_max(spark, hourly, "WaterLevel", d)
    assert spark.read.parquet(daily).count() == 3 * 120 and files.read_attrs(spark, monthly)["frequency"] == "mon"
    assert sinks.is_done(spark, daily) and not sinks.write_table(spark.range(1).toDF("x"), daily)


def test_streams(spark, tmp_path):
    d = str(tmp_path)
    x = np.arange(0, 1000.0) + H79
    s = series(spark, [(n, 1979, t, np.sin(t / 3)) for n in (1, 2) for t in x])
    s.write.parquet(f"{d}/in")
    stream = incremental.stream_series(spark, f"{d}/in", 1)
    # A file of the stream must hold whole node-years: write one.
    s.coalesce(1).write.mode("overwrite").parquet(f"{d}/in")
    incremental.accumulate(stream, f"{d}/out", f"{d}/cp", H79, 999.0, ["M2"])
    got = {r["node_id"]: r["__aty"] for r in incremental.summed(spark, f"{d}/out", 4).collect()}
    want = {r["node_id"]: r["__aty"] for r in tides.node_sums(tides.pack(s), H79, 999.0, ["M2"]).collect()}
    assert set(got) == {1, 2} and all(np.allclose(got[n], want[n]) for n in got)
