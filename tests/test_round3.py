"""The restartable fit, fits to own hours, the spatial index, the fold in tasks and guards, against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelake.operators import periods, spatial, tides
from tidelake.schema import SERIES
from tidelake.streaming import incremental

H79 = 79 * 365 * 24 + 19 * 24.0  # 1979-01-01 00:00


def series(spark, rows):
    return spark.createDataFrame([(n, y, float(t), None if v is None else float(v)) for n, y, t, v in rows], SERIES)


def three_files(spark, late=130):
    """Two nodes over three files; the second starts late in each, the first misses some hours."""
    g = np.random.default_rng(4)
    rows = []
    for k, year in enumerate((1979, 1980, 1981)):
        start = H79 + 8760 * k
        rows += [(0, year, start + h, None if h % 90 == 0 else g.normal()) for h in range(0, 8760, 6)]
        rows += [(1, year, start + h, g.normal()) for h in range(late, 8760, 6)]
    return rows


def fitted(frame):
    return {r["node_id"]: np.array(r["__c"]) for r in frame.collect()}


def same(a, b):
    return set(a) == set(b) and all(np.allclose(a[k], b[k], rtol=1e-9, atol=1e-9) for k in a)


def test_a_fit_that_stops_after_any_file_goes_on(spark, tmp_path):
    s, names = series(spark, three_files(spark)), ["MM", "MF"]
    whole, info = tides.coefficients(s, names)
    want = fitted(whole)
    for stops in (1, 2):
        out = str(tmp_path / f"after{stops}")
        first = incremental.Fit(spark, out, s, names)
        assert first.add(s, most=stops) == [1979, 1980, 1981][:stops]
        (tmp_path / f"after{stops}" / first.path.rsplit("/", 1)[1] / "aty" / f"file={1979 + stops}").mkdir(parents=True)  # killed amid the next file
        again = incremental.Fit(spark, out, s, names)
        assert again.path == first.path and again.add(s) == [1979, 1980, 1981][stops:] and again.add(s) == []
        got, told = again.solve()
        assert same(fitted(got), want) and told == info
    surge = {(r["node_id"], r["time_h"]): r["value"] for r in again.detide(s).collect()}
    plain = {(r["node_id"], r["time_h"]): r["value"] for r in tides.detide(s, names=names).collect()}
    assert surge.keys() == plain.keys() and all((a is None) == (plain[k] is None) and (a is None or abs(a - plain[k]) < 1e-5) for k, a in surge.items())


def test_sums_of_another_record_are_left_alone(spark, tmp_path):
    s, names = series(spark, three_files(spark)), ["MM", "MF"]
    one = incremental.Fit(spark, str(tmp_path), s, names)
    one.add(s)
    later = s.filter(F.col("time_h") >= H79 + 50)
    other = incremental.Fit(spark, str(tmp_path), later, names)
    fewer = incremental.Fit(spark, str(tmp_path), s, ["MM"])
    assert len({one.path, other.path, fewer.path}) == 3 and other.add(later) == [1979, 1980, 1981]
    with pytest.raises(ValueError):
        fewer.solve()
    assert same(fitted(other.solve()[0]), fitted(tides.coefficients(later, names)[0]))


def test_streamed_sums_of_late_nodes(spark, tmp_path):
    """A file whose nodes arrive in two batches, one of them starting 130 h late, gives the sums of one pass."""
    rows, names = three_files(spark), ["MM", "MF"]
    s = series(spark, rows)
    for node in (0, 1):
        s.filter(F.col("node_id") == node).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    t0, total = tides.record(s)
    stream = incremental.stream_series(spark, str(tmp_path / "in"), 1)
    incremental.accumulate(stream, str(tmp_path / "out"), str(tmp_path / "cp"), t0, total, names, tides.window_middles(s))
    got = {r["node_id"]: np.array(r["__aty"]) for r in incremental.summed(spark, str(tmp_path / "out"), 6).collect()}
    want = {r["node_id"]: np.array(r["__aty"]) for r in tides.node_sums(tides.pack(s), t0, total, names).collect()}
    assert len(list((tmp_path / "out").glob("batch=*"))) == 2 and same(got, want)


def test_fit_to_own_hours_against_least_squares(spark):
    """Nodes that miss few hours, most hours, a whole file, or have a time twice."""
    g, rows, names = np.random.default_rng(6), [], ["MM", "MF"]
    for k, year in enumerate((1979, 1980)):
        for h in range(0, 8760, 5):
            t, v = H79 + 8760 * k + h, g.normal(size=4)
            rows += [(0, year, t, v[0] if h % 100 else None), (3, year, t, v[3])]
            if h > 6500:
                rows.append((1, year, t, v[1]))
            if k == 0:
                rows += [(2, year, t, v[2])] * (2 if h % 500 == 0 else 1)
    s = series(spark, rows)
    got = fitted(tides.coefficients(s, names, per_node_mask=True)[0])
    t0, total = tides.record(s)
    mids = {r["file_year"]: (r["__start"], np.array(r["__mids"])) for r in tides.window_middles(s).collect()}
    for node in range(4):
        own = [(y, t, np.float64(np.float32(v))) for n, y, t, v in rows if n == node and v is not None]
        a = np.concatenate([tides.design(np.array([t]), tides._middles(np.array([t]), *mids[y]), t0, total, names) for y, t, _ in own])
        want = np.linalg.lstsq(a, np.array([v for *_, v in own]), rcond=None)[0]
        assert np.abs(a @ (got[node] - want)).max() < 1e-6


def xyz(lon, lat):
    a, b = np.radians(lat), np.radians(lon)
    return 6371.0 * np.stack([np.cos(a) * np.cos(b), np.cos(a) * np.sin(b), np.sin(a)], 1)


def test_index_equals_brute_force(spark):
    """Dense and empty places, poles, the date line, nodes in one place and ties."""
    g = np.random.default_rng(9)
    lon = np.concatenate([g.uniform(-180, 180, 800), g.normal(-70, 0.3, 3000), np.full(300, 12.5), [180, -180, 0, 90, 45, -135]])
    lat = np.concatenate([g.uniform(-90, 90, 800), g.normal(20, 0.3, 3000), np.full(300, 55.5), [10, 10, 90, 90, -90, -90]])
    order = g.permutation(len(lon))
    mesh = [(int(i), float(lon[k]), float(lat[k])) for i, k in enumerate(order)]
    plon = np.concatenate([g.uniform(-180, 180, 300), g.normal(-70, 0.5, 300), [12.5, 12.5, 180, -180, 0, 77, 0, 0]])
    plat = np.concatenate([g.uniform(-90, 90, 300), g.normal(20, 0.5, 300), [55.5, 55.5, 10, 10, 90, 90, -90, 0]])
    pts = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(plon, plat))]
    frame = spark.createDataFrame(mesh, "node_index long, lon double, lat double").repartition(4)
    index = spatial.index_mesh(frame, cell=64)
    assert index.groupBy("cell").count().agg(F.max("count")).first()[0] <= 64
    got = {r["point_id"]: (r["node_index"], r["dist_km"]) for r in spatial.nearest_in(spark.createDataFrame(pts, "point_id long, lon double, lat double"), index, 1e6).collect()}
    nodes, points = xyz(lon[order], lat[order]), xyz(plon, plat)
    assert len(got) == len(pts)
    for i, p in enumerate(points):
        d = np.sqrt(((nodes - p) ** 2).sum(1))
        k, dist = got[i]
        assert abs(dist - d.min()) < 1e-9 and d[k] - d.min() < 1e-9
        same = np.flatnonzero((lon[order] == lon[order][k]) & (lat[order] == lat[order][k]))
        assert k == same.min()  # of nodes in one place, the smallest index


def test_index_of_few_and_no_nodes(spark):
    pts = spark.createDataFrame([(0, 1.0, 2.0), (1, 1.0, 2.0)], "point_id long, lon double, lat double")
    one = spark.createDataFrame([(7, 1.0, 3.0)], "node_index long, lon double, lat double")
    assert {(r["node_index"], round(r["dist_km"], 3)) for r in spatial.nearest(pts, one, 1e3).collect()} == {(7, 111.194)}
    assert {r["node_index"] for r in spatial.nearest(pts, one, 10.0).collect()} == {-1}
    assert {(r["node_index"], r["dist_km"]) for r in spatial.nearest(pts, one.limit(0)).collect()} == {(-1, None)}
    assert spatial.nearest(pts.limit(0), one).count() == 0


def test_tree_takes_the_smallest_of_equal_nodes():
    g = np.random.default_rng(2)
    nodes = g.integers(0, 6, (500, 3)).astype(float)
    ids = g.permutation(500)
    points = g.integers(0, 12, (200, 3)) / 2
    d, found = spatial.nearest_of(points, nodes, ids)
    for p, a, k in zip(points, d, found):
        all_ = np.sqrt(((nodes - p) ** 2).sum(1))
        assert a == all_.min() and k == ids[all_ == all_.min()].min()


def test_guard_inside_the_maxima(spark):
    g = np.random.default_rng(3)
    s = series(spark, [(0, y, b + h, g.normal()) for y, b, n in ((1979, H79, 8760), (1980, H79 + 8760, 8784)) for h in range(n)])
    for f in (periods.daily_max, periods.monthly_max):
        assert sorted(map(repr, f(s, check="inside").collect())) == sorted(map(repr, f(s).collect()))
        with pytest.raises(Exception, match="several files.*instant"):
            f(s, convention="end", check="inside").collect()


def test_fold_of_uneven_nodes():
    """Nodes with no month, one month and months without a candidate."""
    pointer, bad = periods.fold(np.array([0, 1, 3]), np.array([2, 1, 0, 2]), np.array([5.0, 4.0, 3.0, 9.0, 1.0]), np.array([1.0, 2.0, 100.0, 101.0, 300.0]), 24.0, 5)
    assert pointer.tolist() == [0, 0, 0, 0] and not bad.any()
    pointer, bad = periods.fold(np.array([2]), np.array([2, 2]), np.array([3.0, 1.0, 9.0, 1.0]), np.array([100.0, 50.0, 101.0, 300.0]), 24.0, 5)
    assert pointer.tolist() == [1, 0] and not bad.any()
    pointer, bad = periods.fold(np.array([2]), np.array([1, 1]), np.array([3.0, 9.0]), np.array([100.0, 101.0]), 24.0, 0)
    assert pointer.tolist() == [0, 0] and bad.tolist() == [True, False]


def test_monthly_stream_equals_the_batch_form_across_a_restart(spark, tmp_path):
    from tidelake.streaming import monthly

    g, names = np.random.default_rng(11), ["node_id", "y", "m", "value", "time_h", "adjusted", "n_excluded", "residual_violation"]
    rows = []
    for k, year in enumerate((1979, 1980, 1981)):
        start = H79 + 8760 * k + (24 if year == 1981 else 0)
        end = start + 8760 + (24 if year == 1980 else 0)
        hours = np.arange(start + 7, end + 1, 7) if year != 1979 else np.append(np.arange(start, end, 7), end)  # 1979's file ends with the first instant of 1980
        rows += [(node, year, h, float(np.float32(g.choice([1, 2, 5, g.normal(3)])))) for node in (0, 1, 2) for h in hours if node < 2 or year != 1980]
    s = series(spark, rows)
    want = {tuple(r) for r in periods.monthly_max(s, hours=400.0).withColumn("value", F.col("value").cast("double")).select(*names).collect()}
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for year in (1979, 1980, 1981, 2000):
            if year == 2000:  # a later file lets the watermark pass the last months
                part = series(spark, [(99, 2000, H79 + 30 * 8760, 1.0)])
            else:
                part = s.filter(F.col("file_year") == year)
            part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            if year != 1979:  # a new query goes on from the checkpoint
                stream = incremental.stream_series(spark, str(tmp_path / "in"), 1)
                got = monthly.monthly_max_stream(stream, 400.0)
                got.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    found = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select(*names).filter("node_id < 99").collect()]
    assert len(found) == len(set(found)) and set(found) == want


def test_steps_say_what_they_saw(spark, tmp_path):
    """Node blocks, extents, coverage and counts beside all four outputs; the shared index; a fit kept by file."""
    from tidelake.plans import steps
    from tidelake.sources import files, sinks

    d = str(tmp_path)
    spark.createDataFrame([(i, float(i), 10.0, 5.0) for i in range(4)], "node_index long, lon double, lat double, depth double").write.parquet(f"{d}/mesh")
    hours = np.arange(0, 24 * 120)
    rows = [(i, 1979, H79 + float(k), float(np.cos(k / 12.4 * 2 * np.pi) + i)) for i in range(4) for k in hours]
    spark.createDataFrame(rows, "node_index long, file_year int, time_h double, value double").write.partitionBy("file_year").parquet(f"{d}/in")
    (tmp_path / "p.csv").write_text("longitude,latitude\n1.01,10\n3.0,10.01\n")
    fields = {"group_name": "G", "climate_forcing": "F", "scenario": "S", "location": "L"}
    hourly = steps.extract(spark, f"{d}/p.csv", f"{d}/mesh", f"{d}/in", d, index_path=f"{d}/index", **fields)
    assert sinks.is_done(spark, f"{d}/index") and [r["node_index"] for r in spark.read.parquet(f"{hourly}.nodes").orderBy("node_id").collect()] == [2, 4]
    assert [r["node_index"] for r in files.read_nodes(spark, f"{hourly}.nodes").orderBy("node_id").collect()] == [1, 3]
    surge = steps.detide(spark, hourly, d, allow_rank_deficient=True, state_dir=f"{d}/state")
    plain = steps.detide(spark, hourly, f"{d}/plain", allow_rank_deficient=True)
    a, b = ({(r["node_id"], r["time_h"]): r["value"] for r in spark.read.parquet(x).collect()} for x in (surge, plain))
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-4
    daily, month = steps.daily_max(spark, hourly, "WaterLevel", d), steps.monthly_max(spark, surge, "StormSurge", d)
    for path, last in ((hourly, "1979-04-30 23:00:00"), (surge, "1979-04-30 23:00:00"), (daily, None), (month, None)):
        told = files.read_attrs(spark, path)
        assert told["geospatial_bounds"] == "POLYGON((1.0 10.0, 3.0 10.0, 3.0 10.0, 1.0 10.0, 1.0 10.0))" and told["model_name"] == "ADCIRC" and told["source_csv"] == "p.csv"
        assert told["time_coverage_start"].startswith("1979-01-0") and (last is None or told["time_coverage_end"] == last)
        block = files.read_attrs(spark, f"{path}.nodes")
        assert block["crs"]["semi_major_axis"] == 6378137.0 and block["n_nodes"] == 2 and spark.read.parquet(f"{path}.nodes").count() == 2
    assert "M2" in files.read_attrs(spark, surge)["detiding_constituents"] and files.read_attrs(spark, month)["n_adjusted_node_months"] == spark.read.parquet(month).agg(F.sum("n_excluded")).first()[0]
    two = spark.createDataFrame([(0, 2, 5)], "node_id long, node_i int, node_j int")
    assert sinks.shifted(two, "ROMS", False).first()["node_j"] == 5
    for model, nodes in (("ROMS", two.drop("node_j")), ("ADCIRC", two), ("other", two)):
        with pytest.raises(ValueError):
            sinks.shifted(nodes, model, False)


def test_times_on_any_axis_and_as_text(spark):
    from tidelake.functions import calendars as C

    days = spark.range(-40_000, 60_000, 997).select((F.col("id") * 24 + 6.5).alias("h"))
    for calendar in ("standard", "360_day", "noleap", "all_leap", "julian"):
        for units in ("hours since 1900-01-01", "days since 1970-01-01 06:00:00", "seconds since 2000-02-28 00:00:30", "minutes since 1850-12-30"):
            back = days.select("h", C.axis_hours(C.axis_values(F.col("h"), units, calendar), units, calendar).alias("again"), C.iso_hours(C.time_text(F.col("h"), calendar, "T"), calendar).alias("iso"))
            assert back.filter("abs(h - again) > 1e-6 or iso is null or abs(h - iso) > 1e-6").count() == 0
    texts = ["1900-01-02", "1900-01-01T06:30", "1900-01-01 00:00:01.5Z", "1900-02-30", "1900-13-01", "soon", "", None, "1900-1-1 24:00"]
    got = [r["h"] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", C.iso_hours(F.col("t")).alias("h")).orderBy("i").collect()]
    assert got == [24.0, 6.5, 1.5 / 3600, None, None, None, None, None, 24.0]
    assert spark.range(1).select(C.iso_hours(F.lit("1900-02-30"), "360_day").alias("h")).first()["h"] == 24.0 * 59
    assert spark.range(1).select(C.axis_values(F.lit(0.0), "days since 1901-01-01").alias("v")).first()["v"] == -365.0


def plain_file(path, shape_names, values, times, units="hours since 1900-01-01", records=True):
    """A file of version 1, written by hand: time, another variable with records of odd size, and twl."""
    import struct

    def text(x):
        raw = x.encode()
        return struct.pack(">i", len(raw)) + raw + b"\0" * (-len(raw) % 4)

    nt, nn = len(times), values.shape[1 if shape_names[0] == "time" else 0]
    time_first = shape_names[0] == "time"
    records = records and time_first
    dims = struct.pack(">ii", 10, 3) + text("time") + struct.pack(">i", 0 if records else nt) + text(shape_names[1 if time_first else 0]) + struct.pack(">i", nn) + text("three") + struct.pack(">i", 3)
    attr = struct.pack(">ii", 12, 2) + text("units") + struct.pack(">ii", 2, len(units)) + units.encode() + b"\0" * (-len(units) % 4) + text("calendar") + struct.pack(">ii", 2, 6) + b"noleap\0\0"
    none = struct.pack(">ii", 0, 0)
    order = (0, 1) if time_first else (1, 0)
    flags = (np.arange(nt * 3) % 100).astype(">i1").reshape(nt, 3)
    size = {"time": 8, "flag": 4 if records else nt * 3 + (-nt * 3 % 4), "twl": 4 * nn if records else 4 * nn * nt}

    def header(begins):
        out = b"CDF\x01" + struct.pack(">i", nt if records else 0) + dims + none + struct.pack(">ii", 11, 3)
        out += text("time") + struct.pack(">ii", 1, 0) + attr + struct.pack(">iii", 6, size["time"], begins[0])
        out += text("flag") + struct.pack(">iii", 2, 0, 2) + none + struct.pack(">iii", 1, size["flag"], begins[1])
        return out + text("twl") + struct.pack(">iii", 2, *order) + none + struct.pack(">iii", 5, size["twl"], begins[2])

    at = len(header((0, 0, 0)))
    data = values.astype(">f4")
    if records:
        body = b"".join(struct.pack(">d", t) + flags[i].tobytes() + b"\0" + data[i].tobytes() for i, t in enumerate(times))
        begins = (at, at + 8, at + 12)
    else:
        begins = (at, at + 8 * nt, at + 8 * nt + size["flag"])
        body = np.asarray(times, ">f8").tobytes() + flags.tobytes() + b"\0" * (size["flag"] - nt * 3) + data.tobytes()
    path.write_bytes(header(begins) + body)


def test_classic_files_in_both_orders(spark, tmp_path):
    from tidelake.sources import classic

    g, times = np.random.default_rng(1), np.arange(50) / 4 + 100.0
    values = g.normal(size=(50, 7))
    values[3, 2], values[4, 1] = 9.96921e36, np.nan
    plain_file(tmp_path / "a.nc", ("time", "node"), values, times, "days since 1950-03-01 12:00")
    plain_file(tmp_path / "b.nc", ("time", "node"), values, times, "days since 1950-03-01 12:00", records=False)
    plain_file(tmp_path / "c.nc", ("node", "time"), values.T, times, "days since 1950-03-01 12:00")
    start = (50 * 365 + 31 + 28) * 24 + 12.0
    want = {(n, start + 24 * t): None if not values[k, n] < 1e36 else np.float64(np.float32(values[k, n])) for k, t in enumerate(times) for n in range(7)}
    for name in "abc":
        got = classic.read_classic(spark, str(tmp_path / f"{name}.nc"), slab=200).collect()
        assert len(got) == 350 and {(r["node_id"], r["time_h"]): r["value"] for r in got} == want and {r["file_year"] for r in got} == {1950}
    some = classic.read_classic(spark, f"file://{tmp_path}", "twl", slab=200, start_h=start + 24 * 103, end_h=start + 24 * 104)
    assert some.count() == 3 * 7 * 5 and some.select("file").distinct().count() == 3
    assert classic.read_classic(spark, str(tmp_path / "a.nc"), slab=44).filter(f"time_h > {start + 24 * 103} and time_h <= {start + 24 * 104}").count() == 7 * 4
    plans = {o: len(classic.ClassicReader({"path": str(tmp_path / "a.nc"), "slab": "44", **o2}).partitions()) for o, o2 in (("all", {}), ("one", {"start_h": str(start + 24 * 103), "end_h": str(start + 24 * 103)}))}
    assert plans["all"] == 50 and plans["one"] == 1  # a row of a record is a slab here: only one is read
    plain_file(tmp_path / "bad.nc", ("time", "station"), values, times)
    (tmp_path / "no.nc").write_bytes(b"HDF5")
    for name, variable in (("bad", "twl"), ("no", "twl"), ("a", "other")):
        with pytest.raises(Exception, match="dimensions|layout|expected"):
            classic.read_classic(spark, str(tmp_path / f"{name}.nc"), variable).count()


def test_classic_export_round_trip(spark, tmp_path):
    from tidelake.sources import classic

    g = np.random.default_rng(5)
    rows = [(n, y, H79 + 8760 * (y - 1979) + h, None if (n + h) % 11 == 0 else g.normal()) for y in (1979, 1980) for h in range(40) for n in range(6) if (n, h) != (3, 7)]
    s = series(spark, rows)
    told = classic.export(s, str(tmp_path / "out"), "twl", {"title": "made here"}).collect()
    assert {(r["file_year"], r["n_times"]) for r in told} == {(1979, 40), (1980, 40)}
    back = classic.read_classic(spark, str(tmp_path / "out" / "twl_*.nc"), "twl").collect()
    got = {(r["node_id"], r["file_year"], r["time_h"]): r["value"] for r in back}
    want = {(n, y, t): None if v is None else np.float64(np.float32(v)) for n, y, t, v in rows} | {(3, y, H79 + 8760 * (y - 1979) + 7): None for y in (1979, 1980)}
    assert got == want


def test_bucketed_gather_moves_no_series(spark, tmp_path):
    from tidelake.operators import extract

    spark.sql("drop table if exists gathered")
    mesh = spark.range(2000).select((F.col("id") % 40).alias("node_index"), F.lit(1979).alias("file_year"), F.col("id").cast("double").alias("time_h"), F.col("id").cast("double").alias("value"))
    stored = extract.bucketed(mesh, "gathered", 4, str(tmp_path / "t"))
    nodes = spark.createDataFrame([(0, 3), (1, 3), (2, 39)], "node_id long, node_index long")
    got = extract.gather(stored, nodes)
    plan = got._jdf.queryExecution().sparkPlan().toString() + got._jdf.queryExecution().executedPlan().toString()
    text = got._jdf.queryExecution().executedPlan().toString()
    above = text[: text.index("FileScan")]
    assert "Bucketed: true" in plan and "Exchange" not in above[above.rindex("SortMergeJoin") :]
    assert got.count() == 150 and got.filter("node_id = 2").agg(F.sum("value")).first()[0] == sum(range(39, 2000, 40))
    spark.sql("drop table gathered")


def test_skill_from_files_and_on_the_command_line(spark, tmp_path):
    from tidelake import cli

    d = str(tmp_path)
    spark.createDataFrame([(i, 10.0 * i, 5.0) for i in range(3)], "node_index long, lon double, lat double").write.parquet(f"{d}/mesh")
    start = 80 * 365 * 24 + 19 * 24.0  # 1980-01-01
    spark.createDataFrame([(i, 1980, start + h, float(i + h % 12)) for i in range(3) for h in range(100)], "node_index long, file_year int, time_h double, value double").write.parquet(f"{d}/series")
    (tmp_path / "g").mkdir()
    for name, lon, shift in (("near", 10.01, 0.5), ("far", 14.0, 0.0)):
        head = [f"# SITE NAME: {name}", "# LATITUDE 5.0", f"# LONGITUDE: {lon}", "# START DATE 1980/01/01", "# END DATE 1981/01/01"] + ["#"] * 36
        body = [f"1980/01/{1 + h // 24:02d} {h % 24:02d}:00:00 {1 + h % 12 + shift} 1 1" for h in range(80)]
        (tmp_path / "g" / name).write_text("\n".join(head + body))
    args = cli.parser().parse_args(["skill", "--gauges", f"{d}/g", "--mesh", f"{d}/mesh", "--mesh-series", f"{d}/series", "--output", f"{d}/out", "--start-date", "1980-01-01 00:00:00", "--end-date", "1980-02-01 00:00:00"])
    (r,) = spark.read.parquet(cli.run(spark, args)).collect()
    assert (r["site_name"], r["node_index"], r["n"], r["bias"], r["rmse"]) == ("near", 1, 80, -0.5, 0.5) and r["dist_km"] < 2
    (tmp_path / "p.csv").write_text("longitude,latitude\n0.1,5\n20,5.1\n")
    spark.read.parquet(f"{d}/mesh").withColumn("depth", F.lit(1.0)).write.parquet(f"{d}/deep")
    named = ["--group-name", "G", "--climate-forcing", "F", "--scenario", "S", "--location", "L"]
    hourly = cli.run(spark, cli.parser().parse_args(["extract", "--points-csv", f"{d}/p.csv", "--mesh", f"{d}/deep", "--mesh-series", f"{d}/series", "--output-dir", d, "--model-name", "SCHISM", "--time-stamp-convention", "end", *named]))
    days = cli.run(spark, cli.parser().parse_args(["daily-max", "--hourly", hourly, "--variable", "WaterLevel", "--output-dir", d, "--time-stamp-convention", "instant"]))
    assert spark.read.parquet(hourly).count() == 200 and spark.read.parquet(days).count() == 2 * 5 and sorted(r["node_index"] for r in spark.read.parquet(f"{hourly}.nodes").collect()) == [0, 2]
    for bad in (["extract"], ["daily-max", "--hourly", "x", "--variable", "other", "--output-dir", "y"], []):
        with pytest.raises(SystemExit):
            cli.parser().parse_args(bad)


def test_a_clip_of_yearly_files_opens_those_years(spark, tmp_path):
    from tidelake.operators import extract

    rows = [(0, 1975 + k, H79 + 8766 * (k - 4) + h, float(h)) for k in range(8) for h in range(0, 8000, 400)]
    series(spark, rows).write.partitionBy("file_year").parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    some = extract.clip(stored, "1979-03-01", "1979-09-01", yearly=True)
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, extract.clip(stored, "1979-03-01", "1979-09-01").collect())) and some.count() > 5
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "file_year" in plan[plan.index("PartitionFilters") : plan.index("PushedFilters")] and "GreaterThanOrEqual(time_h" in plan
    assert {p.split("file_year=")[1][:4] for p in some.inputFiles()} <= {str(y) for y in range(1975, 1983)}
