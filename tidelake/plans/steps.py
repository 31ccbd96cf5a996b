"""The four steps over stored tables: extract, detide, daily and monthly maxima."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions import naming
from tidelake.operators import extract as X
from tidelake.operators import periods, spatial, stations, tides
from tidelake.plans import metadata as M
from tidelake.sources import files, scratch, sinks
from tidelake.streaming import incremental


def _named(meta: dict[str, str], timestep: str, variable: str, years: str, out_dir: str) -> str:
    return f"{out_dir.rstrip('/')}/{naming.file_name(meta, timestep, variable, years).removesuffix('.nc')}.parquet"


def _years(series: DataFrame) -> str:
    row = series.agg(F.min("file_year").alias("a"), F.max("file_year").alias("b")).first()
    return f"{row['a']}-{row['b']}"


def _covered(spark: SparkSession, calendar: str | None):
    """What is measured of a series while it is written, and the attributes that come of it."""
    return M.covered(), lambda seen: M.coverage(spark, seen["first_h"], seen["last_h"], calendar)


def _write_nodes(nodes: DataFrame, path: str, meta: dict[str, str], model: str | None, more: dict | None = None) -> None:
    def told(seen: dict) -> dict:
        return M.extent_attributes(seen, meta) | {"n_nodes": seen["__rows"], "max_point_distance_km": seen["max_km"], "n_points_beyond_100_km": seen["n_far"]}

    sinks.write_nodes(nodes, f"{path}.nodes", model, naming.point_set(meta["location"])[1], told, more)


def _nodes_beside(spark: SparkSession, source: str, path: str, meta: dict[str, str]) -> dict[str, object]:
    """Writes the source's node block beside the output too; the attributes of its extent. A source without one is left so."""
    if not sinks.is_done(spark, f"{source}.nodes"):
        return {}
    told = files.read_attrs(spark, f"{source}.nodes")
    _write_nodes(files.read_nodes(spark, f"{source}.nodes"), path, meta, told.get("model_name"), {k: told[k] for k in ("source_csv",) if k in told})
    return _extent(spark, path)


def _extent(spark: SparkSession, path: str) -> dict[str, object]:
    told = files.read_attrs(spark, f"{path}.nodes")
    return {k: v for k, v in told.items() if k.startswith("geospatial_") or k in ("model_name", "source_csv")}


def extract(spark: SparkSession, points_csv: str, mesh_path: str, mesh_series_path: str, out_dir: str, mask_path: str | None = None, start: str | None = None, end: str | None = None, calendar: str | None = None, force: bool = False, yaml_path: str | None = None, model_name: str | None = None, index_path: str | None = None, yearly: bool = False, **naming_fields: str) -> str:
    """Hourly water levels at the points' nodes, and the nodes beside them; the table's path.

    index_path: a stored index of the mesh (spatial.index_mesh), built where it isn't there yet; with a mask it must be one of the wet nodes. yearly: see extract.clip.
    """
    meta = M.load(yaml_path, None, **naming_fields)
    naming.check_naming(meta)
    source = spark.read.parquet(mesh_series_path)
    path = _named(meta, "Hourly", "WaterLevel", _years(source), out_dir)
    if sinks.is_done(spark, path) and not force:
        return path
    mesh, mask = spark.read.parquet(mesh_path), spark.read.parquet(mask_path) if mask_path else None
    index = None
    if index_path:
        done = sinks.is_done(spark, index_path)
        index = spark.read.parquet(index_path) if done else spatial.index_mesh(mesh if mask is None else spatial.wet_only(mesh, mask), index_path)
    nodes = spatial.match_points(files.read_points(spark, points_csv), mesh, mask, index)
    _write_nodes(nodes, path, meta, model_name, {"source_csv": points_csv.rsplit("/", 1)[-1]})
    nodes = files.read_nodes(spark, f"{path}.nodes")
    attrs = M.attributes(meta, "Hourly total water level", f"Hourly water level at {naming.point_set(meta['location'])[0]}", "Hourly", "WaterLevel", calendar=calendar or "standard") | _extent(spark, path)
    sinks.write_table(X.extract(source, nodes, start, end, calendar, yearly=yearly), path, attrs, True, "file_year", *_covered(spark, calendar))
    return path


def _inherit(spark: SparkSession, path: str, yaml_path: str | None, fields: dict) -> tuple[dict[str, str], dict[str, str]]:
    attrs = files.read_attrs(spark, path)
    meta = M.load(yaml_path, M.inherited(attrs), **fields)
    naming.check_naming(meta)
    return meta, attrs


def detide(spark: SparkSession, hourly_path: str, out_dir: str, force: bool = False, yaml_path: str | None = None, allow_rank_deficient: bool = False, per_node_mask: bool = False, state_dir: str | None = None, **fields: str) -> str:
    """Hourly storm surge of a stored water level; the table's path.

    state_dir: where the sums of each file are kept, so that a run that was stopped goes on after the last file that it added (shared fit only).
    """
    meta, attrs = _inherit(spark, hourly_path, yaml_path, fields)
    series = spark.read.parquet(hourly_path)
    path = _named(meta, "Hourly", "StormSurge", _years(series), out_dir)
    if sinks.is_done(spark, path) and not force:
        return path
    calendar = attrs.get("calendar", "standard")
    if state_dir and not per_node_mask:
        kept = incremental.Fit(spark, state_dir, series, None, calendar)
        kept.add(series)
        packed, (fitted, info) = tides.pack(series, kept.mids), kept.solve(allow_rank_deficient)
    else:
        packed, fitted, info = tides.fit(series, calendar, allow_rank_deficient=allow_rank_deficient, per_node_mask=per_node_mask)
    told = M.attributes(meta, "Hourly storm surge height", "Water level less its harmonic tide", "Hourly", "StormSurge", calendar=calendar, detiding_method=f"least-squares harmonic analysis over the whole record; nodal corrections every {tides.NODAL_HOURS:.0f} h")
    told |= {"detiding_constituents": ", ".join(info["constituents"]), "detiding_excluded_constituents": ", ".join(tides.EXCLUDED), "detiding_hours": info["total_hours"]} | _nodes_beside(spark, hourly_path, path, meta)
    sinks.write_table(tides.subtract(packed, fitted, info), path, told, True, "file_year", *_covered(spark, calendar))
    return path


def _maxima(spark, hourly_path, variable, out_dir, timestep, force, yaml_path, fields, compute, note, counted=None) -> str:
    meta, attrs = _inherit(spark, hourly_path, yaml_path, fields)
    series = spark.read.parquet(hourly_path)
    path = _named(meta, timestep, variable, _years(series), out_dir)
    if sinks.is_done(spark, path) and not force:
        return path
    calendar = attrs.get("calendar", "standard")
    convention = meta["time_stamp_convention"]
    result = compute(series, calendar, convention)
    told = M.attributes(meta, f"{timestep} of {variable}", note, timestep, variable, calendar=calendar) | _nodes_beside(spark, hourly_path, path, meta)
    measured, cover = _covered(spark, calendar)
    counted = counted or {}
    sinks.write_table(result, path, told, True, None, measured | counted, lambda seen: cover(seen) | {k: seen[k] for k in counted} | ({"monthly_max_min_separation_hours": periods.SEPARATION_H} if counted else {}))
    return path


def daily_max(spark: SparkSession, hourly_path: str, variable: str, out_dir: str, force: bool = False, yaml_path: str | None = None, **fields: str) -> str:
    """Each node's daily maxima, with their times; the table's path."""
    return _maxima(spark, hourly_path, variable, out_dir, "DailyMax", force, yaml_path, fields, lambda s, c, t: periods.daily_max(s, c, t, "inside"), "time: maximum within days")


def monthly_max(spark: SparkSession, hourly_path: str, variable: str, out_dir: str, force: bool = False, yaml_path: str | None = None, **fields: str) -> str:
    """Each node's monthly maxima at least a day apart; the table's path."""
    counted = {"n_adjusted_node_months": F.coalesce(F.sum("n_excluded"), F.lit(0)).cast("long"), "n_node_months_with_adjustment": F.count_if("adjusted")}
    return _maxima(spark, hourly_path, variable, out_dir, "MonthlyMax", force, yaml_path, fields, lambda s, c, t: periods.monthly_max(s, calendar=c, convention=t, check="inside"), "time: maximum within months, 24 h apart", counted)


def skill(spark: SparkSession, gauges: str, mesh_path: str, mesh_series_path: str, out_path: str, start: str | None = None, end: str | None = None, max_km: float = 50.0, index_path: str | None = None, force: bool = False) -> str:
    """From gauge files to scores: the stations whose period meets start .. end, their nearest nodes, those nodes' series, and the skill at each; the table's path."""
    if sinks.is_done(spark, out_path) and not force:
        return out_path
    mesh = spark.read.parquet(mesh_path)
    index = spark.read.parquet(index_path) if index_path and sinks.is_done(spark, index_path) else spatial.index_mesh(mesh, index_path)
    near = scratch.stored(stations.matched(files.station_catalogue(spark, gauges, start, end), index, max_km), "stations")
    series = X.clip(spark.read.parquet(mesh_series_path), start, end)
    sinks.write_table(stations.scored(near, series, files.read_gauges(spark, gauges, start, end)), out_path, None, True)
    return out_path
