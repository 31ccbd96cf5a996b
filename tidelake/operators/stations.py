"""Tide gauges: overlap with a simulation, hourly means, and skill of a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions import calendars as C
from tidelake.operators import spatial
from tidelake.operators.extract import extract_sparse

MIN_HOURS = 24


def overlaps(start: Column, end: Column, sim_start: Column, sim_end: Column, form: str = "yyyy/MM/dd") -> Column:
    """Whether a station's period meets the simulation's. A date that can't be read keeps the station; an empty one drops it."""
    s, e = F.try_to_timestamp(start, F.lit(form)), F.try_to_timestamp(end, F.lit(form))
    return F.when((start == "") | (end == ""), F.lit(False)).otherwise(F.coalesce((s <= sim_end) & (e >= sim_start), F.lit(True)))


def quality_filter(obs: DataFrame) -> DataFrame:
    return obs.filter((F.col("use_flag") == 1) & F.col("sea_level").isNotNull())


def hourly_mean(series: DataFrame, keys: list[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """Means of the clock's hours; hours without a value are left out."""
    return series.groupBy(*keys, F.date_trunc("hour", ts).alias("hour")).agg(F.avg(value).alias("value")).filter(F.col("value").isNotNull())


def skill(model: DataFrame, obs: DataFrame, keys: list[str], least: int = MIN_HOURS) -> DataFrame:
    """Skill of hourly model values against hourly observations (keys, hour, value), for keys with at least `least` common hours.

    Correlation and scatter index are null where a deviation is 0. Rounded to 4 places.
    """
    both = model.withColumnRenamed("value", "m").join(obs.withColumnRenamed("value", "o"), [*keys, "hour"])
    d = F.col("m") - F.col("o")
    out = both.groupBy(*keys).agg(
        F.count("*").alias("n"), F.avg(d).alias("bias"), F.sqrt(F.avg(d * d)).alias("rmse"),
        F.try_divide(F.covar_pop("m", "o"), F.stddev_pop("m") * F.stddev_pop("o")).alias("corr"),
        F.avg("m").alias("mean_model"), F.avg("o").alias("mean_obs"), F.stddev_pop("m").alias("std_model"), F.stddev_pop("o").alias("std_obs"),
    )
    out = out.filter(F.col("n") >= least).withColumn("scatter_index", F.try_divide("rmse", "std_obs"))
    return out.select(*keys, "n", *(F.round(c, 4).alias(c) for c in ("bias", "rmse", "corr", "scatter_index", "mean_model", "mean_obs", "std_model", "std_obs")))


def matched(catalogue: DataFrame, index: DataFrame, max_km: float = 50.0) -> DataFrame:
    """catalogue (file, longitude, latitude, ...) with node_index and dist_km of each station's nearest node within max_km; others are left out."""
    stations = catalogue.withColumn("point_id", F.xxhash64("file"))
    points = stations.select("point_id", F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))
    near = spatial.nearest_in(points, index, max_km).filter("node_index >= 0").select("point_id", "node_index", "dist_km").dropDuplicates(["point_id"])
    return stations.join(near, "point_id").drop("point_id")


def scored(stations: DataFrame, mesh_series: DataFrame, obs: DataFrame, calendar: str | None = None) -> DataFrame:
    """stations (see matched) with the skill of their node's series (node_index, time_h, value) against their observations (file, ts, sea_level).

    Nodes' series are cut out once each, however many stations share a node; hours in common count, from MIN_HOURS on.
    """
    if C.calendar_name(calendar) != "standard":
        raise ValueError(f"observations have standard dates, the series {calendar!r} ones")
    nodes = stations.select("node_index").distinct()
    cut = extract_sparse(mesh_series, nodes).select("node_index", C.timestamp_of(F.col("time_h")).cast("timestamp").alias("ts"), "value")
    of_nodes = hourly_mean(cut, ["node_index"])
    model = stations.select("file", "node_index").join(of_nodes, "node_index").select("file", "hour", "value")
    seen = hourly_mean(obs.select("file", F.col("ts").cast("timestamp").alias("ts"), F.col("sea_level").alias("value")), ["file"])
    return stations.join(skill(model, seen, ["file"]), "file")
