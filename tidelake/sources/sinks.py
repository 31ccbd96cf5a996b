"""Writing series, maxima and nodes: Parquet, with their metadata beside them."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidelake.schema import index_scheme


def is_done(spark, path: str) -> bool:
    """Whether a table was written to its end: Spark marks that, so a torn write is none."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")  # Spark's readers don't show it
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def write_table(df: DataFrame, path: str, attrs: dict[str, str] | None = None, force: bool = False, partition: str | None = None, measured: dict[str, Column] | None = None, told: Callable[[dict], dict] | None = None) -> bool:
    """Writes df and its attributes unless it is there already; whether it was written.

    With a partition column, only the partitions in df are replaced. measured: aggregates
    that are taken while the rows are written, without a further scan; told makes more attributes of them.
    """
    spark = df.sparkSession
    if not force and is_done(spark, path):
        return False
    seen = Observation() if measured else None
    if seen is not None:
        df = df.observe(seen, F.count(F.lit(1)).alias("__rows"), *(c.alias(n) for n, c in measured.items()))
    if partition:
        rows = df.repartition(partition, F.pmod(F.xxhash64("node_id"), F.lit(32))).sortWithinPartitions("node_id", "time_h")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    if attrs is not None:
        more = told(seen.get) if seen is not None and told else {}
        spark.createDataFrame([(json.dumps(attrs | more),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}.meta")
    return True


# The coordinate reference of all positions.
CRS = {"grid_mapping_name": "latitude_longitude", "longitude_of_prime_meridian": 0.0, "semi_major_axis": 6378137.0, "inverse_flattening": 298.257223563}


def index_columns(model: str | None) -> list[str]:
    return ["node_index"] if index_scheme(model)["dims"] == 1 else ["node_i", "node_j"]


def shifted(nodes: DataFrame, model: str | None, on_disk: bool) -> DataFrame:
    """nodes with 0-based indices made to the model's base, or back (on_disk); ValueError without the columns that its scheme has."""
    wanted = index_columns(model)
    missing = [c for c in wanted if c not in nodes.columns]
    if missing:
        raise ValueError(f"{model or 'ADCIRC'} nodes need the index columns {wanted}, without {missing}")
    base = index_scheme(model)["base"]
    return nodes.withColumns({c: F.col(c) + (-base if on_disk else base) for c in wanted})


def node_attributes(model: str | None, point_source: str) -> dict[str, object]:
    """What describes a node block's columns and its reference system."""
    base = index_scheme(model)["base"]
    letters = {"node_index": "", "node_i": "i-", "node_j": "j-"}
    columns: dict[str, dict[str, str]] = {c: {"long_name": f"{base}-based {letters[c]}index, matches original model node numbering"} for c in index_columns(model)}
    columns[index_columns(model)[0]]["cf_role"] = "timeseries_id"
    for kind, units, standard in (("lon", "degrees_east", "longitude"), ("lat", "degrees_north", "latitude")):
        columns[f"node_{kind}"] = {"standard_name": standard, "long_name": f"{standard.capitalize()} of matched model mesh node", "units": units}
        columns[f"point_{kind}"] = {"standard_name": standard, "long_name": f"Original CSV point {standard} ({point_source})", "units": units}
    columns["node_depth"] = {"standard_name": "sea_floor_depth_below_geoid", "long_name": "Depth of matched mesh node below geoid", "units": "m", "positive": "down"}
    columns["dist_km"] = {"long_name": "Distance from CSV point to matched mesh node", "units": "km"}
    return {"model_name": model or "ADCIRC", "crs": CRS, "columns": columns}


def write_nodes(nodes: DataFrame, path: str, model: str | None, point_source: str, told: Callable[[dict], dict], more: dict | None = None) -> None:
    """The node block (0-based indices, stored in the model's base) with its attributes; told makes attributes of the extent and of the distances, which are measured while it is written."""
    extent = {f"{n}_{w}": f(f"node_{n}") for n in ("lon", "lat", "depth") for w, f in (("min", F.min), ("max", F.max))}
    distances = {"max_km": F.max("dist_km"), "n_far": F.count_if(F.col("dist_km") > 100)}
    write_table(shifted(nodes, model, False), path, node_attributes(model, point_source) | (more or {}), True, measured=extent | distances, told=told)
