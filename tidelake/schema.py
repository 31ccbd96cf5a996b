"""Schemas and registries of the data model.

A series is long: a row for each node and instant, null where the value is
missing; `file_year` is the partition of storage and names the yearly file that a
row came from. `time_h` is hours since 1900-01-01 00:00 in the series' calendar.
"""

from __future__ import annotations

from pyspark.sql import types as T

SERIES = T.StructType([
    T.StructField("node_id", T.LongType()), T.StructField("file_year", T.IntegerType()),
    T.StructField("time_h", T.DoubleType()), T.StructField("value", T.FloatType()),
])
NODES = T.StructType([
    T.StructField("node_id", T.LongType()), T.StructField("node_index", T.LongType()),
    T.StructField("node_lon", T.DoubleType()), T.StructField("node_lat", T.DoubleType()), T.StructField("node_depth", T.DoubleType()),
    T.StructField("point_lon", T.DoubleType()), T.StructField("point_lat", T.DoubleType()), T.StructField("dist_km", T.FloatType()),
])
MESH = T.StructType([T.StructField("node_index", T.LongType()), *(T.StructField(c, T.DoubleType()) for c in ("lon", "lat", "depth"))])

# Fill of stored arrays, sentinel of dry mesh values, missing sea level.
FILL, DRY, NO_LEVEL = 9.96921e36, -9999.0, -99.9999

# Variables, frequencies, point sets, index schemes.
VARIABLES = {
    "WaterLevel": {"name": "twl", "standard_name": "total_water_level", "long_name": "Total Water Level", "datum": "LMSL"},
    "StormSurge": {"name": "ssgh", "standard_name": "storm_surge_height", "long_name": "Storm Surge Height", "datum": ""},
}
FREQUENCIES = {"Hourly": "1hr", "DailyMax": "day", "MonthlyMax": "mon"}
POINT_SETS = {"coastal35K": ("shoreline points", "GSHHS"), "GESLA": ("GESLA stations", "GESLA")}
INDEX_SCHEMES = {"ADCIRC": {"dims": 1, "base": 1}, "ROMS": {"dims": 2, "base": 0}, "SCHISM": {"dims": 1, "base": 0}, "TRIM-NP": {"dims": 2, "base": 0}}


def index_scheme(model: str | None) -> dict[str, int]:
    """Dimensions and base of a model's node indices; a missing model name means ADCIRC."""
    name = model or "ADCIRC"
    if name not in INDEX_SCHEMES:
        raise ValueError(f"unknown model {name!r}, expected one of {list(INDEX_SCHEMES)}")
    return INDEX_SCHEMES[name]


def check_dimensions(dims: tuple[str, ...]) -> bool:
    """True if time leads, False if node does; ValueError for any other dimensions."""
    if set(dims) != {"time", "node"} or len(dims) != 2:
        raise ValueError(f"expected the dimensions time and node, got {dims}")
    return dims[0] == "time"
