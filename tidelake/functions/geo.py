"""Positions on the sphere: geocentric coordinates in km and chord distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RADIUS_KM = 6371.0


def ecef(lon: Column, lat: Column) -> tuple[Column, Column, Column]:
    a, b = F.radians(lat), F.radians(lon)
    return F.cos(a) * F.cos(b) * RADIUS_KM, F.cos(a) * F.sin(b) * RADIUS_KM, F.sin(a) * RADIUS_KM


def chord(p: tuple[Column, ...], q: tuple[Column, ...]) -> Column:
    """Straight-line distance, not along the surface."""
    return F.sqrt(sum(((a - b) * (a - b) for a, b in zip(p[1:], q[1:])), (p[0] - q[0]) * (p[0] - q[0])))


def bounds_wkt(lon_min: Column, lat_min: Column, lon_max: Column, lat_max: Column) -> Column:
    """The bounding box as a WKT polygon."""
    s = lambda c: c.cast("double").cast("string")
    corners = [(lon_min, lat_min), (lon_max, lat_min), (lon_max, lat_max), (lon_min, lat_max), (lon_min, lat_min)]
    return F.concat(F.lit("POLYGON(("), F.concat_ws(", ", *(F.concat_ws(" ", s(x), s(y)) for x, y in corners)), F.lit("))"))
