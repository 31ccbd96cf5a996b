"""Provenance: defaults, precedence, attributes of outputs."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidelake.functions import calendars as C
from tidelake.functions.naming import datum_of
from tidelake.schema import FREQUENCIES, VARIABLES

# Fields and their fallbacks; what names a project is left to its configuration.
DEFAULTS = {
    "id": "", "project": "", "institution": "", "contact": "", "creator_name": "", "creator_id": "", "creator_email": "",
    "researcher_name": "", "researcher_id": "", "researcher_email": "", "researcher_affiliation": "", "source": "", "forcing": "",
    "geospatial_bounds_crs": "EPSG:4326", "geospatial_bounds_vertical_crs": "", "datum": "", "license": "", "acknowledgment": "", "references": "", "comment": "",
    "sea_name": "global", "keywords": "storm surge; coastal flooding; water level", "standard_name_vocabulary": "CF Standard Name Table", "realm": "ocean", "further_info_url": "",
    "time_stamp_convention": C.DEFAULT_CONVENTION, "group_name": "", "climate_forcing": "", "scenario": "", "location": "",
}
# Order of the attributes, fields that outputs don't inherit, other names of inherited fields.
ATTRIBUTES = [
    "id", "project", "acknowledgment", "contact", "creator_name", "creator_id", "creator_email", "researcher_name", "researcher_id", "researcher_email", "researcher_affiliation",
    "license", "institution", "institution_id", "further_info_url", "sea_name", "source", "source_id", "forcing", "experiment_id", "realm", "product", "frequency", "table_id", "variable_id", "location",
    "time_stamp_convention", "keywords", "standard_name_vocabulary", "references", "comment",
]
NOT_INHERITED = {"id", "datum", "geospatial_bounds_crs", "geospatial_bounds_vertical_crs"}
ALIASES = {"group_name": "institution_id", "climate_forcing": "source_id", "scenario": "experiment_id"}


def inherited(attrs: dict[str, str]) -> dict[str, str]:
    """The fields that an output takes over from its input's attributes, under either name; blanks don't count."""
    found = {k: attrs.get(k) or attrs.get(ALIASES.get(k, k)) for k in DEFAULTS if k not in NOT_INHERITED}
    return {k: v for k, v in found.items() if v}


def load(yaml_path: str | None = None, source_attrs: dict | None = None, **overrides: str | None) -> dict[str, str]:
    """Defaults, then the source's known fields, then the YAML file's, then overrides; a blank never overrides."""
    given: dict = {}
    if yaml_path:
        import yaml

        with open(yaml_path) as f:
            given = yaml.safe_load(f) or {}
    out = dict(DEFAULTS)
    for layer in ({k: v for k, v in (source_attrs or {}).items() if k in DEFAULTS}, given, overrides):
        out |= {k: v for k, v in layer.items() if v not in (None, "")}
    C.epsilon(out["time_stamp_convention"])
    out["forcing"] = out["forcing"] or out["climate_forcing"]
    return out


def resolved(*layers: Column) -> Column:
    """The first that isn't blank, highest precedence first."""
    return F.coalesce(*(F.nullif(x, F.lit("")) for x in layers), F.lit(""))


def attributes(metadata: dict[str, str], title: str, summary: str, timestep: str, variable: str, **extra: str) -> dict[str, str]:
    """Global attributes of an output, in order."""
    computed = {
        "institution_id": metadata["group_name"], "source_id": metadata["climate_forcing"], "experiment_id": metadata["scenario"],
        "variable_id": VARIABLES[variable]["name"], "table_id": timestep, "frequency": FREQUENCIES[timestep], "product": "model-output",
    }
    head = {
        "Conventions": "CF-1.8", "featureType": "timeSeries", "Metadata_Conventions": "Unidata Dataset Discovery v1.0", "title": title, "summary": summary,
        "creation_date": datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ"), "tracking_id": f"hdl:21.14100/{uuid.uuid4()}", "history": "",
    }
    datum = datum_of(metadata, variable)
    return head | {k: computed.get(k, metadata.get(k, "")) for k in ATTRIBUTES} | ({"datum": datum} if datum else {}) | extra


def extent_attributes(seen: dict, metadata: dict[str, str]) -> dict[str, object]:
    """Attributes of the nodes' extent: lon_min, lon_max and so on, of which depths may be missing; none of no nodes."""
    if seen.get("lon_min") is None:
        return {}
    a, b, c, d = (float(seen[k]) for k in ("lon_min", "lat_min", "lon_max", "lat_max"))
    corners = [(a, b), (c, b), (c, d), (a, d), (a, b)]
    out = {
        "geospatial_lat_min": b, "geospatial_lat_max": d, "geospatial_lat_units": "degrees_north", "geospatial_lat_resolution": "point",
        "geospatial_lon_min": a, "geospatial_lon_max": c, "geospatial_lon_units": "degrees_east", "geospatial_lon_resolution": "point",
        "geospatial_bounds": f"POLYGON(({', '.join(f'{x} {y}' for x, y in corners)}))", "geospatial_bounds_crs": metadata["geospatial_bounds_crs"],
    }
    if seen.get("depth_min") is not None:
        out |= {"geospatial_vertical_min": seen["depth_min"], "geospatial_vertical_max": seen["depth_max"], "geospatial_vertical_units": "m", "geospatial_vertical_positive": "down"}
        vertical = metadata["geospatial_bounds_vertical_crs"]
        out |= {"geospatial_bounds_vertical_crs": vertical} if vertical else {}
    return out


def covered() -> dict[str, Column]:
    """What is measured of a series for its coverage, while it is written."""
    return {"first_h": F.min("time_h"), "last_h": F.max("time_h")}


def coverage(spark: SparkSession, first_h: float | None, last_h: float | None, calendar: str | None = None, attrs: dict[str, str] | None = None) -> dict[str, str]:
    """Time coverage from first to last hour in the series' calendar, widened by what attrs already state (as strings, which sort like the times they are)."""
    found = {"time_coverage_start": "", "time_coverage_end": ""}
    if first_h is not None:
        row = spark.range(1).select(*(C.time_text(F.lit(float(h)), calendar).alias(n) for n, h in zip(found, (first_h, last_h)))).first()
        found = row.asDict()
    for name, pick in (("time_coverage_start", min), ("time_coverage_end", max)):
        known = [x for x in (found[name], (attrs or {}).get(name)) if x]
        found[name] = pick(known, default="")
    return found
