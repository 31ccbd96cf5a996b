"""File names: variable_frequency_group_forcing_scenario_location_timerange.nc."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelake.schema import FREQUENCIES, POINT_SETS, VARIABLES

NAMING_FIELDS = ("group_name", "climate_forcing", "scenario", "location")


def time_range(years: int | str) -> str:
    """2000 gives 200001-200012, 1947-2025 gives 194701-202512; six digits pass as months."""
    start, _, end = str(years).partition("-")
    end = end or start
    return f"{start + '01' if len(start) == 4 else start}-{end + '12' if len(end) == 4 else end}"


def time_range_column(years: Column) -> Column:
    """time_range of a column of strings."""
    start = F.substring_index(years, "-", 1)
    end = F.substring_index(years, "-", -1)
    return F.concat_ws("-", F.when(F.length(start) == 4, F.concat(start, F.lit("01"))).otherwise(start), F.when(F.length(end) == 4, F.concat(end, F.lit("12"))).otherwise(end))


def check_naming(metadata: dict[str, str]) -> None:
    missing = [f for f in NAMING_FIELDS if not metadata.get(f)]
    if missing:
        raise ValueError(f"missing naming fields: {missing}")
    marked = [f for f in NAMING_FIELDS if "_" in str(metadata[f])]
    if marked:
        raise ValueError(f"naming fields with an underscore, which separates fields: {marked}")


def file_name(metadata: dict[str, str], timestep: str, variable: str, years: int | str) -> str:
    check_naming(metadata)
    if variable not in VARIABLES:
        raise ValueError(f"unknown variable {variable!r}, expected one of {list(VARIABLES)}")
    if timestep not in FREQUENCIES:
        raise ValueError(f"unknown timestep {timestep!r}, expected one of {list(FREQUENCIES)}")
    return "_".join([VARIABLES[variable]["name"], FREQUENCIES[timestep], *(str(metadata[f]) for f in NAMING_FIELDS), time_range(years)]) + ".nc"


def file_name_column(variable: Column, frequency: Column, group: Column, forcing: Column, scenario: Column, location: Column, years: Column) -> Column:
    """file_name of columns; an error where a field is empty or has an underscore."""
    fields = [group, forcing, scenario, location]
    bad = F.lit(False)
    for f in fields:
        bad = bad | f.isNull() | (f == "") | F.contains(f, F.lit("_"))
    name = F.concat(F.concat_ws("_", variable, frequency, *fields, time_range_column(years)), F.lit(".nc"))
    return F.when(bad, F.raise_error(F.lit("a naming field is empty or has an underscore"))).otherwise(name)


def start_year(name: Column, variable: str) -> Column:
    """Start year of an hourly file's name; null if the name is another's."""
    year = F.regexp_extract(name, rf"(?:^|/){re.escape(variable)}_1hr_.*_([0-9]{{4}})[0-9]{{2}}-[0-9]{{6}}\.nc$", 1)
    return F.when(year != "", year.cast("int"))


def version_suffix(name: Column, stem: str = "fort.63.nc") -> Column:
    """0 for the stem, n for stem-n, null for other names."""
    got = F.regexp_extract(name, rf"(?:^|/){re.escape(stem)}(?:-([0-9]+))?$", 1)
    return F.when(name.rlike(rf"(?:^|/){re.escape(stem)}(-[0-9]+)?$"), F.coalesce(F.nullif(got, F.lit("")).cast("int"), F.lit(0)))


def point_set(location: str) -> tuple[str, str]:
    """Description and source of a location's points."""
    return POINT_SETS.get(location, (f"{location} points", location))


def datum_of(metadata: dict[str, str], variable: str) -> str:
    return metadata.get("datum") or VARIABLES[variable]["datum"]
