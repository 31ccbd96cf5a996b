"""Finding and reading stored series, meshes, points and gauges with Spark's readers."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.functions import calendars as C
from tidelake.functions import naming
from tidelake.operators.stations import overlaps, quality_filter
from tidelake.schema import NO_LEVEL
from tidelake.sources import sinks

HEADER_LINES = 41


def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path of every file below a folder, by Spark's own listing; contents are not read."""
    got = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return got.select("path")


def best_files(files: DataFrame) -> DataFrame:
    """dir, path: of each folder's model files, the one with the highest version."""
    rows = files.select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("dir"), "path", naming.version_suffix(F.col("path")).alias("v")).filter("v is not null")
    return rows.groupBy("dir").agg(F.max_by("path", "v").alias("path"))


def best_files_by_year(files: DataFrame) -> DataFrame:
    """year, path of the best files in folders that are named as a year."""
    year = F.regexp_extract("dir", r"(?:^|/)([0-9]{4})$", 1)
    return best_files(files).filter(year != "").select(year.cast("int").alias("year"), "path").orderBy("year")


def hourly_files(files: DataFrame, variable: str) -> DataFrame:
    """file_year, path of a variable's hourly files, by the start year of their names."""
    return files.select(naming.start_year(F.col("path"), variable).alias("file_year"), "path").filter("file_year is not null").orderBy("file_year")


def first_years(series: DataFrame, file: str = "file") -> DataFrame:
    """file, file_year of files given by name only: the year of the first instant in each."""
    return series.groupBy(file).agg(F.year(C.timestamp_of(F.min("time_h"))).alias("file_year"))


def read_series(spark: SparkSession, path: str, years: list[int] | None = None) -> DataFrame:
    """A stored series; years prune partitions."""
    got = spark.read.parquet(path)
    return got if years is None else got.filter(F.col("file_year").isin(years))


def read_attrs(spark: SparkSession, path: str) -> dict[str, str]:
    """The metadata that lies beside a stored table."""
    return json.loads("\n".join(r[0] for r in spark.read.text(f"{path}.meta/").collect()))


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """A stored node block, its indices 0-based again by the scheme of the model that its metadata name."""
    return sinks.shifted(spark.read.parquet(path), read_attrs(spark, path).get("model_name"), True)


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """point_id (order in the file), lon, lat of a CSV whose headers, trimmed and in lower case, include longitude and latitude."""
    raw = spark.read.csv(path, header=True)
    named = raw.toDF(*(c.strip().lower() for c in raw.columns))
    missing = {"longitude", "latitude"} - set(named.columns)
    if missing:
        raise ValueError(f"the points lack {sorted(missing)}")
    ordered = named.select(F.monotonically_increasing_id().alias("__at"), F.col("longitude").cast("double").alias("lon"), F.col("latitude").cast("double").alias("lat"))
    # A list of points is small; its order needs one task.
    return ordered.select((F.row_number().over(Window.orderBy("__at")) - 1).cast("long").alias("point_id"), "lon", "lat")


def gauge_headers(files: DataFrame) -> DataFrame:
    """The catalogue's columns from files (path, value: whole text). Files without a readable latitude and longitude are left out."""
    lines = F.slice(F.split("value", r"\r?\n"), 1, HEADER_LINES)
    noted = F.transform(F.filter(lines, lambda x: F.contains(x, F.lit("#"))), lambda x: F.trim(F.regexp_replace(x, r"^[^#]*#", "")))
    rows = files.withColumn("__h", noted)

    def text(key: str, word: str):
        x = F.try_element_at(F.filter(F.col("__h"), lambda y: F.startswith(y, F.lit(key))), F.lit(-1))
        return F.coalesce(F.trim(F.when(F.contains(x, F.lit(":")), F.regexp_replace(x, r"^[^:]*:", "")).otherwise(F.replace(x, F.lit(word), F.lit("")))), F.lit(""))

    def number(key: str):
        x = F.try_element_at(F.filter(F.col("__h"), lambda y: F.startswith(y, F.lit(key))), F.lit(-1))
        return F.element_at(F.split(F.trim(x), r"\s+"), -1).try_cast("double")

    def date(key: str):
        tokens = F.flatten(F.transform(F.filter(F.col("__h"), lambda y: F.startswith(y, F.lit(key))), lambda y: F.split(y, r"\s+")))
        return F.coalesce(F.try_element_at(F.filter(tokens, lambda t: F.contains(t, F.lit("/")) & (F.length(t) == 10)), F.lit(-1)), F.lit(""))

    out = rows.select(
        F.col("path").alias("file"), F.regexp_extract("path", r"([^/]*)$", 1).alias("filename"), text("SITE NAME", "SITE NAME").alias("site_name"), text("SITE CODE", "SITE CODE").alias("site_code"),
        text("COUNTRY", "COUNTRY").alias("country"), number("LATITUDE").alias("latitude"), number("LONGITUDE").alias("longitude"), date("START DATE").alias("start_date"), date("END DATE").alias("end_date"),
        F.coalesce(number("TIME ZONE"), F.lit(0.0)).alias("timezone"), text("DATUM", "DATUM INFORMATION").alias("datum"),
    )
    return out.filter("latitude is not null and longitude is not null")


def station_catalogue(spark: SparkSession, path: str, sim_start: str | None = None, sim_end: str | None = None) -> DataFrame:
    """A row for each readable gauge file that isn't hidden; with both bounds, those whose period meets the simulation's.

    Files are read by lines, in splits: only the marked lines of a file's first split go on, HEADER_LINES of them at most, in their order.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"))
    marked = lines.filter((F.col("split") == 0) & F.contains("value", F.lit("#")) & ~F.col("path").rlike(r"/\.[^/]*$"))
    first = marked.withColumn("rank", F.row_number().over(Window.partitionBy("path").orderBy("at"))).filter(F.col("rank") <= HEADER_LINES)
    heads = first.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "value"))), lambda x: x["value"]), "\n").alias("value"))
    out = gauge_headers(heads)
    if sim_start and sim_end:
        bounds = (F.lit(x).cast("timestamp") for x in (sim_start, sim_end))
        out = out.filter(overlaps(F.col("start_date"), F.col("end_date"), *bounds))
    return out


def read_gauges(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """file, ts, sea_level of usable observations: header skipped, flags checked, both bounds (if given) inclusive.

    Data lines are told from the header by their form, so that files may be split.
    """
    return gauge_rows(spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")), start, end)


def gauge_rows(lines: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """file, ts, sea_level of usable observations among lines (file, value)."""
    lines = lines.select(F.trim("value").alias("line"), "file")
    f = F.split("line", r"\s+")
    rows = lines.filter(F.col("line").rlike(r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}\s+\S+\s+\S+\s+\S+\s+\S+$"))
    obs = rows.select(
        "file", F.try_to_timestamp(F.concat_ws(" ", f[0], f[1]), F.lit("yyyy/MM/dd HH:mm:ss")).alias("ts"),
        F.nullif(f[2].try_cast("double"), F.lit(NO_LEVEL)).alias("sea_level"), f[3].try_cast("int").alias("qc_flag"), f[4].try_cast("int").alias("use_flag"),
    )
    obs = quality_filter(obs.filter("ts is not null")).select("file", "ts", "sea_level")
    return obs.filter(F.col("ts").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))) if start and end else obs


def node_index(nodes: DataFrame, base: int, on_disk: bool) -> DataFrame:
    """nodes with 0-based indices made to the model's base, or back."""
    shift = -base if on_disk else base
    return nodes.withColumns({c: F.col(c) + shift for c in ("node_index", "node_i", "node_j") if c in nodes.columns})
