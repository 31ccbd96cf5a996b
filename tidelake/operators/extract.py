"""Extraction of the matched nodes' series from mesh series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions import calendars as C
from tidelake.schema import DRY


def dry_to_null(value: Column) -> Column:
    return F.when(value >= DRY, value)


def clip(series: DataFrame, start: str | None = None, end: str | None = None, calendar: str | None = None, yearly: bool = False) -> DataFrame:
    """Rows from start to end, both inclusive: `y-m-d[ h:m:s]` in the series' calendar. On stored series the bounds reach the scan.

    yearly: each file holds instants of its own year, and of the next at most its first; then the files of other
    years aren't opened, as file_year is the partition of stored series.
    """
    for bound, keep in ((start, lambda b: F.col("time_h") >= b), (end, lambda b: F.col("time_h") <= b)):
        if bound is not None:
            series = series.filter(keep(C.axis_hours(F.lit(0.0), f"hours since {bound}", calendar)))
    if yearly and start is not None:
        series = series.filter(F.col("file_year") >= int(start.split("-")[0]) - 1)
    if yearly and end is not None:
        series = series.filter(F.col("file_year") <= int(end.split("-")[0]))
    return series


def extract(mesh_series: DataFrame, nodes: DataFrame, start: str | None = None, end: str | None = None, calendar: str | None = None, small_rows: int = 1_000_000, yearly: bool = False) -> DataFrame:
    """node_id, file_year, time_h, value (float; null where dry) of the nodes; nodes that several points share come back for each.

    mesh_series: node_index, file_year, time_h, value. The nodes are broadcast only
    if they are at most small_rows; else the join is left to Spark.
    """
    keys = nodes.select("node_id", "node_index")
    keys = F.broadcast(keys) if keys.limit(small_rows + 1).count() <= small_rows else keys
    got = clip(mesh_series, start, end, calendar, yearly).join(keys, "node_index")
    return got.select("node_id", "file_year", "time_h", dry_to_null(F.col("value")).cast("float").alias("value"))


def extract_sparse(mesh_series: DataFrame, nodes: DataFrame) -> DataFrame:
    """The full-precision series of a set of nodes, each once, by node_index; standard calendars only."""
    got = mesh_series.join(nodes.select("node_index").distinct(), "node_index", "left_semi")
    return got.withColumn("value", dry_to_null(F.col("value").cast("double")))


def todo_years(wanted: DataFrame, done: DataFrame) -> DataFrame:
    """Files that are not done, by their whole key, so that two files of a year are two."""
    return wanted.join(done, [c for c in wanted.columns if c in done.columns], "left_anti")


def bucketed(mesh_series: DataFrame, name: str, buckets: int, path: str | None = None) -> DataFrame:
    """mesh_series, stored as the table `name` in `buckets` buckets by node_index, each sorted by node and time.

    A gather from it (gather) joins bucket by bucket: the series, by far the larger side, isn't shuffled again, and
    inside a bucket the row groups of other nodes are skipped by their least and greatest node.
    """
    writer = mesh_series.write.mode("overwrite").bucketBy(buckets, "node_index").sortBy("node_index", "time_h")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return mesh_series.sparkSession.table(name)


def gather(stored: DataFrame, nodes: DataFrame) -> DataFrame:
    """node_id, file_year, time_h, value of the nodes from a bucketed table, whatever their number: a merge join to which only the nodes move."""
    keys = nodes.select("node_id", "node_index").hint("merge")
    got = stored.join(keys, "node_index")
    return got.select("node_id", "file_year", "time_h", dry_to_null(F.col("value")).cast("float").alias("value"))
