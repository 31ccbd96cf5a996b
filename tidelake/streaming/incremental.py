"""Incremental runs over files as they arrive, with Structured Streaming."""

from __future__ import annotations

import hashlib
import json

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.operators import tides
from tidelake.operators.periods import valid
from tidelake.schema import SERIES
from tidelake.sources import scratch, sinks


def stream_series(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(SERIES).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def daily_max_stream(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Daily maxima of a stream of (node_id, ts, value), once a day is past by `late`."""
    v = valid(F.col("value"))
    days = events.withWatermark("ts", late).groupBy("node_id", F.window("ts", "1 day"))
    best = days.agg(F.max(F.when(v.isNotNull(), F.struct(v.alias("v"), (-F.unix_micros("ts")).alias("t")))).alias("b"))
    return best.select("node_id", F.col("window.start").alias("day"), F.col("b.v").alias("value"), F.timestamp_micros(-F.col("b.t")).alias("ts"))


def accumulate(stream: DataFrame, out: str, checkpoint: str, t0: float, total_hours: float, names: list[str], mids: DataFrame | None = None) -> None:
    """Normal sums of the node-files that are new, a table of partial sums for each batch; a restart goes on where it stopped.

    A batch that is run again replaces its own table, so nothing counts twice. mids: the windows of the
    files (see tides.window_middles). Without them a batch must hold whole files, as windows run
    from a file's first hour, which a batch with some of its nodes needn't have.
    """

    def add(batch: DataFrame, number: int) -> None:
        tides.file_sums(tides.pack(batch, mids), t0, total_hours, names).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def summed(spark: SparkSession, out: str, n_columns: int) -> DataFrame:
    """node_id, __aty over all batches."""
    return tides.added(spark.read.parquet(out), n_columns)


class Fit:
    """A tidal fit that can stop after any file and go on: mergeable sums, kept by file, under what identifies them.

    axis: file_year, time_h of all files of the record. From it come t0, the record's length, the
    constituents that it tells apart, and each file's windows; a digest of these names the
    folder, so that sums made for another record, other constituents or other
    windows are never added to these: such a fit starts afresh, beside the old one.

    A file's A'Y by node and then its A'A are written whole and replaced whole; a file is
    done once its A'A is there. A solve adds up what is done.
    """

    def __init__(self, spark: SparkSession, out: str, axis: DataFrame, names: list[str] | None = None, calendar: str | None = None):
        tides.check_calendar(calendar)
        self.spark, self.axis = spark, scratch.stored(tides.axis_of(axis), "axis")
        self.t0, self.total = tides.record(self.axis)
        self.names = tides.resolvable(self.total, names)
        self.mids = tides._known_middles(self.axis)
        windows = sorted((r["file_year"], r["__start"], list(r["__mids"])) for r in self.mids.collect())  # a row a file
        said = {"t0": self.t0, "total_hours": self.total, "constituents": self.names, "nodal_hours": tides.NODAL_HOURS, "windows": hashlib.sha256(repr(windows).encode()).hexdigest()}
        self.files = [w[0] for w in windows]
        self.path = f"{out.rstrip('/')}/fit-{hashlib.sha256(json.dumps(said, sort_keys=True).encode()).hexdigest()[:16]}"
        if not sinks.is_done(spark, f"{self.path}/identity"):
            spark.createDataFrame([(json.dumps(said, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/identity")

    def done(self, file: int) -> bool:
        return sinks.is_done(self.spark, f"{self.path}/ata/file={file}")

    def add(self, series: DataFrame, most: int | None = None) -> list[int]:
        """Adds the files that are not done, `most` of them at most; which ones."""
        todo = [f for f in self.files if not self.done(f)][:most]
        for file in todo:
            packed = tides.pack(series.filter(F.col("file_year") == file), self.mids)
            tides.file_sums(packed, self.t0, self.total, self.names).write.mode("overwrite").parquet(f"{self.path}/aty/file={file}")
            own = self.axis.filter(F.col("file_year") == file)
            tides.file_matrices(own, self.t0, self.total, self.names, self.mids).write.mode("overwrite").parquet(f"{self.path}/ata/file={file}")
        return todo

    def solve(self, allow_rank_deficient: bool = False) -> tuple[DataFrame, dict]:
        """node_id, __c from the files that are done, and what the fit rests on."""
        files = [f for f in self.files if self.done(f)]
        if not files:
            raise ValueError("no file is done")
        k = 2 * len(self.names) + 2
        matrices = self.spark.read.parquet(*(f"{self.path}/ata/file={f}" for f in files)).orderBy("file_year").collect()
        ata = sum((np.array(r["a"]).reshape(k, k) for r in matrices), np.zeros((k, k)))
        sums = tides.added(self.spark.read.parquet(*(f"{self.path}/aty/file={f}" for f in files)), k)
        return tides.solved(sums, ata, allow_rank_deficient), {"t0": self.t0, "total_hours": self.total, "constituents": self.names}

    def detide(self, series: DataFrame, allow_rank_deficient: bool = False) -> DataFrame:
        """The series less the tide of the files that are done."""
        return tides.subtract(tides.pack(series, self.mids), *self.solve(allow_rank_deficient))
