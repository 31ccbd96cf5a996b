"""Series in the classic binary layout of netCDF (versions 1, 2 and 5), as a Spark data source.

    classic.read_classic(spark, "/shared/twl_*.nc", "twl").filter("time_h >= 700000")

A file's header is read once, where the scan is planned; every partition is a slab of
consecutive rows of the variable's leading dimension, about `SLAB` bytes, read by
one task. Dimensions are known by their names: (time, node) and (node, time) are
both read, others are an error. Times are decoded with the file's own units and calendar
rules (see calendars.axis_hours). Bounds on time_h, given as options or pushed down from a
filter, turn into ranges of rows, so that what lies outside isn't read.

Files are opened with pyarrow's file systems: paths that all executors share, or URIs that
those know. `export` writes such files, one a year, in a stream of time steps.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidelake.functions import calendars as C
from tidelake.schema import FILL, check_dimensions

SLAB = 32 << 20
SCHEMA = "node_id long, file_year int, time_h double, value double, file string"
# Numbers of the format's types, tags of the header's lists.
TYPES = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: ">u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}
DIMENSION, VARIABLE, ATTRIBUTE = 10, 11, 12


@dataclass
class Variable:
    dims: tuple[str, ...]
    shape: tuple[int, ...]
    attrs: dict
    kind: np.dtype
    begin: int
    stride: int  # bytes from one row of the leading dimension to the next


@dataclass
class Header:
    attrs: dict
    variables: dict[str, Variable] = field(default_factory=dict)


def open_file(path: str):
    """A random-access file, wherever pyarrow finds it."""
    system, at = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return system.open_input_file(at)


def read_header(f) -> Header:
    """The header of an open file."""
    raw = f.read(1 << 16)
    at = 4
    if raw[:3] != b"CDF" or raw[3] not in (1, 2, 5):
        raise ValueError("not a file in the classic layout")
    version = raw[3]
    count, offset = (">q" if version == 5 else ">i"), (">i" if version == 1 else ">q")

    def take(n: int) -> bytes:
        nonlocal raw, at
        while at + n > len(raw):
            more = f.read(1 << 20)
            if not more:
                raise ValueError("the header ends early")
            raw += more
        at += n
        return raw[at - n : at]

    def number(form: str) -> int:
        return struct.unpack(form, take(struct.calcsize(form)))[0]

    def padded(n: int) -> bytes:
        got = take(n)
        take(-n % 4)
        return got

    def name() -> str:
        return padded(number(count)).decode()

    def listed(tag: int) -> range:
        found, n = number(">i"), number(count)
        if found not in (0, tag) or found == 0 and n:
            raise ValueError("the header's lists are out of order")
        return range(n)

    def attributes() -> dict:
        out = {}
        for _ in listed(ATTRIBUTE):
            key = name()
            kind, n = TYPES[number(">i")], number(count)
            data = padded(n * np.dtype(kind).itemsize)
            out[key] = data.decode(errors="replace").rstrip("\0") if kind == "S1" else np.frombuffer(data, kind)[0].item() if n == 1 else np.frombuffer(data, kind).tolist()
        return out

    records = number(count)
    dims = [(name(), number(count)) for _ in listed(DIMENSION)]
    head = Header(attributes())
    in_records = []
    for _ in listed(VARIABLE):
        key = name()
        ids = [number(count) for _ in range(number(count))]
        attrs, kind, _, begin = attributes(), np.dtype(TYPES[number(">i")]), number(count), number(offset)
        shape = tuple(records if dims[i][1] == 0 else dims[i][1] for i in ids)
        row = int(np.prod(shape[1:], dtype=np.int64)) * kind.itemsize
        head.variables[key] = Variable(tuple(dims[i][0] for i in ids), shape, attrs, kind, begin, row)
        if ids and dims[ids[0]][1] == 0:
            in_records.append((key, row))
    # A record holds a row of each variable along the open dimension, padded to 4 bytes unless it is the only one.
    record = in_records[0][1] if len(in_records) == 1 else sum(-(-row // 4) * 4 for _, row in in_records)
    for key, _ in in_records:
        head.variables[key].stride = record
    return head


def read_rows(f, v: Variable, start: int, stop: int) -> np.ndarray:
    """Rows start .. stop - 1 of the leading dimension."""
    row = int(np.prod(v.shape[1:], dtype=np.int64)) * v.kind.itemsize
    f.seek(v.begin + start * v.stride)
    if v.stride == row:
        data = f.read((stop - start) * row)
    else:
        raw = f.read((stop - start - 1) * v.stride + row) if stop > start else b""
        data = b"".join(raw[i * v.stride : i * v.stride + row] for i in range(stop - start))
    return np.frombuffer(data, v.kind).reshape(stop - start, *v.shape[1:])


def times_of(f, head: Header) -> tuple[np.ndarray, str]:
    """time_h of a file's axis by its own units, and its calendar."""
    v = head.variables["time"]
    calendar = v.attrs.get("calendar", "standard")
    start, unit = C.axis_start(v.attrs["units"], calendar)
    return read_rows(f, v, 0, v.shape[0]).astype(float) * unit + start, calendar


class Slab(InputPartition):
    def __init__(self, path: str, start: int, stop: int):
        self.path, self.start, self.stop = path, start, stop


class ClassicReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths = _paths(options["path"])
        self.variable, self.slab = options.get("variable", ""), int(options.get("slab", SLAB))
        self.low, self.high = float(options.get("start_h", "-inf")), float(options.get("end_h", "inf"))

    def pushFilters(self, filters):
        """Bounds on time_h are taken over as ranges of rows; all filters are still applied by Spark, as a slab may hold more."""
        for x in filters:
            if getattr(x, "attribute", None) == ("time_h",) and isinstance(getattr(x, "value", None), (int, float)):
                kind = type(x).__name__
                if kind.startswith("Greater") or kind == "EqualTo":
                    self.low = max(self.low, float(x.value))
                if kind.startswith("Less") or kind == "EqualTo":
                    self.high = min(self.high, float(x.value))
            yield x

    def partitions(self) -> list[Slab]:
        out = []
        for path in self.paths:
            with open_file(path) as f:
                head = read_header(f)
                v = self._found(head)
                low, high = 0, v.shape[0]
                if check_dimensions(v.dims):
                    times, _ = times_of(f, head)
                    there = np.flatnonzero((times >= self.low) & (times <= self.high))
                    low, high = (int(there[0]), int(there[-1]) + 1) if len(there) else (0, 0)
            rows = max(1, self.slab // max(1, v.stride))
            out += [Slab(path, k, min(k + rows, high)) for k in range(low, high, rows)]
        return out or [Slab("", 0, 0)]

    def _found(self, head: Header) -> Variable:
        names = [self.variable] if self.variable else [k for k, v in head.variables.items() if len(v.dims) == 2 and set(v.dims) == {"time", "node"}]
        if len(names) != 1 or names[0] not in head.variables:
            raise ValueError(f"expected one variable over time and node, found {names}; name it by the option variable")
        return head.variables[names[0]]

    def read(self, partition: Slab) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        with open_file(partition.path) as f:
            head = read_header(f)
            v = self._found(head)
            times, calendar = times_of(f, head)
            year = C.year_of(float(times[0]), calendar) if len(times) else 0
            inside = (times >= self.low) & (times <= self.high)
            step = max(1, (1 << 18) // max(1, int(np.prod(v.shape[1:]))))
            for k in range(partition.start, partition.stop, step):
                stop = min(k + step, partition.stop)
                values = read_rows(f, v, k, stop).astype(float)
                if check_dimensions(v.dims):
                    which = np.flatnonzero(inside[k:stop])
                    node, at = np.tile(np.arange(v.shape[1]), len(which)), np.repeat(times[k:stop][which], v.shape[1])
                    values = values[which].ravel()
                else:
                    which = np.flatnonzero(inside)
                    node, at = np.repeat(np.arange(k, stop), len(which)), np.tile(times[which], stop - k)
                    values = values[:, which].ravel()
                missing = ~(values < FILL / 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node, pa.int64()), pa.array(np.full(len(node), year, np.int32)), pa.array(at), pa.array(values, mask=missing), pa.array([partition.path] * len(node), pa.string())],
                    ["node_id", "file_year", "time_h", "value", "file"],
                )


def _paths(path: str) -> list[str]:
    """The files of a path: itself, those in a folder that end in .nc, or those that a pattern with * in its last part names."""
    import fnmatch

    uri = "://" in path or path.startswith("file:")
    folder, _, last = path.rpartition("/")
    pattern = last if "*" in last else None
    system, at = fs.FileSystem.from_uri(folder if pattern else path) if uri else (fs.LocalFileSystem(), folder if pattern else path)
    if not pattern and system.get_file_info(at).type == fs.FileType.File:
        return [path]
    scheme = path[: path.index(at)] if uri and at in path else ""
    found = [x.path for x in system.get_file_info(fs.FileSelector(at)) if x.type == fs.FileType.File and fnmatch.fnmatch(x.base_name, pattern or "*.nc")]
    if not found:
        raise ValueError(f"no files at {path}")
    return [scheme + x for x in sorted(found)]


class ClassicSeries(DataSource):
    """node_id (place along the node dimension), file_year (of the first instant), time_h, value (null where missing), file."""

    @classmethod
    def name(cls) -> str:
        return "classic"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ClassicReader:
        return ClassicReader(self.options)


def read_classic(spark: SparkSession, path: str, variable: str | None = None, **options) -> DataFrame:
    """The series of the files at path; start_h, end_h (hours) and slab (bytes) as options."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")  # a reader that takes filters over needs it
    spark.dataSource.register(ClassicSeries)
    reader = spark.read.format("classic")
    for key, value in ({"variable": variable} | options).items():
        reader = reader.option(key, value) if value is not None else reader
    return reader.load(path)


def header_bytes(n_nodes: int, n_times: int, variable: str, attrs: dict[str, str], of_variable: dict[str, str], units: str, calendar: str) -> tuple[bytes, int]:
    """The header (version 2) of a file with time as open dimension: variables time and `variable` (time, node); and the bytes of a record."""

    def text(x: str) -> bytes:
        raw = x.encode()
        return struct.pack(">i", len(raw)) + raw + b"\0" * (-len(raw) % 4)

    def attributes(given: dict) -> bytes:
        out = struct.pack(">ii", ATTRIBUTE if given else 0, len(given))
        for k, v in given.items():
            if isinstance(v, float):
                out += text(k) + struct.pack(">iif", 5, 1, v)
            else:
                raw = str(v).encode()
                out += text(k) + struct.pack(">ii", 2, len(raw)) + raw + b"\0" * (-len(raw) % 4)
        return out

    start = b"CDF\x02" + struct.pack(">i", n_times) + struct.pack(">ii", DIMENSION, 2) + text("time") + struct.pack(">i", 0) + text("node") + struct.pack(">i", n_nodes) + attributes(attrs)
    time = text("time") + struct.pack(">ii", 1, 0) + attributes({"units": units, "calendar": calendar}) + struct.pack(">ii", 6, 8)
    data = text(variable) + struct.pack(">iii", 2, 0, 1) + attributes({"_FillValue": float(np.float32(FILL)), **of_variable}) + struct.pack(">ii", 5, 4 * n_nodes)
    size = len(start) + 8 + len(time) + 8 + len(data) + 8
    out = start + struct.pack(">ii", VARIABLE, 2) + time + struct.pack(">q", size) + data + struct.pack(">q", size + 8)
    return out, 8 + 4 * n_nodes


def export(series: DataFrame, folder: str, variable: str, attrs: dict[str, str] | None = None, calendar: str = "standard") -> DataFrame:
    """Writes series (node_id from 0 on, file_year, time_h, value) as a file for each year below folder, which executors share; file_year, path, n_times of what was written.

    A file's time steps come to one task in order and leave it one by one: it holds a step of all nodes, not the file.
    """
    system, at = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
    system.create_dir(at)
    sizes = {r["file_year"]: (r["times"], r["nodes"]) for r in series.groupBy("file_year").agg(F.countDistinct("time_h").alias("times"), (F.max("node_id") + 1).alias("nodes")).collect()}  # a row a file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, year, step, done, path = None, None, None, 0, ""

        def flush() -> None:
            nonlocal done
            if step is not None:
                out.write(struct.pack(">d", step[0]) + step[1].tobytes())
                done += 1

        for b in batches:
            years, nodes, times, values = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            for k in np.split(np.arange(len(years)), np.flatnonzero((years[1:] != years[:-1]) | (times[1:] != times[:-1])) + 1):
                if not len(k):
                    continue
                if years[k[0]] != year:
                    if out is not None:
                        flush()
                        out.close()
                        yield pa.RecordBatch.from_arrays([pa.array([year], pa.int32()), pa.array([path]), pa.array([done], pa.int64())], ["file_year", "path", "n_times"])
                    year, step, done = int(years[k[0]]), None, 0
                    path = f"{at.rstrip('/')}/{variable}_{year}.nc"
                    out = (fs.FileSystem.from_uri(folder)[0] if "://" in folder or folder.startswith("file:") else fs.LocalFileSystem()).open_output_stream(path)
                    out.write(header_bytes(sizes[year][1], sizes[year][0], variable, attrs or {}, {"standard_name": variable}, "hours since 1900-01-01 00:00:00", calendar)[0])
                if step is None or step[0] != times[k[0]]:
                    flush()
                    step = (times[k[0]], np.full(sizes[year][1], FILL, ">f4"))
                some = values[k].astype(float)
                step[1][nodes[k]] = np.where(np.isnan(some), FILL, some)
        if out is not None:
            flush()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([year], pa.int32()), pa.array([path]), pa.array([done], pa.int64())], ["file_year", "path", "n_times"])

    rows = series.select("file_year", "node_id", "time_h", F.col("value").cast("double")).repartition("file_year").sortWithinPartitions("file_year", "time_h", "node_id")
    return rows.mapInArrow(run, "file_year int, path string, n_times long")
