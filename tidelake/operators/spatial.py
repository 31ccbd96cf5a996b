"""Matching points to their nearest mesh nodes, by an index of packed cells.

Nodes are sorted by range along a curve through the cube around the earth (a hierarchical
key: the bits of x, y and z interleaved) and cut into cells of up to `CELL` neighbours
on it, so that cells are small where nodes are dense and none holds more, whatever lies in one place.
A cell has the least box around its nodes; boxes of neighbouring cells are boxed again, up to one.

A point descends those boxes: no node of a box is nearer than its near side, and one
lies within its far corner, so whatever starts beyond the nearest far corner is left out.
Points meet the nodes of the few cells that stay, a cell in a task's group, where a small
tree halves nodes and drops halves that lie too far away.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.geo import RADIUS_KM, ecef
from tidelake.sources import scratch

#: Nodes of a cell, boxes in a box, points of a cell in a group, cells whose boxes may be sent to all tasks, nodes that a small tree doesn't halve.
CELL, FAN, POINTS, CELLS, LEAF = 1024, 16, 8192, 250_000, 32
#: Bits of each coordinate in the key: cells of 12 m.
BITS = 20


def _placed(df: DataFrame, lon: str, lat: str, prefix: str) -> DataFrame:
    return df.withColumns(dict(zip((f"{prefix}x", f"{prefix}y", f"{prefix}z"), ecef(F.col(lon), F.col(lat)))))


def curve_key(*xyz: Column) -> Column:
    """The place of a position on the curve: the bits of its coordinates in the cube around the earth, interleaved."""
    # Shifts and masks that spread 20 bits to every third place.
    spread = ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249))
    out = F.lit(0).cast("long")
    for k, c in enumerate(xyz):
        x = F.least(F.lit((1 << BITS) - 1), F.floor((c + RADIUS_KM) / (2 * RADIUS_KM) * (1 << BITS)).cast("long"))
        for by, mask in spread:
            x = x.bitwiseOR(F.shiftleft(x, by)).bitwiseAND(F.lit(mask).cast("long"))
        out = out.bitwiseOR(F.shiftleft(x, k))
    return out


def index_mesh(mesh: DataFrame, path: str | None = None, cell: int = CELL) -> DataFrame:
    """The index of mesh (node_index, lon, lat): node_index, x, y, z, cell; written to path (the shared folder by default), as a mesh is searched often.

    Where more than CELLS cells of that size were needed, cells are larger.
    """
    nodes = mesh.select("node_index", *(c.alias(n) for n, c in zip("xyz", ecef(F.col("lon"), F.col("lat")))))
    keyed = nodes.withColumn("key", curve_key(*map(F.col, "xyz")))
    size = max(cell, -(-mesh.count() // CELLS))
    order = ["key", "node_index"]
    at = F.monotonically_increasing_id()  # the partition, then the row in it: a cell never has rows of two partitions
    rows = keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", at)
    cell_of = F.shiftleft(F.shiftright("at", 33), 33) + F.floor(F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) / size).cast("long")
    path = path or scratch.fresh(mesh.sparkSession, "mesh-index")
    rows.select("node_index", "x", "y", "z", cell_of.alias("cell")).write.mode("overwrite").parquet(path)
    return mesh.sparkSession.read.parquet(path)


class Boxes:
    """The cells' boxes, and the boxes around FAN of them each, level by level up to one."""

    def __init__(self, cells: np.ndarray, low: np.ndarray, high: np.ndarray):
        order = np.argsort(cells)
        self.cells, self.levels = cells[order], [(low[order], high[order])]
        while len(self.levels[-1][0]) > 1:
            low, high = self.levels[-1]
            starts = np.arange(0, len(low), FAN)
            self.levels.append((np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)))

    def search(self, xyz: np.ndarray, most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
        """Points and places in cells of all that may hold a point's nearest node."""
        if not len(self.cells):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        point, box = np.arange(len(xyz)), np.zeros(len(xyz), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            low, high = self.levels[level]
            if level < len(self.levels) - 1:
                n = np.minimum(FAN, len(low) - box * FAN)
                point, first = np.repeat(point, n), np.repeat(box * FAN - (np.cumsum(n) - n), n)
                box = first + np.arange(len(first))
            near, far = np.zeros(len(box)), np.zeros(len(box))
            for d in range(3):  # a coordinate at a time: few large arrays at once
                p, a, b = xyz[point, d], low[box, d], high[box, d]
                near += np.maximum(0, np.maximum(a - p, p - b)) ** 2
                far += np.maximum(np.abs(p - a), np.abs(p - b)) ** 2
            best = np.full(len(xyz), np.inf)
            np.minimum.at(best, point, far)
            stays = near <= best[point] * (1 + 1e-9) + 1e-9  # ties, and the roundings of sums, stay in
            point, box = point[stays], box[stays]
        return point, box


def nearest_of(points: np.ndarray, nodes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each point's least distance to the nodes and the smallest id at it, by a tree that is built as it is searched."""
    best, found = np.full(len(points), np.inf), np.full(len(points), np.iinfo(np.int64).max)

    def look(which: np.ndarray, some: np.ndarray) -> None:
        if not len(which):
            return
        own = nodes[some]
        if len(some) <= LEAF:
            for k in range(0, len(which), 4096):
                w = which[k : k + 4096]
                gap = points[w][:, None, :] - own[None, :, :]
                d = np.sqrt(gap[..., 0] * gap[..., 0] + gap[..., 1] * gap[..., 1] + gap[..., 2] * gap[..., 2])
                least = d.min(1)
                first = np.where(d == least[:, None], ids[some][None, :], np.iinfo(np.int64).max).min(1)
                less = (least < best[w]) | (least == best[w]) & (first < found[w])
                best[w[less]], found[w[less]] = least[less], first[less]
            return
        low, high = own.min(0), own.max(0)
        p = points[which]
        gap = np.maximum(0, np.maximum(low - p, p - high))
        which = which[np.sqrt((gap * gap).sum(1)) <= best[which] * (1 + 1e-12)]
        axis = int(np.argmax(high - low))
        order = np.argsort(own[:, axis], kind="stable")
        half = len(order) // 2
        cut = own[order[half], axis]
        left = points[which, axis] < cut
        look(which[left], some[order[:half]])
        look(which[~left], some[order[half:]])
        look(which[left], some[order[half:]])
        look(which[~left], some[order[:half]])

    look(np.arange(len(points)), np.arange(len(nodes)))
    return best, found


def nearest_in(points: DataFrame, index: DataFrame, max_km: float = 50.0) -> DataFrame:
    """points (point_id, lon, lat) with node_index and dist_km of the nearest node of the index (see index_mesh).

    The distance is the chord; equal distances go to the smaller index. Beyond max_km the index is -1 and the
    distance stays. Every row of points comes back once, in any number per node. The boxes, a row for each cell and
    no more than about CELLS by the way the index is built, are counted before they are sent to the tasks.
    """
    spark = points.sparkSession
    boxes = index.groupBy("cell").agg(*(f(c).alias(f"{w}{c}") for w, f in (("low", F.min), ("high", F.max)) for c in "xyz"))
    found = boxes.limit(4 * CELLS + 1).toPandas()
    if len(found) > 4 * CELLS:
        raise ValueError(f"the index has more than {4 * CELLS} cells: build it with larger ones")
    sent = spark.sparkContext.broadcast(Boxes(found["cell"].to_numpy(np.int64), found[["lowx", "lowy", "lowz"]].to_numpy(float), found[["highx", "highy", "highz"]].to_numpy(float)))

    def descend(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for k in range(0, len(pdf), 2048):
                some = pdf.iloc[k : k + 2048]
                point, box = sent.value.search(some[["px", "py", "pz"]].to_numpy(float))
                yield some.iloc[point].assign(cell=sent.value.cells[box])

    # Positions are matched once each, however many rows have them.
    places = _placed(points.select("lon", "lat").distinct(), "lon", "lat", "p")
    met = scratch.stored(places.mapInPandas(descend, "lon double, lat double, px double, py double, pz double, cell long"), "cells")
    crowds = met.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(POINTS)).cast("int").alias("blocks"))
    here = met.join(crowds, "cell").withColumn("block", F.pmod(F.xxhash64("lon", "lat"), "blocks").cast("int")).drop("blocks")
    there = index.join(crowds, "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        d, ids = nearest_of(left[["px", "py", "pz"]].to_numpy(float), right[["x", "y", "z"]].to_numpy(float), right["node_index"].to_numpy(np.int64))
        return left[["lon", "lat"]].assign(d=d, node_index=ids)

    keys = ["cell", "block"]
    near = here.groupBy(*keys).cogroup(there.groupBy(*keys)).applyInPandas(search, "lon double, lat double, d double, node_index long")
    best = near.groupBy("lon", "lat").agg(F.min(F.struct("d", "node_index")).alias("b"))
    out = points.join(best, ["lon", "lat"], "left")
    index_of = F.when(F.col("b.d") <= max_km, F.col("b.node_index")).otherwise(F.lit(-1).cast("long"))
    return out.select(*points.columns, F.when(F.col("b").isNotNull(), index_of).otherwise(-1).alias("node_index"), F.col("b.d").alias("dist_km"))


def nearest(points: DataFrame, mesh: DataFrame, max_km: float = 50.0, cell_km: float | None = None) -> DataFrame:
    """nearest_in with an index of mesh that is built for this call; cell_km is accepted and no longer of use."""
    return nearest_in(points, index_mesh(mesh), max_km)


def wet_only(mesh: DataFrame, mask: DataFrame) -> DataFrame:
    """The nodes that never fall dry; ValueError unless the mask has a row for each node."""
    if mesh.count() != mask.count():
        raise ValueError("the wet mask and the mesh differ in length")
    return mesh.join(mask.filter("always_wet").select("node_index"), "node_index", "left_semi")


def wet_count(mask: DataFrame) -> DataFrame:
    """How many nodes there are, and how many of them never fall dry."""
    return mask.agg(F.count("*").alias("n_nodes"), F.count_if("always_wet").alias("n_wet"))


def with_nodes(values: DataFrame, nodes: DataFrame) -> DataFrame:
    """Values by node_id with the position of their node; values of nodes that aren't in the block stay, with nulls."""
    return values.join(nodes.select("node_id", "node_lon", "node_lat", "node_depth"), "node_id", "left")


def match_points(points: DataFrame, mesh: DataFrame, mask: DataFrame | None = None, index: DataFrame | None = None) -> DataFrame:
    """The node block of the points, without a limit of distance: repeated nodes stay, node_id keeps the points' order.

    index: of the mesh, or of its wet nodes where there is a mask; built here if it isn't given.
    """
    if index is None:
        index = index_mesh(mesh if mask is None else wet_only(mesh, mask))
    got = nearest_in(points, index, max_km=1e6).join(mesh.select("node_index", F.col("lon").alias("node_lon"), F.col("lat").alias("node_lat"), F.col("depth").alias("node_depth")), "node_index", "left")
    return got.select(F.col("point_id").alias("node_id"), "node_index", "node_lon", "node_lat", "node_depth", F.col("lon").alias("point_lon"), F.col("lat").alias("point_lat"), F.col("dist_km").cast("float").alias("dist_km"))


def match_stats(nodes: DataFrame, far_km: float = 100.0) -> DataFrame:
    return nodes.agg(F.median("dist_km").alias("median_km"), F.max("dist_km").alias("max_km"), F.count_if(F.col("dist_km") > far_km).alias("n_far"))


def extent(nodes: DataFrame, lon: str = "node_lon", lat: str = "node_lat", depth: str = "node_depth") -> DataFrame:
    """Smallest and largest longitude, latitude and depth."""
    return nodes.agg(*(f(c).alias(f"{n}_{w}") for n, c in (("lon", lon), ("lat", lat), ("depth", depth)) for w, f in (("min", F.min), ("max", F.max))))


