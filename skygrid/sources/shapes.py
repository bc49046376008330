"""Shapefiles as tables of rings: polygons of .shp by the ranges of their index (.shx), with the attributes of .dbf."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.functions.projections import Lambert, Mercator
from skygrid.sources import store

# Fixed values of the format: the file code and the types that hold polygons (plain, with heights, with measures).
CODE, POLYGONS = 9994, (5, 15, 25)
#: Shapes that a task reads.
SHAPES = 512

RINGS = "shape long, attributes map<string, string>, part int, ring int, points array<struct<x: double, y: double>>"


class InvalidShapes(ValueError):
    """Files that aren't a shapefile of polygons."""


def _fields(head: bytes) -> tuple[int, int, list[tuple[str, int, int]]]:
    """Bytes of a .dbf's header and of a record, and its fields: name, begin in the record, width."""
    size, step = struct.unpack_from("<HH", head, 8)
    fields, at = [], 1
    for k in range(32, size - 1, 32):
        if head[k : k + 1] == b"\r":
            break
        width = head[k + 16]
        fields.append((head[k : k + 11].split(b"\0")[0].decode("ascii", "replace"), at, width))
        at += width
    return size, step, fields


def _area(ring: np.ndarray) -> float:
    """Twice the signed area; below 0 for a ring that runs clockwise, as shells do."""
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float(np.sum(x[:-1] * y[1:] - x[1:] * y[:-1]))


def _holds(shell: np.ndarray, point: np.ndarray) -> bool:
    (x1, y1), (x2, y2) = shell[:-1].T, shell[1:].T
    spans = (y1 > point[1]) != (y2 > point[1])
    x = x1 + (point[1] - y1) * (x2 - x1) / np.where(spans, y2 - y1, 1.0)
    return bool(np.sum(spans & (point[0] < x)) % 2)


def parts_of(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Rings of one shape as shells, each with its holes: a hole belongs to the smallest shell around it; without one it is a shell."""
    rings = [r if (r[0] == r[-1]).all() else np.concatenate([r, r[:1]]) for r in rings if len(r)]
    shells = [r for r in rings if _area(r) <= 0] or rings
    out = [[s] for s in shells]
    for hole in (r for r in rings if not any(r is s for s in shells)):
        around = [k for k, s in enumerate(shells) if _holds(s, hole[0])]
        if around:
            out[min(around, key=lambda k: abs(_area(shells[k])))].append(hole)
        else:
            out.append([hole])
    return out


def _polygon(body: bytes) -> list[np.ndarray]:
    kind = struct.unpack_from("<i", body)[0]
    if kind == 0:
        return []
    if kind not in POLYGONS:
        raise InvalidShapes(f"type {kind} holds no polygons")
    n_parts, n_points = struct.unpack_from("<ii", body, 36)
    starts = np.frombuffer(body, "<i4", n_parts, 44)
    points = np.frombuffer(body, "<f8", 2 * n_points, 44 + 4 * n_parts).reshape(-1, 2)
    return np.split(points, starts[1:])


def shapefile(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """shape, attributes, part, ring (0: the shell), points of a shapefile; path with or without .shp.

    The driver reads lengths and headers alone; each task reads some records of the index and what they point to.
    """
    base = path.removesuffix(".shp")

    def opened(ending: str) -> pa.NativeFile:
        system, at = store.at(base + ending)
        return system.open_input_file(at)

    with opened(".shx") as f:
        count = (f.size() - 100) // 8
        if struct.unpack(">i", f.read(4))[0] != CODE:
            raise InvalidShapes(path)
    with opened(".dbf") as f:
        size = struct.unpack_from("<H", f.read(32), 8)[0]
        f.seek(0)
        head_bytes, step, fields = _fields(f.read(size))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with opened(".shx") as index, opened(".shp") as shapes, opened(".dbf") as table:
            for first in (k * SHAPES for batch in batches for k in batch.column("id").to_pylist()):
                n = min(SHAPES, count - first)
                index.seek(100 + 8 * first)
                where = np.frombuffer(index.read(8 * n), ">i4").reshape(-1, 2).astype(np.int64) * 2
                table.seek(head_bytes + step * first)
                lines = table.read(step * n)
                rows = []
                for k, (at, size) in enumerate(where.tolist()):
                    shapes.seek(at + 8)
                    line = lines[step * k : step * (k + 1)]
                    attributes = [(name, line[a : a + w].decode(encoding, "replace").strip(" \0")) for name, a, w in fields]
                    for part, rings in enumerate(parts_of(_polygon(shapes.read(size)))):
                        rows += [(first + k, attributes, part, ring, [{"x": x, "y": y} for x, y in points.tolist()]) for ring, points in enumerate(rings)]
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(_RINGS.types)], schema=_RINGS)

    return spark.range(-(-count // SHAPES)).repartition(max(1, -(-count // SHAPES))).mapInArrow(work, RINGS)


_POINTS = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))
_RINGS = pa.schema([("shape", pa.int64()), ("attributes", pa.map_(pa.string(), pa.string())), ("part", pa.int32()), ("ring", pa.int32()), ("points", _POINTS)])


def shapefile_rings(spark: SparkSession, path: str, region: str, condition: str | None = None, properties: tuple[str, ...] = ("STUSPS", "RTO_ISO", "LOC_TYPE")) -> DataFrame:
    """region, polygon, ring, points, as ``tables.geojson_rings`` gives them.

    region: SQL over the named attributes that gives the region; condition: SQL that selects shapes.
    """
    rows = shapefile(spark, path).select("shape", "part", "ring", "points", *[F.col("attributes")[p].alias(p) for p in properties])
    rows = rows.where(condition) if condition else rows
    return rows.select(F.expr(region).cast("string").alias("region"), (F.col("shape") * 100_000 + F.col("part")).alias("polygon"), "ring", "points")


def in_degrees(rings: DataFrame, projection: Lambert | Mercator) -> DataFrame:
    """rings with points in metres of a projection as degrees."""
    point = lambda p: F.struct(*[x.alias(c) for x, c in zip(projection.inverse(p["x"], p["y"]), "xy", strict=True)])
    return rings.withColumn("points", F.transform("points", point))
