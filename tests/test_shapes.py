import json
import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrid.functions.projections import FLATTENING, Lambert, Mercator
from skygrid.operators import regions, stations
from skygrid.sources import shapes, tables


def shape_files(path, records):
    """.shp, .shx and .dbf of polygons: records as (attributes, rings)."""
    body, index, at = b"", b"", 100
    for k, (_, rings) in enumerate(records):
        points = [p for r in rings for p in r]
        starts = np.cumsum([0] + [len(r) for r in rings[:-1]]).tolist() if rings else []
        raw = struct.pack("<i4d2i", 5, 0, 0, 0, 0, len(rings), len(points)) + struct.pack(f"<{len(rings)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in points) if rings else struct.pack("<i", 0)
        body += struct.pack(">2i", k + 1, len(raw) // 2) + raw
        index += struct.pack(">2i", at // 2, len(raw) // 2)
        at += 8 + len(raw)
    head = lambda n: struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + n) // 2) + struct.pack("<2i8d", 1000, 5, *[0.0] * 8)
    (path.parent / f"{path.name}.shp").write_bytes(head(len(body)) + body)
    (path.parent / f"{path.name}.shx").write_bytes(head(len(index)) + index)
    names = list(records[0][0])
    fields = b"".join(n.encode().ljust(11, b"\0") + b"C" + bytes(4) + bytes([12, 0]) + bytes(14) for n in names) + b"\r"
    rows = b"".join(b" " + b"".join(a[n].encode("utf-8").ljust(12) for n in names) for a, _ in records)
    (path.parent / f"{path.name}.dbf").write_bytes(struct.pack("<4BIHH20x", 3, 24, 1, 1, len(records), 32 + len(fields), 1 + 12 * len(names)) + fields + rows + b"\x1a")


def box(x, y, s, clockwise=True):
    out = [(x, y), (x, y + s), (x + s, y + s), (x + s, y), (x, y)]
    return out if clockwise else out[::-1]


def test_shapes_are_those_of_the_same_geojson(spark, tmp_path, monkeypatch):
    """Polygons with holes and several parts, in whatever order their rings come; read in several tasks."""
    monkeypatch.setattr(shapes, "SHAPES", 2)
    parts = [("CO", [[box(0, 0, 4), box(1, 1, 1, False)], [box(10, 0, 2)]]), ("NÉ", [[box(0, 10, 9), box(1, 11, 2, False), box(4, 14, 1, False)]]), ("CO", [[box(20, 20, 1)]]), ("KS", [[box(30, 0, 5), box(31, 1, 3, False)], [box(32, 2, 1)]]), ("ZZ", [])]
    shape_files(tmp_path / "s", [({"STUSPS": code, "NAME": "n"}, [r for p in ps[::-1] for r in p[::-1]]) for code, ps in parts])
    features = [{"type": "Feature", "properties": {"STUSPS": code}, "geometry": {"type": "MultiPolygon", "coordinates": ps}} for code, ps in parts]
    (tmp_path / "s.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    own = shapes.shapefile_rings(spark, f"file://{tmp_path}/s.shp", "STUSPS", properties=("STUSPS",))
    same = tables.geojson_rings(spark, str(tmp_path / "s.json"), "STUSPS")
    table = lambda df: sorted((r.region, sorted((p.x, p.y) for p in r.points), r.ring > 0) for r in df.collect())
    assert table(own) == table(same) and own.rdd.getNumPartitions() == 3
    shells = {(r.polygon, r.ring): [(p.x, p.y) for p in r.points] for r in own.collect()}
    assert len({p for p, _ in shells}) == 6 and all(any(x <= hx <= x + 9 for x, _ in shells[p, 0]) for (p, k), pts in shells.items() if k for hx, _ in pts[:1])
    spots = spark.range(40).crossJoin(spark.range(22).withColumnRenamed("id", "k")).select((F.col("id") * 100 + F.col("k")).alias("station_id"), (F.col("id") - 0.5).alias("longitude"), (F.col("k") - 0.5).alias("latitude"))
    inside = [{tuple(r) for r in regions.members(spots, regions.edges(x)).collect()} for x in (own, same)]
    assert inside[0] == inside[1] and len(inside[0]) > 80
    assert {r.region for r in shapes.shapefile_rings(spark, str(tmp_path / "s"), "STUSPS", "STUSPS <> 'CO'", ("STUSPS",)).collect()} == {"NÉ", "KS"}
    (tmp_path / "s.shx").write_bytes(b"no index" * 20)
    with pytest.raises(shapes.InvalidShapes):
        shapes.shapefile(spark, str(tmp_path / "s"))


@pytest.mark.parametrize("projection", [Lambert(), Lambert(parallels=(33.0, 45.0), latitude=23.0, longitude=-96.0), Lambert(parallels=(-30.0, -50.0), latitude=-40.0, longitude=20.0), Mercator(), Mercator(flattening=FLATTENING, longitude=10.0)])
def test_projections_go_both_ways(spark, projection):
    south = isinstance(projection, Lambert) and projection.latitude < 0
    df = spark.range(4000).select((F.rand(1) * 100 + projection.longitude - 50).alias("lon"), ((F.rand(2) * 75 + 2) * (-1 if south else 1)).alias("lat"))
    x, y = projection.forward(F.col("lon"), F.col("lat"))
    there = df.withColumns({"x": x, "y": y})
    lon, lat = projection.inverse(F.col("x"), F.col("y"))
    off = there.agg(F.max(F.abs(lon - F.col("lon"))).alias("lon"), F.max(F.abs(lat - F.col("lat"))).alias("lat")).first()
    assert off.lon < 1e-9 and off.lat < 1e-9


def test_known_points_of_projections(spark):
    """A published example of the conic on another ellipsoid, and the corner of the web map."""
    clarke = Lambert(longitude=-96.0, latitude=23.0, parallels=(33.0, 45.0), axis=6_378_206.4, flattening=1 / 294.978698)
    lam = spark.range(1).select(*clarke.forward(F.lit(-75.0), F.lit(35.0))).first()
    assert abs(lam[0] - 1_894_410.9) < 0.1 and abs(lam[1] - 1_564_649.5) < 0.1
    web = spark.range(1).select(*Mercator().forward(F.lit(180.0), F.lit(math.degrees(2 * math.atan(math.exp(math.pi)) - math.pi / 2)))).first()
    assert abs(web[0] - web[1]) < 1e-6 and abs(web[0] - math.pi * 6_378_137) < 1e-6


def test_rings_in_metres(spark):
    rings = spark.createDataFrame([("a", 1, 0, [{"x": -97.5, "y": 38.5}, {"x": -90.0, "y": 41.0}])], "region string, polygon int, ring int, points array<struct<x: double, y: double>>")
    metres = rings.withColumn("points", F.transform("points", lambda p: F.struct(*[c.alias(n) for c, n in zip(Lambert().forward(p["x"], p["y"]), "xy", strict=True)])))
    back = shapes.in_degrees(metres, Lambert()).first().points
    assert [(round(p.x, 9), round(p.y, 9)) for p in back] == [(-97.5, 38.5), (-90.0, 41.0)]
    table = stations.on_map(spark.createDataFrame([("a", -97.5, 38.5), ("b", 10.0, 50.0)], "station_id string, longitude double, latitude double")).collect()
    assert [(r.station_id, round(r.x, 6), round(r.y, 6)) for r in table] == [("a", 0.0, 0.0)]
