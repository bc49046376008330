import math
import random

from pyspark.sql import functions as F

from skygrid.operators import regions


def ring(spark, shapes):
    """shapes: (region, polygon, ring, points)."""
    rows = [(r, p, k, [{"x": float(x), "y": float(y)} for x, y in pts]) for r, p, k, pts in shapes]
    return regions.edges(spark.createDataFrame(rows, "region string, polygon int, ring int, points array<struct<x: double, y: double>>"))


def in_ring(x, y, pts):
    out = False
    for (x1, y1), (x2, y2) in zip(pts, [*pts[1:], pts[0]], strict=True):
        if (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
            return None
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            out = not out
    return out


def test_cells_answer_as_all_edges_do(spark):
    """Wiggly rings with holes, parts on cell borders, points on vertices, edges and cell corners."""
    rng = random.Random(3)
    star = [((2 + rng.random()) * math.cos(a * math.pi / 60), (1.5 + rng.random()) * math.sin(a * math.pi / 60)) for a in range(120)]
    hole = [(0.5 * math.cos(a * math.pi / 9), 0.4 * math.sin(a * math.pi / 9)) for a in range(18)]
    square = [(3.0, -1.0), (5.0, -1.0), (5.0, 1.0), (3.0, 1.0)]
    edge = ring(spark, [("a", 1, 0, star), ("a", 1, 1, hole), ("a", 2, 0, square), ("b", 3, 0, [(x - 0.3, y + 0.1) for x, y in square])])
    points = [(rng.uniform(-3.5, 5.5), rng.uniform(-3, 3)) for _ in range(1500)] + star[:10] + hole[:5] + square + [(3.25, 0.0), (3.0, 0.25), (4.0, 1.0), (5.0, 1.0), (5.25, 1.0), (0.0, 0.0), (4.0, -1.0), (2.75, 0.25)]
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(points)] + [(9000, None, 1.0), (9001, float("nan"), 0.0)], "station_id int, longitude double, latitude double")
    got = {(r.station_id, r.region) for r in regions.members(df, edge).collect()}
    want = set()
    for k, (x, y) in enumerate(points):
        s, h = in_ring(x, y, star), in_ring(x, y, hole)
        if (s is None or h is None or s != h) or in_ring(x, y, square) in (True, None):
            want.add((k, "a"))
        if in_ring(x, y, [(a - 0.3, b + 0.1) for a, b in square]) in (True, None):
            want.add((k, "b"))
    assert got == want and len(got) > 300


def test_few_edges_meet_a_point(spark):
    """A polygon of 100,000 edges: points inside meet none, and on average a point meets fewer than 20."""
    n = 100_000
    points = [(10 + 8 * math.cos(2 * math.pi * k / n) * (1 + 0.01 * math.sin(40 * math.pi * k / n)), 8 * math.sin(2 * math.pi * k / n)) for k in range(n)]
    edge = ring(spark, [("a", 1, 0, points)]).cache()
    border, inside = regions.cell_cover(edge)
    spots = spark.range(4000).select("id", (F.rand(1) * 20).alias("x"), (F.rand(2) * 20 - 10).alias("y")).cache()
    cell = spots.withColumns({"row": F.floor(F.col("y") / regions.CELL), "col": F.floor(F.col("x") / regions.CELL)})
    open_ = cell.join(border, ["row", "col"]).withColumn("strip", F.floor(F.col("y") * regions.STRIPS / regions.CELL))
    met = open_.join(regions._rows_of(edge, regions.CELL / regions.STRIPS, "strip"), "strip").count()
    assert met / 4000 < 20 and inside.count() > 2500
    found = regions.members(spots.withColumnRenamed("id", "station_id"), edge, x_col="x", y_col="y").count()
    assert abs(found / 4000 - math.pi * 64 / 400) < 0.03
