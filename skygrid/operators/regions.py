"""Points in regions. A region is a table of edges; membership is decided by cells that cover it, and by edges near its border only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Side of a cell of a region's cover, in degrees, and strips of a cell: a point in a border cell meets the edges of its strip.
CELL, STRIPS = 0.25, 16


def edges(rings: DataFrame) -> DataFrame:
    """region, polygon, x1, y1, x2, y2 of rings(region, polygon, ring, points): points is an array of structs x, y, closed or not."""
    n = F.size("points")
    pairs = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get("points", i).alias("a"), F.get("points", (i + 1) % n).alias("b")))
    rows = rings.where(n > 0).select("region", "polygon", F.explode(pairs).alias("e"))
    out = rows.select("region", "polygon", *[F.col(f"e.{p}.{c}").cast("double").alias(f"{c}{k}") for k, p in ((1, "a"), (2, "b")) for c in ("x", "y")])
    return out.where("x1 <> x2 OR y1 <> y2")


def boxes(edge: DataFrame) -> DataFrame:
    """region, west, south, east, north."""
    return edge.groupBy("region").agg(F.min("x1").alias("west"), F.min("y1").alias("south"), F.max("x1").alias("east"), F.max("y1").alias("north"))


def in_box(x: Column, y: Column) -> Column:
    """Whether a point lies in the box of its row, ends included."""
    return x.between(F.col("west"), F.col("east")) & y.between(F.col("south"), F.col("north"))


def _rows_of(edge: DataFrame, height: float, name: str) -> DataFrame:
    """edge with a row for each horizontal strip of the plane that it touches."""
    return edge.withColumn(name, F.explode(F.sequence(F.floor(F.least("y1", "y2") / height), F.floor(F.greatest("y1", "y2") / height))))


def cell_cover(edge: DataFrame, size: float = CELL) -> tuple[DataFrame, DataFrame]:
    """Two tables of region, polygon, row, col: the cells (squares of the plane) that an edge may touch, and those wholly inside.

    Within a row an edge touches the columns between its ends in that row. The others are inside or outside as their centre is:
    along the row's middle, those between the first and second crossing, the third and fourth, and so on.
    """
    rows = _rows_of(edge, size, "row")
    level = F.col("y1") == F.col("y2")
    at = lambda y: F.when(level, F.col("x1")).otherwise(F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / F.when(level, 1.0).otherwise(F.col("y2") - F.col("y1")))
    low, high = F.greatest(F.col("row") * size, F.least("y1", "y2")), F.least((F.col("row") + 1) * size, F.greatest("y1", "y2"))
    ends = [F.when(level, x).otherwise(at(y)) for x, y in ((F.col("x1"), low), (F.col("x2"), high))]
    slack = size * 1e-9  # what rounding may move a crossing by
    cols = F.sequence(F.floor((F.least(*ends) - slack) / size), F.floor((F.greatest(*ends) + slack) / size))
    border = rows.select("region", "polygon", "row", F.explode(cols).alias("col")).distinct()
    middle = (F.col("row") + 0.5) * size
    crossed = rows.where((F.col("y1") > middle) != (F.col("y2") > middle)).groupBy("region", "polygon", "row").agg(F.sort_array(F.collect_list(at(middle))).alias("x"))
    pairs = F.transform(F.sequence(F.lit(0), F.size("x") - 2, F.lit(2)), lambda k: F.struct(F.ceil(F.get("x", k) / size - 0.5).alias("a"), F.floor(F.get("x", k + 1) / size - 0.5).alias("b")))
    runs = crossed.where(F.size("x") > 1).select("region", "polygon", "row", F.explode(pairs).alias("p")).where("p.a <= p.b")
    inside = runs.select("region", "polygon", "row", F.explode(F.sequence("p.a", "p.b")).alias("col")).join(border, ["region", "polygon", "row", "col"], "left_anti")
    return border, inside


def members(points: DataFrame, edge: DataFrame, id_col: str = "station_id", x_col: str = "longitude", y_col: str = "latitude", size: float = CELL) -> DataFrame:
    """id, region of the points in a region, its border included.

    A point is in a polygon if a ray to the east crosses its rings (holes too) an odd number of times,
    or if it lies on an edge; and in a region if it is in one of its polygons. Points in cells wholly inside meet no
    edge, and others only if their cell touches one: then those of a strip much lower than the cell.
    """
    border, inside = cell_cover(edge, size)
    spots = points.select(F.col(id_col).alias("_id"), F.col(x_col).cast("double").alias("px"), F.col(y_col).cast("double").alias("py")).where("px IS NOT NULL AND py IS NOT NULL AND NOT isnan(px) AND NOT isnan(py)")
    spots = spots.withColumns({"row": F.floor(F.col("py") / size), "col": F.floor(F.col("px") / size)})
    sure = spots.join(inside.select("region", "row", "col").distinct(), ["row", "col"]).select("_id", "region")
    open_ = spots.join(border, ["row", "col"]).withColumn("strip", F.floor(F.col("py") / (size / STRIPS)))
    met = open_.join(_rows_of(edge, size / STRIPS, "strip"), ["region", "polygon", "strip"])
    spans = (F.col("y1") > F.col("py")) != (F.col("y2") > F.col("py"))
    east = F.col("px") < (F.col("x2") - F.col("x1")) * (F.col("py") - F.col("y1")) / F.when(spans, F.col("y2") - F.col("y1")).otherwise(1.0) + F.col("x1")
    line = (F.col("x2") - F.col("x1")) * (F.col("py") - F.col("y1")) == (F.col("y2") - F.col("y1")) * (F.col("px") - F.col("x1"))
    on = line & F.col("px").between(F.least("x1", "x2"), F.greatest("x1", "x2")) & F.col("py").between(F.least("y1", "y2"), F.greatest("y1", "y2"))
    odd = (F.sum(F.when(spans & east, 1).otherwise(0)) % 2 == 1) | F.max(on)
    tested = met.groupBy("_id", "px", "py", "region", "polygon").agg(odd.alias("inside")).where("inside").select("_id", "region")
    return sure.unionByName(tested).distinct().select(F.col("_id").alias(id_col), "region")


def regional_stations(stations: DataFrame, edge: DataFrame, region: str) -> DataFrame:
    """The stations of one region, decided once a station and not once a record."""
    one = edge.where(F.col("region") == region)
    return stations.join(members(stations, one).select("station_id"), "station_id", "left_semi")


def regional_records(obs: DataFrame, stations: DataFrame) -> DataFrame:
    """Located records of regional stations, with the place of the station in place of the record's."""
    rows = obs.where("latitude IS NOT NULL AND longitude IS NOT NULL").drop("latitude", "longitude", "elevation")
    return rows.join(stations.select("station_id", "latitude", "longitude", "elevation"), "station_id")
