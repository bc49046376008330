"""Stations: where they are, whether they moved, and which of their records are wanted."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skygrid.functions.projections import Lambert

#: Distances up to which two reported places are one (degrees, degrees, metres; ends included).
LATITUDE_STEP, LONGITUDE_STEP, ELEVATION_STEP = 0.01, 0.01, 25.0


@dataclass(frozen=True)
class Tolerance:
    latitude: float = LATITUDE_STEP
    longitude: float = LONGITUDE_STEP
    elevation: float = ELEVATION_STEP

    def __post_init__(self) -> None:
        if not all(0 <= x < float("inf") for x in (self.latitude, self.longitude, self.elevation)):
            raise ValueError("tolerances must be finite and not negative")


def located(obs: DataFrame) -> DataFrame:
    """Records with a station and finite coordinates; the elevation may be missing."""
    return obs.where("station_id <> '' AND latitude IS NOT NULL AND longitude IS NOT NULL")


def _level(a: Column, b: Column, step: float) -> Column:
    return F.abs(a.cast("double") - b.cast("double")) <= step


def first_records(obs: DataFrame, seq: str = "seq") -> DataFrame:
    """station_id, base_lat, base_lon, base_elev of each station's first located record."""
    first = F.min_by(F.struct("latitude", "longitude", "elevation"), F.col(seq)).alias("base")
    return located(obs).groupBy("station_id").agg(first).select("station_id", F.col("base.latitude").alias("base_lat"), F.col("base.longitude").alias("base_lon"), F.col("base.elevation").alias("base_elev"))


def station_locations(obs: DataFrame, tolerance: Tolerance = Tolerance(), seq: str = "seq") -> DataFrame:
    """station_id, base_lat, base_lon, base_elev, changed.

    The base is the first record's place; if that lacks an elevation, the first one reported at
    that place. A station has changed if any record is off its base. Records are reduced to distinct points
    in one pass, combined before the shuffle; all else works on these.
    """
    # Distinct points, with the first record at each, say all there is to know; their exchange is reused below.
    rows = located(obs).groupBy("station_id", "latitude", "longitude", "elevation").agg(F.min(seq).alias(seq))
    base = first_records(rows, seq)
    joined = rows.join(base, "station_id")
    level = _level(F.col("latitude"), F.col("base_lat"), tolerance.latitude) & _level(F.col("longitude"), F.col("base_lon"), tolerance.longitude)
    filled = joined.groupBy("station_id").agg(F.min_by("elevation", F.when(level & F.col("elevation").isNotNull(), F.col(seq))).alias("fill"))
    base = base.join(filled, "station_id").select("station_id", "base_lat", "base_lon", F.coalesce("base_elev", "fill").alias("base_elev"))
    upright = F.coalesce(_level(F.col("elevation"), F.col("base_elev"), tolerance.elevation), F.lit(True))
    off = rows.join(base, "station_id").groupBy("station_id").agg(F.max(~(level & upright)).alias("changed"))
    return base.join(off, "station_id")


def stable_stations(locations: DataFrame) -> DataFrame:
    """station_id, latitude, longitude, elevation of stations that didn't change."""
    return locations.where("NOT changed").select("station_id", F.col("base_lat").alias("latitude"), F.col("base_lon").alias("longitude"), F.col("base_elev").alias("elevation"))


def mean_places(obs: DataFrame) -> DataFrame:
    """station_id, latitude, longitude, elevation: means over each station's distinct places."""
    places = located(obs).select("station_id", "latitude", "longitude", "elevation").distinct()
    return places.groupBy("station_id").agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in ("latitude", "longitude", "elevation")])


def _anchored(latitude: np.ndarray, longitude: np.ndarray, elevation: np.ndarray, tolerance: Tolerance) -> tuple[np.ndarray, list[tuple[float, float, float]]]:
    """For points in order of encounter the number of their place, and all places; elevation NaN: unknown.

    Points are kept in cells that are wider than the tolerances, so a new place looks at its own cell and those around it.
    """
    width = [2 * x or 1.0 for x in (tolerance.latitude, tolerance.longitude)]
    cell = np.stack([np.floor(latitude / width[0]), np.floor(longitude / width[1])], axis=1).astype(np.int64)
    order = np.lexsort((cell[:, 1], cell[:, 0]))  # stable, so a cell's points stay in order
    cuts = np.flatnonzero((np.diff(cell[order], axis=0) != 0).any(axis=1)) + 1
    open_ = {tuple(cell[own[0]]): own for own in np.split(order, cuts) if len(own)}
    place, places = np.full(len(latitude), -1), []
    for k in range(len(latitude)):
        if place[k] >= 0:
            continue
        i, j = cell[k]
        around = [c for c in ((i + di, j + dj) for di in (-1, 0, 1) for dj in (-1, 0, 1)) if c in open_]
        own = np.sort(np.concatenate([open_[c] for c in around]))
        own = own[(np.abs(latitude[own] - latitude[k]) <= tolerance.latitude) & (np.abs(longitude[own] - longitude[k]) <= tolerance.longitude)]
        known = elevation[own][~np.isnan(elevation[own])]
        level = known[0] if len(known) else np.nan
        place[own[~(np.abs(elevation[own] - level) > tolerance.elevation)]] = len(places)
        places.append((latitude[k], longitude[k], level))
        for c in around:
            left = open_[c][place[open_[c]] < 0]
            if len(left):
                open_[c] = left
            else:
                del open_[c]
    return place, places


def placed(obs: DataFrame, tolerance: Tolerance = Tolerance(), seq: str = "seq") -> DataFrame:
    """station_id, latitude, longitude, elevation (as reported, distinct), place (from 0, by first encounter), place_latitude, place_longitude, place_elevation of stations that changed.

    A place is anchored at the first record that is at no earlier place; its elevation is the first
    one reported there, and records belong to it that are within the tolerances of both. The order matters, so
    a station's distinct points, not its records, pass through one group, each looking at the points around it only.
    """
    moved = station_locations(obs, tolerance, seq).where("changed").select("station_id")
    distinct = located(obs).join(moved, "station_id", "left_semi").groupBy("station_id", "latitude", "longitude", "elevation").agg(F.min(seq).alias("first"))
    ordered = distinct.withColumn("nth", F.row_number().over(Window.partitionBy("station_id").orderBy("first"))).drop("first")

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("nth")
        points = [table.column(c).cast(pa.float64()).to_numpy() for c in ("latitude", "longitude", "elevation")]
        place, places = _anchored(*points, tolerance)
        at = pa.array(place, pa.int32())
        anchors = np.array(places)[place]
        table = table.drop_columns("nth").append_column("place", at)
        for k, c in enumerate(("latitude", "longitude", "elevation")):
            table = table.append_column(f"place_{c}", pa.array(anchors[:, k], pa.float64(), from_pandas=True))
        return table

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema if f.name != "nth")
    return ordered.groupBy("station_id").applyInArrow(work, f"{fields}, place int, place_latitude double, place_longitude double, place_elevation double")


def changed_places(obs: DataFrame, tolerance: Tolerance = Tolerance(), seq: str = "seq") -> DataFrame:
    """station_id, place (from 0, by first encounter), latitude, longitude, elevation: all places of stations that changed."""
    places = placed(obs, tolerance, seq).select("station_id", "place", *[F.col(f"place_{c}").alias(c) for c in ("latitude", "longitude", "elevation")])
    return places.groupBy("station_id", "place").agg(*[F.first(c).alias(c) for c in ("latitude", "longitude", "elevation")])


def record_places(obs: DataFrame, tolerance: Tolerance = Tolerance(), seq: str = "seq") -> DataFrame:
    """Located records of stations that changed, with place, place_latitude, place_longitude and place_elevation."""
    points = placed(obs, tolerance, seq)
    rows = located(obs)
    same = [rows[c].eqNullSafe(points[c]) for c in ("station_id", "latitude", "longitude", "elevation")]
    return rows.join(points, same).select(*[rows[c] for c in rows.columns], *[points[c] for c in ("place", "place_latitude", "place_longitude", "place_elevation")])


def station_table(obs: DataFrame, station_id: str, tolerance: Tolerance = Tolerance(), seq: str = "seq") -> DataFrame:
    """The table of one requested station: its base, or if it changed its mean place with coordinate_warning."""
    own = obs.where(F.col("station_id") == station_id)
    joined = station_locations(own, tolerance, seq).join(mean_places(own), "station_id")
    pick = {"longitude": "base_lon", "latitude": "base_lat", "elevation": "base_elev"}
    return joined.select("station_id", *[F.when(F.col("changed"), F.col(c)).otherwise(F.col(b).cast("double")).alias(c) for c, b in pick.items()], F.col("changed").alias("coordinate_warning"))


#: The map's corners (fixed values): west, east, south, north.
MAP_EXTENT = (-123.0, -71.0, 25.0, 50.0)


def on_map(stations: DataFrame, extent: tuple[float, float, float, float] = MAP_EXTENT, projection: Lambert = Lambert()) -> DataFrame:
    """stations within the map's extent, with x and y in metres of its projection, to be drawn."""
    west, east, south, north = extent
    rows = stations.where(F.col("longitude").between(west, east) & F.col("latitude").between(south, north))
    x, y = projection.forward(F.col("longitude").cast("double"), F.col("latitude").cast("double"))
    return rows.withColumns({"x": x, "y": y})


def requested(spark, station_ids: Sequence[str]) -> DataFrame:
    """station_id, ord: each requested station once, in order of first mention."""
    names = list(dict.fromkeys(station_ids))
    return spark.createDataFrame(list(zip(names, range(len(names)), strict=True)), "station_id string, ord int")


def select_records(obs: DataFrame, stations: DataFrame) -> DataFrame:
    """Records of the stations in a table. Catalyst broadcasts it if it is small."""
    return obs.join(stations.select("station_id"), "station_id", "left_semi")


def missing_stations(stations: DataFrame, obs: DataFrame) -> DataFrame:
    """Stations of a table that have no record."""
    return stations.join(obs.select("station_id"), "station_id", "left_anti")


def require_stations(stations: DataFrame, obs: DataFrame) -> None:
    """Raise KeyError if a requested station has no record."""
    absent = [r[0] for r in missing_stations(stations, obs).select("station_id").limit(10).collect()]
    if absent:
        raise KeyError("no records of " + ", ".join(absent))


def with_names(stations: DataFrame, names: DataFrame) -> DataFrame:
    """stations with station_name: the first of the name table (by ord, or as it is read), or the identifier itself."""
    rows = names if "ord" in names.columns else names.withColumn("ord", F.monotonically_increasing_id())
    first = rows.groupBy("station_id").agg(F.min_by("name", "ord").alias("name"))
    return stations.join(first, "station_id", "left").withColumn("station_name", F.coalesce("name", "station_id")).drop("name")
