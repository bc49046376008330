"""The whole build: records of a region or a station to hourly series, filtered by validity."""

from __future__ import annotations

from datetime import datetime, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrid.operators import hourly, regions, series, stations, validity
from skygrid.plans.regions import classify, shape_filter

#: Hours before and after the interval whose records are read as well.
HALO = timedelta(days=1)
WARNING = "The reported place of this station changes by more than the tolerances; its mean place is given."


class Built(NamedTuple):
    """counted and n_hours: what validity goes by."""

    records: DataFrame
    stations: DataFrame
    hourly: DataFrame
    counted: list[str]
    n_hours: int

    def fractions(self, hourly: DataFrame | None = None) -> DataFrame:
        """valid_fraction of the hourly rows, or of the table they were written to."""
        return validity.valid_fraction(self.hourly if hourly is None else hourly, self.counted, self.n_hours)


def interval(start: datetime, end: datetime) -> tuple[datetime, datetime]:
    """From 00:00 of the first day to 23:00 of the last."""
    a, b = start.replace(hour=0, minute=0, second=0, microsecond=0), end.replace(hour=23, minute=0, second=0, microsecond=0)
    if b < a:
        raise ValueError("the end lies before the start")
    return a, b


def build(obs: DataFrame, identifier: str, start: datetime, end: datetime, rings: DataFrame | None = None, names: DataFrame | None = None, max_hours: float = 2, tolerance: stations.Tolerance = stations.Tolerance()) -> Built:
    """obs: observations with seq; if they come from a table by date, only the days of the interval and its halo are read.
    rings: shapes with the columns that shape_filter names, for a region.

    Stations that moved are left out of a region, and kept under their mean place if asked for by
    name. No stations give empty tables, and no error.
    """
    a, b = interval(start, end)
    obs = obs.where(F.col("time").between(F.lit((a - HALO).isoformat(sep=" ")).cast("timestamp_ntz"), F.lit((b + HALO).isoformat(sep=" ")).cast("timestamp_ntz")))
    if "date" in obs.columns:
        obs = obs.where(F.col("date").between(F.lit((a - HALO).date()), F.lit((b + HALO).date()))).drop("date")
    place = classify(identifier)
    if place.kind == "station":
        obs = obs.where(F.col("station_id") == identifier)
        found = stations.station_table(obs, identifier, tolerance)
    else:
        if rings is None:
            raise ValueError(f"{identifier} is a region: shapes are needed")
        edge = regions.edges(rings.where(shape_filter(place)).withColumn("region", F.lit(identifier)))
        stable = stations.stable_stations(stations.station_locations(obs, tolerance))
        found = regions.regional_stations(stable, edge, identifier).withColumn("coordinate_warning", F.lit(False))
    records = regions.regional_records(obs, found)
    values = series.value_columns(records)
    whole = hourly.at_full_hours(series.consolidated(records, values), values, max_hours, a, b)
    counted = [c for c in validity.VARIABLES if c in values]
    n_hours = int((b - a).total_seconds() // 3600) + 1
    named = stations.with_names(found, names) if names is not None else found.withColumn("station_name", F.col("station_id"))
    return Built(records, named, whole, counted, n_hours)
