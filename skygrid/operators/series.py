"""Station series: one row for each station and time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygrid.functions import values
from skygrid.operators import stations

#: Columns that say what a row is, not what was observed.
META = {"station_id", "time", "seq", "latitude", "longitude", "elevation", "record_pos", "station_name", "ord"}


def value_columns(obs: DataFrame) -> list[str]:
    """The numeric columns that are observed values."""
    return [f.name for f in obs.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in META]


def consolidated(obs: DataFrame, columns: Sequence[str] | None = None, seq: str = "seq") -> DataFrame:
    """station_id, time and, for each column by itself, the first value that isn't missing, in record order."""
    columns = list(columns or value_columns(obs))
    clean = obs.where("time IS NOT NULL").select("station_id", "time", F.col(seq).alias("_seq"), *[values.finite(F.col(c)).alias(c) for c in columns])
    return clean.groupBy("station_id", "time").agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_seq"))).alias(c) for c in columns])


def of_requested(obs: DataFrame, station_ids: Sequence[str], columns: Sequence[str] | None = None, seq: str = "seq") -> DataFrame:
    """consolidated() of the named stations, with ord, their order of first mention. KeyError if one has no record."""
    wanted = stations.requested(obs.sparkSession, station_ids)
    own = stations.select_records(obs, wanted)
    stations.require_stations(wanted, own)
    return consolidated(own, columns, seq).join(wanted, "station_id")


def repeated_times(series: DataFrame) -> DataFrame:
    """Stations and times with more than one row; none after consolidation."""
    return series.groupBy("station_id", "time").agg(F.count("*").alias("n")).where("n > 1")
