"""Tables that a build leaves behind, with their metadata."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skygrid.functions import times, values
from skygrid.operators import validity
from skygrid.sources import netcdf


def described(df: DataFrame, notes: Mapping[str, Mapping[str, object]]) -> DataFrame:
    """df with metadata on its columns; a unit is given its short form."""
    for c, note in notes.items():
        note = dict(note)
        if note.get("units") in values.UNITS:
            note["units"] = values.UNITS[note["units"]]
        df = df.withMetadata(c, note)
    return df


def hourly_notes(columns: Sequence[str], max_hours: float, units: Mapping[str, str | None] | None = None) -> dict[str, dict[str, object]]:
    """What is said of each interpolated column, with its unit where the files declare one."""
    say = f"Hourly values interpolated from reported times, over gaps of at most {round(max_hours, 2)} h"
    own = {c: {"units": u} for c, u in (units or {}).items() if u}
    return {c: {"max_interpolation_interval_h": max_hours, "processing": say, **own.get(c, {})} for c in columns}


def write_table(df: DataFrame, path: str, notes: Mapping[str, object] | None = None) -> None:
    """One table, and its notes as JSON beside it."""
    df.write.mode("overwrite").parquet(path)
    if notes is not None:
        df.sparkSession.createDataFrame([(json.dumps(notes),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}.notes")


def exported(df: DataFrame) -> DataFrame:
    """df with times as seconds since 1970."""
    return df.withColumn("time", times.to_epoch(F.col("time")))


def write_hourly(hourly: DataFrame, path: str, columns: Sequence[str], n_hours: int, thresholds: Sequence[float] = validity.THRESHOLDS) -> None:
    """The hourly table with valid_fraction, in partitions by how many of the thresholds a station reaches; fractions beside it.

    Series are interpolated once, and each row is kept once: ``hourly_at_least`` reads a threshold by a partition filter.
    """
    spark, staged = hourly.sparkSession, f"{path}.hourly.staged"
    write_table(hourly, staged)
    whole = spark.read.parquet(staged)
    write_table(validity.valid_fraction(whole, columns, n_hours), f"{path}.fractions")
    fractions = spark.read.parquet(f"{path}.fractions")
    reached = sum((F.when(F.col("valid_fraction") >= t, 1).otherwise(0) for t in sorted(thresholds)), F.lit(0))
    rows = whole.join(fractions, "station_id").withColumn("reached", reached)
    rows = rows.select(*[F.col(c).alias(c, metadata=hourly.schema[c].metadata) for c in hourly.columns], "valid_fraction", "reached")
    rows.repartition("reached", F.pmod(F.xxhash64("station_id"), F.lit(32))).write.mode("overwrite").partitionBy("reached").parquet(f"{path}.hourly")
    notes = {f"{t:.3f}": validity.processing_note(fractions, t, columns) for t in sorted(thresholds)}
    spark.createDataFrame([(json.dumps(notes),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}.hourly.notes")
    folder = spark._jvm.org.apache.hadoop.fs.Path(staged)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def hourly_at_least(spark: SparkSession, path: str, threshold: float = 0.0, thresholds: Sequence[float] = validity.THRESHOLDS) -> DataFrame:
    """The hourly rows of the stations that reach a threshold (one of thresholds, or 0 for all), by partitions."""
    if threshold and threshold not in thresholds:
        raise ValueError(f"{threshold} is none of {', '.join(map(str, thresholds))}")
    return spark.read.parquet(f"{path}.hourly").where(F.col("reached") >= sum(t <= threshold for t in thresholds)).drop("reached")


def write_cube(hourly: DataFrame, stations: DataFrame, path: str, start: datetime, end: datetime, notes: Mapping[str, Mapping[str, object]] | None = None, block: int = 256) -> None:
    """Hourly rows as NetCDF files of (time, station) arrays, so many stations in each; readable by sources.netcdf.

    stations: station_id, and what is said of each. Metadata of the columns (``described``) and notes become attributes.
    """
    netcdf.register(hourly.sparkSession)
    # One row a station is numbered; blocks then are ranges of identifiers.
    own = stations.join(hourly.select("station_id").distinct(), "station_id", "left_semi").dropDuplicates(["station_id"])
    numbered = own.withColumn("block", ((F.row_number().over(Window.orderBy("station_id")) - 1) / block).cast("int"))
    values = [c for c in hourly.columns if c not in ("station_id", "time", "valid_fraction", "reached")]
    said = {c: {k: v for k, v in hourly.schema[c].metadata.items() if isinstance(v, (str, float, int)) and not isinstance(v, bool)} for c in values}
    for c, note in (notes or {}).items():
        said[c] = {**said.get(c, {}), **note}
    rows = hourly.select("station_id", "time", *values).join(numbered, "station_id").repartition("block").sortWithinPartitions("block", "station_id", "time")
    ends = {k: str(int(x.replace(tzinfo=timezone.utc).timestamp())) for k, x in (("start", start), ("end", end))}
    about = [c for c in stations.columns if c != "station_id"]
    rows.select("block", "station_id", "time", *about, *values).write.format("netcdf3").mode("overwrite").options(**ends, station=json.dumps(about), notes=json.dumps(said), run=uuid.uuid4().hex).save(path)


def source_files(records: DataFrame) -> DataFrame:
    """source_file of all files that records came from, in order of name."""
    return records.select("source_file").distinct().orderBy("source_file")
