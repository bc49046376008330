"""Name tables, shapes and Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.functions import text


def first_named(rows: DataFrame) -> DataFrame:
    """station_id, name: the first usable line of each station."""
    rows = rows.where("station_id <> '' AND name <> ''")
    return rows.groupBy("station_id").agg(F.min_by("name", "line").alias("name"))


def _numbered(rows: DataFrame) -> DataFrame:
    """rows of files with line, which sorts as the lines of each file do, however the files are split and read."""
    return rows.withColumn("line", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("nth")))


def csv_names(spark: SparkSession, path: str) -> DataFrame:
    """station_id, name of a CSV without a header: column 0 is the id, column 7 the place."""
    rows = _numbered(spark.read.option("header", False).csv(path))
    return first_named(rows.select("line", text.stripped(F.coalesce("_c0", F.lit(""))).alias("station_id"), text.clean_place_name(F.coalesce("_c7", F.lit(""))).alias("name")))


def wide_names(spark: SparkSession, path: str) -> DataFrame:
    """station_id, name of fixed-width lines: name in columns 3 to 18, id in 20 to 23, counted from 0."""
    rows = _numbered(spark.read.text(path))
    rows = rows.select("line", text.stripped(F.substring("value", 21, 4)).alias("station_id"), text.clean_wide_name(F.substring("value", 4, 16)).alias("name"))
    return first_named(rows.where(F.col("station_id").rlike(text.FOUR_SIGNS)))


def geojson_rings(spark: SparkSession, path: str, region: str, condition: str | None = None, properties: Sequence[str] = ("STUSPS", "RTO_ISO", "LOC_TYPE")) -> DataFrame:
    """region, polygon, ring, points of a GeoJSON feature collection in degrees.

    region: SQL over the named properties that gives the region; condition: SQL that selects features.
    """
    # Depth of the coordinates differs by type, so they are read as text.
    schema = "features array<struct<properties: map<string, string>, geometry: struct<type: string, coordinates: string>>>"
    rows = spark.read.option("multiLine", True).schema(schema).json(path).select(F.posexplode("features").alias("feature", "f"))
    rows = rows.select("feature", *[F.col("f.properties")[p].alias(p) for p in properties], F.col("f.geometry.type").alias("_type"), F.col("f.geometry.coordinates").alias("_xy"))
    rows = rows.where(condition) if condition else rows
    one = F.array(F.from_json("_xy", "array<array<array<double>>>"))
    many = F.from_json("_xy", "array<array<array<array<double>>>>")
    shapes = rows.select(F.expr(region).cast("string").alias("region"), "feature", F.posexplode(F.when(F.col("_type") == "Polygon", one).otherwise(many)).alias("part", "rings"))
    rings = shapes.select("region", (F.col("feature") * 100_000 + F.col("part")).alias("polygon"), F.posexplode("rings").alias("ring", "xy"))
    return rings.select("region", "polygon", "ring", F.transform("xy", lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))).alias("points"))


def with_sequence(obs: DataFrame) -> DataFrame:
    """obs with seq, the order of files by name and of records in a file, as a comparable struct."""
    return obs.withColumn("seq", F.struct("source_file", "record_pos"))
