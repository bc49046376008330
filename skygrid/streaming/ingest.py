"""Incremental ingest as a stream of landed files: what a checkpoint has seen isn't read again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skygrid.operators import preprocess
from skygrid.plans.products import Product


def raw_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    """Landed Parquet files of raw records, with source_file."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return rows.withColumn("source_file", F.col("_metadata.file_name"))


def ingest(spark: SparkSession, path: str, schema: str, product: Product, out: str, checkpoint: str, fills: Mapping[str, Sequence[float]] | None = None) -> StreamingQuery:
    """Preprocess all files that are new since the last run, and stop; a failed run is taken up where it was."""
    obs = preprocess.observations(raw_stream(spark, path, schema), product, fills)
    rows = obs.withColumn("product", F.lit(product.name)).withColumn("date", F.to_date("time"))
    return rows.writeStream.format("parquet").partitionBy("product", "date").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_distinct(obs: DataFrame, delay: str = "2 hours") -> DataFrame:
    """A stream of observations without repeated (station, time), within a watermark."""
    timed = obs.withColumn("time", F.col("time").cast("timestamp")).withWatermark("time", delay)
    return timed.dropDuplicatesWithinWatermark(["station_id", "time"])


def hourly_counts(obs: DataFrame, delay: str = "2 hours") -> DataFrame:
    """station_id, hour, n, mean_temperature of a stream; an hour is given once the watermark has passed it."""
    timed = obs.withColumn("time", F.col("time").cast("timestamp")).withWatermark("time", delay)
    found = timed.groupBy("station_id", F.window("time", "1 hour")).agg(F.count("*").alias("n"), F.avg("temperature").alias("mean_temperature"))
    return found.select("station_id", F.col("window.start").alias("hour"), "n", "mean_temperature")
