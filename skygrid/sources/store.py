"""Files of a store that tasks open themselves, by Arrow's file systems (local, HDFS and object stores)."""

from __future__ import annotations

import re

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Endings of files that landing leaves beside the data, or that aren't finished.
ASIDE = r"\.(etag|part)$"


def at(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI as Spark gives it, or of a local path."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def listing(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, bytes, changed (time) of a folder's files; listed by Spark, nothing is read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("changed")).where(~F.col("file").rlike(ASIDE))
