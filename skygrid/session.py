"""A session with the settings that the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def session(app: str = "skygrid", **conf: str) -> SparkSession:
    """UTC throughout, adaptive execution with skew handling; conf: further settings."""
    builder = SparkSession.builder.appName(app)
    fixed = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    return builder.config(map=fixed | conf).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a local one where that is unset and the master is local."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"file://{tempfile.gettempdir()}/skygrid-shared"
