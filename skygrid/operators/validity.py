"""How often several variables are valid at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Shares at which hourly series are offered (fixed values), and the variables that count.
THRESHOLDS = (0.5, 0.666, 0.75, 0.8, 0.9)
VARIABLES = ("temperature", "dewpoint", "U10", "V10")


def valid_fraction(hourly: DataFrame, columns: Sequence[str], n_hours: Column | int) -> DataFrame:
    """station_id, valid_fraction: hours at which all columns have a value, of all hours of the grid.

    Hours without a row count as not valid, so no dense grid is needed.
    """
    together = F.lit(True)
    for c in columns:
        together &= F.col(c).isNotNull()
    counted = hourly.groupBy("station_id").agg(F.count(F.when(together, 1)).alias("n"))
    hours = F.lit(n_hours) if isinstance(n_hours, int) else n_hours
    return counted.select("station_id", (F.col("n") / hours).alias("valid_fraction"))


def at_least(hourly: DataFrame, fractions: DataFrame, threshold: float) -> DataFrame:
    """Rows of the stations whose fraction is at least threshold."""
    return hourly.join(fractions.where(F.col("valid_fraction") >= threshold).select("station_id"), "station_id", "left_semi")


def at_least_of(hourly: DataFrame, columns: Sequence[str], n_hours: int, threshold: float) -> DataFrame:
    """at_least() of one threshold, with the fractions counted beside the rows: hourly is worked out once."""
    together = F.lit(True)
    for c in columns:
        together &= F.col(c).isNotNull()
    counted = hourly.withColumn("_n", F.count(F.when(together, 1)).over(Window.partitionBy("station_id")))
    return counted.where(F.col("_n") / n_hours >= threshold).drop("_n")


def processing_note(fractions: DataFrame, threshold: float, columns: Sequence[str]) -> str:
    """How many stations a threshold leaves, in words."""
    kept, every = fractions.agg(F.count(F.when(F.col("valid_fraction") >= threshold, 1)), F.count("*")).first()
    return f"Of {every} stations, {kept} have values of {', '.join(columns)} at the same time at {100 * threshold:g} % of the hours or more."
