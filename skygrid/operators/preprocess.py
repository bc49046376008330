"""From raw records to observations: projection, time filter, fill values, flags, wind."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrid.functions import text, times, values
from skygrid.plans.products import Product

#: Columns that say where a record came from; kept where present.
ORIGIN = ("source_file", "record_pos")


class MissingColumns(ValueError):
    """A raw table lacks columns of its product."""


def project(raw: DataFrame, product: Product) -> DataFrame:
    """The product's columns, each once, and the origin."""
    absent = [c for c in product.raw_columns if c not in raw.columns]
    if absent:
        raise MissingColumns(f"{product.name}: no column {', '.join(absent)}")
    return raw.select(*product.raw_columns, *[c for c in ORIGIN if c in raw.columns])


def observations(raw: DataFrame, product: Product, fills: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """time, station_id, latitude, longitude, elevation, observables, U10, V10 and the origin.

    One row for each raw record with a valid time; a value that fails its flag or
    range is null and its row stays. fills: declared fill values by column.
    """
    fills = fills or {}
    rows = project(raw, product).where(times.valid_epoch(F.col(product.time)))
    numbers = [c for c in (*product.plain, *product.flags) if c != product.station]
    clean = {c: values.without_fills(F.col(c).cast("float"), [float(x) for x in fills.get(c, ())]) for c in numbers}
    good = {c: values.flagged(clean[c], F.col(product.flags[c])) if c in product.flags else clean[c] for c in numbers}
    rows = rows.select(times.from_epoch(F.col(product.time)).alias("time"), text.decoded_id(F.col(product.station)).alias("station_id"), *[good[c].alias(product.renames.get(c, c)) for c in numbers], *[c for c in ORIGIN if c in raw.columns])
    believed = F.col("windSpeed").between(*values.WIND_RANGE)
    speed, direction = F.when(believed, F.col("windSpeed")), F.when(believed, F.col("windDir"))
    wind = {"U10": values.wind_u(speed, direction), "V10": values.wind_v(speed, direction)}
    place = ("latitude", "longitude", "elevation")
    return rows.select("time", "station_id", *place, *[c for c in product.observables if c not in wind], *[x.alias(c) for c, x in wind.items()], *[c for c in ORIGIN if c in raw.columns])


def files_without_records(raw: DataFrame, product: Product) -> DataFrame:
    """source_file of files in which no record has a valid time."""
    good = F.max(times.valid_epoch(F.col(product.time)).cast("int"))
    return raw.groupBy("source_file").agg(good.alias("good")).where("good = 0").select("source_file")
