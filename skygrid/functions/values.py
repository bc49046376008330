"""Column expressions on observed values: missing markers, quality flags, ranges, wind, units."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Flags under which a value is kept (fixed values of the archive: screened, verified).
GOOD_FLAGS = ("S", "V")
#: Wind speeds that are believed, in m/s, ends included.
WIND_RANGE = (0.0, 50.0)
#: Unit names of the archive and their short forms (fixed values).
UNITS = {"kelvin": "K", "meter": "m", "watt/meter2": "W m-2", "meter/sec": "m s-1"}


def finite(value: Column) -> Column:
    """value, or null where it is NaN or infinite. Applied once, at ingest; null is the only missing marker after."""
    number = value.cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) < float("inf")), value)


def without_fills(value: Column, fills: Sequence[float]) -> Column:
    """value, or null where it is one of the declared fill values, NaN or infinite."""
    kept = finite(value)
    return F.when(~kept.isin(list(fills)), kept) if fills else kept


def flagged(value: Column, flag: Column, good: Sequence[str] = GOOD_FLAGS) -> Column:
    """value where its quality flag is good, else null. The row stays."""
    return F.when(flag.isin(list(good)), value)


def within(value: Column, low: float, high: float) -> Column:
    """value where it lies in the closed range, else null."""
    return F.when(value.between(low, high), value)


def masked(value: Column, keep: Column) -> Column:
    return F.when(keep, value)


def wind_u(speed: Column, direction: Column) -> Column:
    """Eastward component; direction is where the wind comes from, in degrees."""
    return (-speed.cast("double") * F.sin(F.radians(direction.cast("double")))).cast("float")


def wind_v(speed: Column, direction: Column) -> Column:
    """Northward component."""
    return (-speed.cast("double") * F.cos(F.radians(direction.cast("double")))).cast("float")


def wind_speed(u: Column, v: Column) -> Column:
    return F.hypot(u, v)


def unit_name(unit: Column) -> Column:
    """The short form of a unit; unknown ones as they are."""
    out = F.when(F.lit(False), unit)
    for name, short in UNITS.items():
        out = out.when(unit == name, short)
    return out.otherwise(unit)
