"""Column expressions on times. All are timestamps without zone and mean UTC; arithmetic is in whole microseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000
HOUR = 3600 * SECOND
#: Epoch seconds of the year 3000; later times are taken for errors.
LATEST = 32_503_680_000


def valid_epoch(seconds: Column) -> Column:
    """Whether epoch seconds lie from 1970 to before 3000; not for null or NaN."""
    return F.coalesce((seconds >= 0) & (seconds < LATEST), F.lit(False))


def micros(time: Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), time)


def from_micros(value: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", value, epoch)


def from_epoch(seconds: Column) -> Column:
    return from_micros(F.round(seconds.cast("double") * SECOND).cast("long"))


def to_epoch(time: Column) -> Column:
    """Epoch seconds as a double, the exported form."""
    return micros(time) / SECOND


def hour_floor(value: Column) -> Column:
    """Microseconds down to the full hour."""
    return value - F.pmod(value, F.lit(HOUR))


def hour_ceil(value: Column) -> Column:
    return hour_floor(value + (HOUR - 1))


def to_utc(local: Column, zone: str) -> Column:
    """A time without zone, read in zone, in UTC."""
    return F.to_utc_timestamp(local.cast("timestamp"), zone).cast("timestamp_ntz")
