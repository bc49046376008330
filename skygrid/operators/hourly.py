"""Values at full hours by linear interpolation over gaps of limited length.

At hour h, with p the last valid observation at or before h and n the next one after: p's value
if p is at h; else the line from p to n if they are at most the limit apart; else
nothing. Nothing is extrapolated. Not for accumulated quantities.

The plan: series are cut into chunks of time, each with the observations up to the
limit before and after it; within a chunk every observation finds the last valid one of each
variable up to itself and the first one after (last and lead, ignoring nulls), and gives the hours
until the observation that follows. So an hour comes from one row, with all variables, and nothing is
gathered by hour: a task holds what it sorts, and hours pass through. That is
one shuffle by (station, chunk); a station with very many observations is many
tasks, and work is in proportion to observations and output, not to hours times observations.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skygrid.functions import times
from skygrid.operators.series import value_columns

#: Length of a chunk; much longer than the usual limits.
CHUNK_HOURS = 24 * 32


def _limit(hours: float) -> int:
    if not 0 < hours < float("inf"):
        raise ValueError("the maximum interval must be finite and above 0")
    return round(hours * times.HOUR)


def _bounds(start: datetime | None, end: datetime | None) -> tuple[int | None, int | None]:
    if (start is None) != (end is None):
        raise ValueError("give both start and end, or neither")
    if start is None or end is None:
        return None, None
    if end < start:
        raise ValueError("end lies before start")
    epoch = datetime(1970, 1, 1)
    lo, hi = (int((x - epoch).total_seconds()) * times.SECOND for x in (start, end))
    return lo - lo % times.HOUR, hi - hi % times.HOUR


def at_full_hours(series: DataFrame, columns: Sequence[str] | None = None, max_hours: float = 2, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """station_id, time (full hours at which some column has a value), columns. With start and end: hours between their floors."""
    columns, limit = list(columns or value_columns(series)), _limit(max_hours)
    lo, hi = _bounds(start, end)
    rows = series.select("station_id", times.micros(F.col("time")).alias("t"), *columns)
    if lo is not None:
        # What lies further away than the limit can't matter; this reaches the scan.
        rows = series.where(F.col("time").between(*[times.from_micros(F.lit(x)) for x in (lo - limit, hi + limit)])).select("station_id", times.micros(F.col("time")).alias("t"), *columns)
    length = max(CHUNK_HOURS * times.HOUR, -(-4 * limit // times.HOUR) * times.HOUR)
    chunk = F.explode(F.sequence(F.floor((F.col("t") - limit) / length), F.floor((F.col("t") + limit) / length)))
    own = [F.when(F.col(c).isNotNull(), F.struct(F.col("t"), F.col(c).cast("double").alias("v"))).alias(f"_o{i}") for i, c in enumerate(columns)]
    rows = rows.select("station_id", "t", chunk.alias("chunk"), *own)
    order = "PARTITION BY station_id, chunk ORDER BY t"
    before = [F.expr(f"last(_o{i}) IGNORE NULLS OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)").alias(f"_p{i}") for i in range(len(columns))]
    after = [F.expr(f"lead(_o{i}) IGNORE NULLS OVER ({order})").alias(f"_n{i}") for i in range(len(columns))]
    rows = rows.select("station_id", "chunk", "t", F.expr(f"lead(t) OVER ({order})").alias("next"), *before, *after)
    first, last = F.col("chunk") * length, (F.col("chunk") + 1) * length - times.HOUR
    if lo is not None:
        first, last = F.greatest(first, F.lit(lo)), F.least(last, F.lit(hi))
    rows = rows.withColumn("h", F.explode(_hours(limit, first, last)))
    kinds = dict(series.dtypes)
    out = rows.select("station_id", times.from_micros(F.col("h")).alias("time"), *[_value(i, limit).cast("double" if kinds[c] == "double" else "float").alias(c) for i, c in enumerate(columns)])
    return out.where(F.coalesce(*[F.col(c).cast("double") for c in columns]).isNotNull())


def _hours(limit: int, first: Column, last: Column) -> Column:
    """Array of the hours from an observation to before the one that follows; its own alone, if that is too far away."""
    begin = F.greatest(times.hour_ceil(F.col("t")), first)
    stop = F.least(F.when(F.col("next") - F.col("t") <= limit, times.hour_floor(F.col("next") - 1)).otherwise(F.col("t")), last)
    return F.when(begin <= stop, F.sequence(begin, stop, F.lit(times.HOUR)))


def _value(i: int, limit: int) -> Column:
    """Value of column i at hour h, between its observations before and after."""
    h, p, n = F.col("h"), F.col(f"_p{i}"), F.col(f"_n{i}")
    line = p["v"] + (h - p["t"]) * (n["v"] - p["v"]) / (n["t"] - p["t"])
    return F.when(h == p["t"], p["v"]).when(n["t"] - p["t"] <= limit, line)


def grid_bounds(series: DataFrame) -> DataFrame:
    """first_hour (ceiling of the earliest observation), last_hour (floor of the latest); no row if reversed."""
    ends = series.where("time IS NOT NULL").agg(F.min("time").alias("a"), F.max("time").alias("b"))
    out = ends.select(times.from_micros(times.hour_ceil(times.micros(F.col("a")))).alias("first_hour"), times.from_micros(times.hour_floor(times.micros(F.col("b")))).alias("last_hour"))
    return out.where("first_hour <= last_hour")


def hour_grid(stations: DataFrame, bounds: DataFrame) -> DataFrame:
    """station_id, time: every station at every hour of the one row of bounds."""
    hours = F.sequence("first_hour", "last_hour", F.expr("INTERVAL 1 HOUR"))
    return stations.select("station_id").distinct().join(F.broadcast(bounds)).select("station_id", F.explode(hours).alias("time"))


def dense(hourly: DataFrame, grid: DataFrame) -> DataFrame:
    """hourly at all of grid, null where it has no row: asked for only when every hour must have a row."""
    return grid.join(hourly, ["station_id", "time"], "left")


def merged(*parts: DataFrame) -> DataFrame:
    """Hourly rows of several station sets; ValueError if their columns or types aren't the same."""
    out = parts[0]
    for k, part in enumerate(parts[1:], start=1):
        odd = set(out.dtypes) ^ set(part.dtypes)
        if odd:
            raise ValueError(f"part {k} differs in {', '.join(sorted(f'{c} ({kind})' for c, kind in odd))}")
        out = out.unionByName(part)
    return out


def _chunk(time: Column) -> Column:
    """Number of the chunk of time that a row is in."""
    return F.floor(times.micros(time) / (CHUNK_HOURS * times.HOUR))


def neighbours(grid: DataFrame, series: DataFrame, column: str) -> DataFrame:
    """grid with prev_time, prev_value (last valid at or before) and next_time, next_value (first valid after).

    One union and two windows in opposite orders over each chunk of a station; no window looks beyond the
    current row. What lies in other chunks comes from their first and last valid rows, of which there are few.
    """
    marks = series.where(F.col(column).isNotNull()).select("station_id", "time", F.struct("time", F.col(column).alias("v")).alias("o"))
    both = grid.select("station_id", "time", F.lit(None).cast(marks.schema["o"].dataType).alias("o")).unionByName(marks).withColumn("chunk", _chunk(F.col("time")))
    ahead = Window.partitionBy("station_id", "chunk").orderBy("time", F.col("o").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy("station_id", "chunk").orderBy(F.col("time").desc(), F.col("o").isNull().desc()).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("p", F.last("o", ignorenulls=True).over(ahead)).withColumn("n", F.last("o", ignorenulls=True).over(back)).where("o IS NULL")
    ends = both.groupBy("station_id", "chunk").agg(F.min("o").alias("first"), F.max("o").alias("last"))
    before = Window.partitionBy("station_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("station_id").orderBy(F.col("chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("station_id", "chunk", F.last("last", ignorenulls=True).over(before).alias("p0"), F.last("first", ignorenulls=True).over(after).alias("n0"))
    found = found.join(ends, ["station_id", "chunk"]).select("station_id", "time", F.coalesce("p", "p0").alias("p"), F.coalesce("n", "n0").alias("n"))
    return found.select("station_id", "time", F.col("p.time").alias("prev_time"), F.col("p.v").alias("prev_value"), F.col("n.time").alias("next_time"), F.col("n.v").alias("next_value"))


def consecutive(obs: DataFrame, seq: str = "seq") -> DataFrame:
    """station_id, time, next_time: each record and the station's next one; by chunks, as neighbours()."""
    rows = obs.where("time IS NOT NULL").select("station_id", "time", F.col(seq).alias("_seq")).withColumn("chunk", _chunk(F.col("time")))
    inside = rows.withColumn("next", F.lead("time").over(Window.partitionBy("station_id", "chunk").orderBy("time", "_seq")))
    begins = rows.groupBy("station_id", "chunk").agg(F.min("time").alias("first"))
    begins = begins.select("station_id", "chunk", F.lead("first").over(Window.partitionBy("station_id").orderBy("chunk")).alias("following"))
    return inside.join(begins, ["station_id", "chunk"]).select("station_id", "time", F.coalesce("next", "following").alias("next_time"))
