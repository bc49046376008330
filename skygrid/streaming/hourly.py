"""Values at full hours of a stream of observations: the rules of operators.hourly, with state in place of a sort.

For each station and variable the state holds the observations that are newer than the watermark, and the last one that
isn't. When the watermark passes an observation, nothing earlier can come any more: it is joined with the one before
it, if they are at most the limit apart, and the hours from that one on are given. So hours come in order, each once, and rows
may come in any order within the delay; later ones are dropped, as by any watermark. The last observation
goes when the watermark has passed it by the limit.

Needs the RocksDB state store (``configured`` sets it).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from skygrid.functions import times, values
from skygrid.operators.hourly import _limit
from skygrid.operators.series import value_columns

OUTPUT = "station_id string, variable string, t long, value double"


def configured(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Interpolation(StatefulProcessor):
    def __init__(self, limit: int) -> None:
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "t long, seq string, v double")
        self.last = handle.getValueState("last", "t long, v double")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        found = [tuple(r) for part in rows for r in part[["t", "nth", "v"]].itertuples(index=False)]
        yield from self._settle(key, found, timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield from self._settle(key, [], timerValues.getCurrentWatermarkInMs() * 1000)

    def _settle(self, key: Any, new: list[tuple[int, str, float]], passed: int) -> Iterator[pd.DataFrame]:
        held = sorted([*self.held.get(), *new])
        before = self.last.get() if self.last.exists() else None
        hours, k = [], 0
        while k < len(held) and held[k][0] <= passed:
            t, _, v = held[k]
            if before is None or t > before[0]:  # of one time the first record counts
                if before is not None and t - before[0] <= self.limit:
                    hours += [(h, before[1] + (h - before[0]) * (v - before[1]) / (t - before[0])) for h in range(before[0] - before[0] % times.HOUR + times.HOUR, t, times.HOUR)]
                if t % times.HOUR == 0:
                    hours.append((t, v))
                before = (t, v)
            k += 1
        if k or new:
            if held[k:]:
                self.held.put(held[k:])
            else:
                self.held.clear()
        if before is not None and before[0] + self.limit <= passed and not held[k:]:
            self.last.clear()
        elif before is not None:
            self.last.update(before)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if held[k:]:
            self.handle.registerTimer(held[k][0] // 1000 + 1)
        elif before is not None and before[0] + self.limit > passed:
            self.handle.registerTimer((before[0] + self.limit) // 1000 + 1)
        if hours:
            yield pd.DataFrame({"station_id": key[0], "variable": key[1], "t": [h for h, _ in hours], "value": [v for _, v in hours]})


def _ordered(seq: str, kind: T.DataType) -> Column:
    """A string that sorts as seq does: an integer that isn't negative, a string, or a struct of these."""
    one = lambda c, k: F.lpad(c.cast("string"), 20, "0") if isinstance(k, T.IntegralType) else c.cast("string")
    if isinstance(kind, T.StructType):
        return F.concat_ws("\x01", *[one(F.col(f"`{seq}`.`{f.name}`"), f.dataType) for f in kind])
    return one(F.col(seq), kind)


def hourly_values(obs: DataFrame, columns: Sequence[str] | None = None, max_hours: float = 2, delay: str = "2 hours", seq: str = "seq") -> DataFrame:
    """station_id, variable, time, value of a stream of observations, an hour once it is settled (append mode).

    The batch result over the same rows (``operators.hourly.at_full_hours`` of ``series.consolidated``) has these values
    as columns, and those hours in addition that the watermark has not passed yet.
    """
    names = list(columns or value_columns(obs))
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), values.finite(F.col(c).cast("double")).alias("v")) for c in names]))
    rows = obs.where("time IS NOT NULL").withColumn("event", F.col("time").cast("timestamp")).withWatermark("event", delay)
    rows = rows.select("station_id", "event", times.micros(F.col("time")).alias("t"), _ordered(seq, obs.schema[seq].dataType).alias("nth"), cells.alias("c"))
    rows = rows.select("station_id", "event", "t", "nth", "c.variable", "c.v").where("v IS NOT NULL")
    found = rows.groupBy("station_id", "variable").transformWithStateInPandas(Interpolation(_limit(max_hours)), OUTPUT, "append", "EventTime")
    return found.select("station_id", "variable", times.from_micros(F.col("t")).alias("time"), "value")
