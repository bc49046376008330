import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skygrid.operators import hourly, series
from skygrid.streaming import hourly as stream

SCHEMA = "station_id string, time timestamp_ntz, seq struct<file: string, pos: int>, temperature double, dewpoint float"


def observations(rng, late):
    """Rows in order of their times, or each up to an hour late; ties, gaps, missing values, full hours."""
    began, rows = datetime(2024, 1, 1), []
    for s in "abc":
        minute = 0
        while minute < 60 * 30:
            minute += rng.choice([7, 20, 60, 60, 95, 180]) if rng.random() < 0.8 else 60 - minute % 60
            for _ in range(rng.choice([1, 1, 2])):
                rows.append([s, began + timedelta(minutes=minute), rng.choice([None, float("nan"), 270.0 + rng.random()]) if rng.random() < 0.4 else 270.0 + minute / 10, None if s == "c" else float(minute % 50)])
    rows.sort(key=lambda r: r[1] + timedelta(minutes=rng.randint(0, 55) * late))
    return [(r[0], r[1], (f"f{k // 40:03}", k), *r[2:]) for k, r in enumerate(rows)]


@pytest.mark.parametrize("late", [0, 1])
def test_stream_gives_the_batch_result(spark, tmp_path, late):
    """Files in order and out of order within the delay; the query is stopped after each file and goes on from its checkpoint."""
    stream.configured(spark)
    rows = observations(random.Random(late), late)
    end = (("z", datetime(2025, 1, 1), ("f999", 1), 1.0, 1.0),)
    files = [rows[: len(rows) // 3], rows[len(rows) // 3 : len(rows) // 2], rows[len(rows) // 2 :], end, (("z", datetime(2026, 1, 1), ("f999", 2), 1.0, 1.0),)]
    for k, part in enumerate(files):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        found = stream.hourly_values(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), max_hours=2, delay="2 hours")
        query = found.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination(200)
        assert query.exception() is None, k
    got = sorted((r.station_id, r.variable, r.time, round(r.value, 4)) for r in spark.read.parquet(str(tmp_path / "out")).where("station_id <> 'z'").collect())
    batch = hourly.at_full_hours(series.consolidated(spark.createDataFrame(rows, SCHEMA).withColumn("dewpoint", F.col("dewpoint").cast("double"))), ["temperature", "dewpoint"], 2)
    want = sorted((r.station_id, c, r.time, round(r[c], 4)) for r in batch.collect() for c in ("temperature", "dewpoint") if r[c] is not None)
    assert got == want and len(want) > 100
