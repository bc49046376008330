from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrid.operators import sinks
from skygrid.sources import netcdf, store

START, END = datetime(2024, 1, 1), datetime(2024, 1, 3, 23)


def hourly(spark, n=23):
    rng = np.random.default_rng(4)
    rows = [(f"s{k:02}é" if k % 5 == 0 else f"s{k:02}", START + timedelta(hours=int(h)), *(None if x < -1.5 else float(np.float32(x)) for x in rng.normal(size=2))) for k in range(n) for h in np.sort(rng.choice(72, 30, replace=False))]
    return rows, spark.createDataFrame(rows, "station_id string, time timestamp_ntz, temperature float, U10 float").repartition(7)


def test_cube_reads_back(spark, tmp_path):
    """Many stations as many files; what is read back is what was written, with units, fills and places."""
    rows, df = hourly(spark)
    places = df.select("station_id").distinct().select("station_id", (F.length("station_id") * 1.5).alias("latitude"), F.when(F.col("station_id") != "s01", 7.0).alias("elevation"), F.concat(F.lit("name of "), "station_id").alias("station_name"))
    path = f"file://{tmp_path}/cube"
    sinks.write_cube(sinks.described(df, {"temperature": {"units": "kelvin"}}), places, path, START, END, {"": {"title": "a test"}}, block=5)
    assert sorted(p.name for p in (tmp_path / "cube").iterdir() if p.suffix == ".nc") == [f"part-{k:06}.nc" for k in range(5)] and not list((tmp_path / "cube").glob("_aside*"))
    read = netcdf.read(spark, path, "time double, temperature array<float>, U10 array<float>").collect()
    names = netcdf.read(spark, path, "station_id string, latitude double, elevation double, station_name string").collect()
    stations = {}
    for r in sorted(names, key=lambda r: r.record_pos):
        stations.setdefault(r.source_file, []).append(r.station_id)
    assert len(read) == 5 * 72 and [len(stations[f]) for f in sorted(stations)] == [5, 5, 5, 5, 3]
    got = {(s, START + timedelta(seconds=r.time - 1704067200)): (t, u) for r in read for s, t, u in zip(stations[r.source_file], r.temperature, r.U10, strict=True) if t is not None or u is not None}
    assert got == {(s, at): (t, u) for s, at, t, u in rows if t is not None or u is not None}
    assert {r.station_id: (r.latitude, r.elevation, r.station_name) for r in names} == {s: (1.5 * len(s), None if s == "s01" else 7.0, f"name of {s}") for s, *_ in rows}
    said = netcdf.header_catalogue(store.listing(spark, path)).collect()
    assert all(next(v for v in r.variables if v.name == "temperature").units == "K" and r.error is None for r in said)
    netcdf.require_one_form(netcdf.header_catalogue(store.listing(spark, path)))
    sinks.write_cube(df.where("station_id = 's03'"), places, path, START, END)
    assert [p.name for p in (tmp_path / "cube").iterdir() if p.suffix == ".nc"] == ["part-000000.nc"]


def test_a_failing_task_leaves_no_file(spark, tmp_path):
    _, df = hourly(spark)
    bad = df.withColumn("temperature", F.when(F.col("station_id") == "s22", F.raise_error("broken").cast("float")).otherwise(F.col("temperature")))
    places = df.select("station_id").distinct()
    with pytest.raises(Exception, match="broken"):
        sinks.write_cube(bad, places, f"file://{tmp_path}/cube", START, END, block=4)
    assert not [p for p in (tmp_path / "cube").rglob("*") if p.is_file()]


def test_thresholds_are_partitions(spark, tmp_path):
    rows = [(f"s{k}", START + timedelta(hours=h), 1.0) for k, n in enumerate((10, 36, 48, 55, 60, 72)) for h in range(n)]
    df = spark.createDataFrame(rows, "station_id string, time timestamp_ntz, temperature double")
    sinks.write_hourly(sinks.described(df, {"temperature": {"units": "kelvin"}}), f"{tmp_path}/x", ["temperature"], 72)
    for t, n in ((0.0, 6), (0.5, 5), (0.666, 4), (0.75, 3), (0.8, 2), (0.9, 1)):
        found = sinks.hourly_at_least(spark, f"{tmp_path}/x", t)
        assert found.select("station_id").distinct().count() == n
        assert not t or "reached" in found._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("PushedFilters")[0]
    assert found.schema["temperature"].metadata["units"] == "K" and sinks.hourly_at_least(spark, f"{tmp_path}/x").count() == len(rows)
    assert not (tmp_path / "x.hourly.staged").exists()
    with pytest.raises(ValueError):
        sinks.hourly_at_least(spark, f"{tmp_path}/x", 0.7)
