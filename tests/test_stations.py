import random
import time

import numpy as np
import pytest

from skygrid import catalogue
from skygrid.operators import regions, series, stations

SCHEMA = "station_id string, seq long, latitude float, longitude float, elevation float"


def located(spark, rows):
    return {r.station_id: r for r in stations.station_locations(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_drift(spark):
    rows = [
        ("still", 1, 40.0, -105.0, 100.0), ("still", 2, 40.0078125, -105.0, None),
        ("moved", 1, 40.0, -105.0, 100.0), ("moved", 2, 40.02, -105.0, 100.0),
        ("level", 1, 40.0, -105.0, 100.0), ("level", 2, 40.0, -105.0, None), ("level", 3, 40.0, -105.0, 125.0),
        ("climbed", 1, 40.0, -105.0, 100.0), ("climbed", 2, 40.0, -105.0, 125.5),
        ("filled", 1, 40.0, -105.0, None), ("filled", 2, 40.0, -105.0, 100.0), ("filled", 3, 40.0, -105.0, 130.0),
    ]
    got = located(spark, rows)
    assert {k: r.changed for k, r in got.items()} == {"still": False, "moved": True, "level": False, "climbed": True, "filled": True}
    assert got["filled"].base_elev == 100.0


def test_drift_against_a_sequential_model(spark):
    rng = random.Random(5)
    rows = [(f"s{s}", k, rng.choice([40.0, 40.0078125, 40.02, None]), rng.choice([-105.0, -105.0, -104.98]), rng.choice([None, 100.0, 120.0, 130.0])) for s in range(300) for k in range(rng.randint(1, 6))]
    want = {}
    for s in range(300):
        own = [r for r in rows if r[0] == f"s{s}" and r[2] is not None]
        if own:
            lat, lon, elev = own[0][2:]
            level = [r for r in own if abs(r[2] - lat) <= 0.01 and abs(r[3] - lon) <= 0.01]
            if elev is None:
                elev = next((r[4] for r in level if r[4] is not None), None)
            want[f"s{s}"] = any(r not in level or (elev is not None and r[4] is not None and abs(r[4] - elev) > 25) for r in own)
    assert {k: r.changed for k, r in located(spark, rows).items()} == want


def test_mean_of_distinct_places(spark):
    rows = [("a", k, 40.0, -105.0, 100.0) for k in range(3)] + [("a", 4, 41.0, -105.0, None)]
    got = stations.mean_places(spark.createDataFrame(rows, SCHEMA)).first()
    assert (got.latitude, got.longitude, got.elevation) == (40.5, -105.0, 100.0)


def test_tolerances_are_checked():
    with pytest.raises(ValueError):
        stations.Tolerance(latitude=-1)


def test_missing_station(spark):
    obs = spark.createDataFrame([("a", 1, 1.0, 1.0, 1.0)], SCHEMA)
    with pytest.raises(KeyError):
        stations.require_stations(stations.requested(spark, ["a", "b"]), obs)


def test_polygon(spark):
    ring = lambda pts: [{"x": float(x), "y": float(y)} for x, y in pts]
    rings = spark.createDataFrame(
        [("r", 1, 0, ring([(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)])), ("r", 1, 1, ring([(1, 1), (2, 1), (2, 2), (1, 2)])), ("r", 2, 0, ring([(10, 10), (11, 10), (10, 11)]))],
        "region string, polygon int, ring int, points array<struct<x: double, y: double>>",
    )
    points = {"inside": (3.0, 3.0), "outside": (5.0, 5.0), "edge": (4.0, 2.0), "vertex": (0.0, 0.0), "hole": (1.5, 1.5), "other": (10.2, 10.2), "none": (None, 1.0)}
    rows = spark.createDataFrame([(k, x, y) for k, (x, y) in points.items()], "station_id string, longitude double, latitude double")
    got = {r.station_id for r in regions.members(rows, regions.edges(rings)).collect()}
    assert got == {"inside", "edge", "vertex", "other"}


def test_first_value_of_each_column(spark):
    rows = [("a", "2024-01-01 00:00:00", 1, None, 1.0), ("a", "2024-01-01 00:00:00", 2, 5.0, 2.0), ("a", "2024-01-01 00:00:00", 3, 7.0, None), ("a", "2024-01-01 01:00:00", 4, float("inf"), None)]
    obs = spark.createDataFrame(rows, "station_id string, t string, seq long, x double, y double").selectExpr("station_id", "cast(t as timestamp_ntz) time", "seq", "x", "y")
    got = {r.time.hour: (r.x, r.y) for r in series.consolidated(obs).collect()}
    assert got == {0: (5.0, 1.0), 1: (None, None)}


def greedy_places(rows, steps=(0.01, 0.01, 25.0)):
    """Record by record: the first place within reach, or a new one with the first elevation to be reported there."""
    places = []
    for k, (lat, lon, _) in enumerate(rows):
        def near(p, r):
            return abs(p[0] - r[0]) <= steps[0] and abs(p[1] - r[1]) <= steps[1]

        def same(p, r):
            return near(p, r) and (p[2] is None or r[2] is None or abs(p[2] - r[2]) <= steps[2])

        if not any(same(p, rows[k]) for p in places):
            left = [r for r in rows[k:] if not any(same(p, r) for p in places)]
            places.append((lat, lon, next((r[2] for r in left if near((lat, lon), r) and r[2] is not None), None)))
    return places


def test_places_of_changed_stations(spark, sf_dir):

    rng = random.Random(5)
    rows = []
    for s in range(12):
        for k in range(rng.randint(1, 60)):
            rows.append((f"s{s}", k, 40.0 + rng.choice([0, 0.0078125, 0.015625, 1]) * (s > 2), -100.0, rng.choice([None, 100.0, 120.0, 140.0, 160.0]) if s > 1 else 100.0))
    obs = spark.createDataFrame(rows, "station_id string, seq int, latitude double, longitude double, elevation double")
    moved = {r.station_id for r in stations.station_locations(obs).where("changed").collect()}
    want = {(s, k, *p) for s in moved for k, p in enumerate(greedy_places([r[2:] for r in rows if r[0] == s]))}
    assert {tuple(r) for r in stations.changed_places(obs).collect()} == want and 5 < len(moved) < 12 and max(w[1] for w in want) > 2
    found = catalogue.changed_station_places(spark, sf_dir).collect()
    by = {}
    for r in catalogue.moving(spark, sf_dir).where("latitude is not null").orderBy("station_id", "seq").collect():
        by.setdefault(r.station_id, []).append((r.latitude, r.longitude, r.elevation))
    got = {}
    for r in sorted(found, key=lambda r: r.place):
        got.setdefault(r.station_id, []).append((round(r.latitude, 4), round(r.longitude, 4), r.elevation))
    assert got and got == {s: [(round(a, 4), round(b, 4), c) for a, b, c in greedy_places(by[s])] for s in got}


def test_places_of_records(spark):
    """Each record of a changed station belongs to the first place within reach of it, missing elevations to the first place around."""
    rng = random.Random(8)
    rows = [(f"s{k % 3}", k, 50 + round(rng.gauss(0, 0.01), 4), 5 + round(rng.gauss(0, 0.01), 4), rng.choice([None, 0.0, 20.0, 40.0, 400.0])) for k in range(900)]
    rows += [("still", k, 1.0, 1.0, None) for k in range(3)] + [("s0", 1000, None, 5.0, 1.0), ("", 1, 5.0, 5.0, 5.0)]
    obs = spark.createDataFrame([(*r, "x") for r in rows], "station_id string, seq int, latitude double, longitude double, elevation double, place string").drop("place").repartition(5)
    got = {(r.station_id, r.seq): (r.place, r.place_latitude, r.place_longitude, r.place_elevation) for r in stations.record_places(obs).collect()}
    want = {}
    for s in ("s0", "s1", "s2"):
        own = [r for r in rows if r[0] == s and r[2] is not None]
        places = greedy_places([r[2:] for r in own])
        for r in own:
            near = [k for k, p in enumerate(places) if abs(p[0] - r[2]) <= 0.01 and abs(p[1] - r[3]) <= 0.01 and (p[2] is None or r[4] is None or abs(p[2] - r[4]) <= 25)]
            want[s, r[1]] = (near[0], *places[near[0]])
    assert got == want and max(p[0] for p in want.values()) > 20


def test_places_of_a_ship():
    """A track of 200,000 points, each place of a few; linear in the points."""
    rng = np.random.default_rng(1)
    track = np.cumsum(rng.normal(0, 0.003, (200_000, 2)), axis=0)
    began = time.time()
    place, places = stations._anchored(track[:, 0], track[:, 1], np.zeros(len(track)), stations.Tolerance())
    assert time.time() - began < 60 and len(places) > 5_000
    anchors = np.array(places)[place]
    assert (np.abs(anchors[:, :2] - track) <= 0.01).all() and (np.diff(np.unique(place, return_index=True)[1]) > 0).all()


def test_requested_series(spark):
    rows = [("b", 0, 1, 5.0), ("a", 0, 2, None), ("a", 0, 3, 7.0), ("", 0, 4, 1.0), ("a", None, 5, 9.0)]
    obs = spark.createDataFrame(rows, "station_id string, time int, seq int, temperature double")
    got = [(r.ord, r.station_id, r.temperature) for r in series.of_requested(obs, ["a", "b", "a"]).orderBy("ord").collect()]
    assert got == [(0, "a", 7.0), (1, "b", 5.0)]
    with pytest.raises(KeyError, match="zz"):
        series.of_requested(obs, ["a", "zz"])
    places = obs.selectExpr("station_id", "1.0 as latitude", "1.0 as longitude", "1.0 as elevation")
    assert stations.located(places).where("station_id = ''").count() == 0


def test_names_in_order_of_reading(spark):
    names = spark.createDataFrame([("a", "Z first"), ("a", "A second")], "station_id string, name string").coalesce(1)
    assert stations.with_names(spark.createDataFrame([("a",)], "station_id string"), names).first().station_name == "Z first"
