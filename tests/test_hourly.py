import random
from datetime import datetime, timedelta

import pytest

from skygrid.operators import hourly, validity

DAY = datetime(2024, 1, 1)


def at(clock):
    h, m, s = (int(x) for x in clock.split(":"))
    return DAY + timedelta(hours=h, minutes=m, seconds=s)


def run(spark, points, max_hours=2, **options):
    rows = spark.createDataFrame([("s", at(t), v) for t, v in points], "station_id string, time timestamp_ntz, x double")
    return {(r.time - DAY).total_seconds() / 3600: r.x for r in hourly.at_full_hours(rows, ["x"], max_hours, **options).collect()}


@pytest.mark.parametrize(
    ("points", "want"),
    [
        ([("01:00:00", 3.0)], {1: 3.0}),
        ([("00:30:00", 0.0), ("01:30:00", 10.0)], {1: 5.0}),
        ([("00:00:00", 0.0), ("02:00:00", 2.0)], {0: 0.0, 1: 1.0, 2: 2.0}),
        ([("00:00:00", 0.0), ("02:00:01", 2.0)], {0: 0.0}),
        ([("00:30:00", 0.0), ("00:50:00", None), ("01:30:00", 10.0)], {1: 5.0}),
        ([("00:30:00", 0.0), ("01:00:00", None), ("01:30:00", 10.0)], {1: 5.0}),
        ([("00:30:00", 1.0), ("02:30:00", 3.0)], {1: 1.5, 2: 2.5}),
        ([], {}),
    ],
)
def test_cases(spark, points, want):
    assert run(spark, points) == pytest.approx(want)


def test_dates_bound_the_output(spark):
    points = [("00:20:00", 0.0), ("01:20:00", 1.0), ("02:20:00", 2.0), ("03:20:00", 3.0)]
    got = run(spark, points, start=at("01:20:00"), end=at("02:40:00"))
    assert sorted(got) == [1, 2]


def test_bad_arguments(spark):
    for options in ({"max_hours": 0}, {"start": DAY}, {"start": DAY, "end": DAY - timedelta(hours=1)}):
        with pytest.raises(ValueError):
            run(spark, [("00:00:00", 1.0)], **options)


def test_against_a_sequential_model(spark):
    """Random series, some longer than a chunk, against a plain reading of the rule."""
    rng = random.Random(9)
    rows, want = [], {}
    for s in range(12):
        t, own = DAY + timedelta(seconds=rng.randint(0, 7200)), []
        for _ in range(400):
            own.append((t, None if rng.random() < 0.2 else rng.uniform(-5, 5)))
            t += timedelta(seconds=rng.choice([600, 1800, 3600, 5000, 20000]))
        rows += [(f"s{s}", a, b) for a, b in own]
        valid = [(a, b) for a, b in own if b is not None]
        h, k = datetime(2024, 1, 1), 0
        while h <= valid[-1][0]:
            while k + 1 < len(valid) and valid[k + 1][0] <= h:
                k += 1
            (a, x), n = valid[k], valid[k + 1] if k + 1 < len(valid) else None
            if a == h:
                want[f"s{s}", h] = x
            elif a < h and n and n[0] - a <= timedelta(hours=3):
                want[f"s{s}", h] = x + (h - a) / (n[0] - a) * (n[1] - x)
            h += timedelta(hours=1)
    df = spark.createDataFrame(rows, "station_id string, time timestamp_ntz, x double")
    got = {(r.station_id, r.time): r.x for r in hourly.at_full_hours(df, ["x"], 3).collect()}
    assert got == pytest.approx(want)


def test_one_shuffle(spark):
    rows = spark.createDataFrame([("s", DAY, 1.0, 2.0)], "station_id string, time timestamp_ntz, x double, y double")
    plan = hourly.at_full_hours(rows, ["x", "y"])._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial")[0].count("Exchange hashpartitioning") == 1


def test_hours_are_not_gathered(spark):
    """An hour comes from one row with all variables: no task keeps hours in a hash table."""
    rows = spark.createDataFrame([("s", DAY, 1.0, 2.0)], "station_id string, time timestamp_ntz, x double, y double")
    plan = hourly.at_full_hours(rows, ["x", "y"])._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and plan.count("Window [") == plan.count("Sort [") == 1


@pytest.mark.parametrize("chunk", [1, 50, 768])
def test_variables_meet_in_one_row(spark, monkeypatch, chunk):
    """Two variables with gaps of their own give what each gives alone, and an hour once."""
    monkeypatch.setattr(hourly, "CHUNK_HOURS", chunk)
    rng = random.Random(chunk)
    rows = []
    for s in ("a", "b", "c"):
        for m in sorted(rng.sample(range(0, 12000, 15), 150)):
            rows.append((s, DAY + timedelta(minutes=m), rng.choice([None, rng.uniform(-5, 5)]), rng.choice([None, None, float("nan"), rng.uniform(-5, 5)])))
    df = spark.createDataFrame(rows, "station_id string, time timestamp_ntz, x double, y float")
    want = {}
    for k, c in enumerate("xy"):
        for r in hourly.at_full_hours(df.select("station_id", "time", c), [c], 5).collect():
            want.setdefault((r.station_id, r.time), [None, None])[k] = r[c]
    got = hourly.at_full_hours(df, ["x", "y"], 5).collect()
    assert sorted((r.station_id, r.time, str([r.x, r.y])) for r in got) == sorted((*key, str(v)) for key, v in want.items())


def test_valid_fraction(spark):
    rows = [("a", DAY + timedelta(hours=k), 1.0, 1.0 if k < 2 else None) for k in range(4)]
    df = spark.createDataFrame(rows, "station_id string, time timestamp_ntz, x double, y double")
    fractions = validity.valid_fraction(df, ["x", "y"], 4)
    assert fractions.first().valid_fraction == 0.5
    assert validity.at_least(df, fractions, 0.5).count() == 4 and validity.at_least(df, fractions, 0.666).count() == 0


@pytest.mark.parametrize("chunk", [1, 5, 768])
def test_neighbours_across_chunks(spark, monkeypatch, chunk):
    """Previous and next valid rows, and consecutive ones, may lie in other chunks of time."""

    monkeypatch.setattr(hourly, "CHUNK_HOURS", chunk)
    rng = random.Random(chunk)
    begin = datetime(2024, 1, 1)
    rows = [(s, begin + timedelta(minutes=m), k, rng.choice([None, float(m)])) for s in ("a", "b") for k, m in enumerate(sorted(rng.sample(range(0, 6000), 25)))]
    obs = spark.createDataFrame(rows, "station_id string, time timestamp_ntz, seq int, v double")
    grid = spark.createDataFrame([(s, begin + timedelta(hours=h)) for s in ("a", "b", "c") for h in range(0, 101, 3)], "station_id string, time timestamp_ntz")
    for r in hourly.neighbours(grid, obs, "v").collect():
        own = sorted((t, v) for s, t, _, v in rows if s == r.station_id and v is not None)
        assert (r.prev_time, r.prev_value) == max([x for x in own if x[0] <= r.time], default=(None, None))
        assert (r.next_time, r.next_value) == min([x for x in own if x[0] > r.time], default=(None, None))
    times = {s: sorted(t for x, t, _, _ in rows if x == s) for s in ("a", "b")}
    assert sorted(map(tuple, hourly.consecutive(obs).collect()), key=str) == sorted([(s, t, n) for s, x in times.items() for t, n in zip(x, [*x[1:], None], strict=True)], key=str)


def test_parts_of_other_columns_are_named(spark):
    one, other = spark.createDataFrame([("a", 1.0)], "station_id string, temperature double"), spark.createDataFrame([("b", 1.0)], "station_id string, temperature float")
    assert hourly.merged(one, one.select("temperature", "station_id")).count() == 2
    with pytest.raises(ValueError, match="part 1 .*temperature .double.*temperature .float"):
        hourly.merged(one, other)
