"""Weather as of a ping and gaps filled forward: against plain Python."""

import random
from datetime import timedelta
from math import hypot

import pytest
from pyspark.sql import functions as F

from conftest import at, plan_of
from tidewatch.operators import carry

PINGS = "mmsi string, position_ts timestamp, latitude double, longitude double, day string"
WEATHER = "zone_name string, weather_ts timestamp, latitude double, longitude double, wave double, wind double"
ZONES = {"a": (10.0, 20.0), "b": (10.0, 23.0), "c": (40.0, -170.0), "d": (11.0, 20.5)}


def some_rows(seed):
    """Readings with gaps of days, nulls and equal times; a third of all pings is of one vessel in one place."""
    rng = random.Random(seed)
    weather = []
    for zone, (lat, lon) in ZONES.items():
        for _ in range(25):
            hour = rng.choice([rng.uniform(0, 60), rng.uniform(200, 500)])
            weather.append((zone, at(round(hour, 2)), lat, lon, rng.choice([None, 1.0, 2.5]), rng.choice([None, 30.0])))
    weather += [(*weather[3][:4], 9.0, None), (*weather[3][:4], 9.0, 4.0), weather[7], ("e", None, 1.0, 1.0, 1.0, 1.0), (None, at(1), 1.0, 1.0, 1.0, 1.0), ("f", at(3), None, None, 1.0, 1.0)]
    pings = [("hot", at(i * 2.5), 10.1, 20.1, "x") for i in range(200)]
    pings += [(f"v{rng.randrange(5)}", at(rng.uniform(-20, 600)), rng.choice([10.0, 10.5, 38.0, 13.1, -60.0]), rng.choice([20.0, 21.6, 25.9, -170.0]), "x") for _ in range(380)]
    pings += [("null", at(5), None, 20.0, "x"), ("still", weather[0][1], *ZONES["a"], "x"), ("none", None, 10.0, 20.0, "x"), pings[250], pings[250]]
    return pings, weather


def plain_as_of(ping, weather, radius, hours):
    _, ts, lat, lon, _ = ping
    near = [] if lat is None else sorted((hypot(lat - w[2], lon - w[3]), w[0]) for w in weather if w[0] is not None and w[2] is not None)
    zone = near[0][1] if near and near[0][0] < radius else None
    low = lambda v: (v is not None, v or 0)
    known = [w for w in weather if zone is not None and ts is not None and w[0] == zone and w[1] is not None and w[1] <= ts]
    last = max(known, key=lambda w: (w[1], low(w[4]), low(w[5])), default=None)
    if last is None or ts - last[1] > timedelta(hours=hours):
        return (zone, None, None, None)
    return (zone, last[1], last[4], last[5])


@pytest.mark.parametrize("hours", [5, 24, 72, 100])
def test_weather_at_pings_by_brute_force(spark, hours):
    pings, weather = some_rows(1)
    got = carry.weather_at_pings(spark.createDataFrame(pings, PINGS), spark.createDataFrame(weather, WEATHER), ["wave", "wind"], 3.0, hours)
    assert got.columns == ["mmsi", "position_ts", "latitude", "longitude", "day", "zone_name", "weather_ts", "wave", "wind"]
    want = [(*p, *plain_as_of(p, weather, 3.0, hours)) for p in pings]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert sum(w[6] is not None for w in want) > 50


def test_weather_of_nothing(spark):
    pings, weather = some_rows(2)
    none, readings = spark.createDataFrame([], PINGS), spark.createDataFrame(weather, WEATHER)
    assert carry.weather_at_pings(none, readings, ["wave"]).count() == 0
    got = carry.weather_at_pings(spark.createDataFrame(pings, PINGS), readings.limit(0), ["wave"])
    assert got.count() == len(pings) and got.where("zone_name IS NOT NULL OR weather_ts IS NOT NULL").count() == 0


def test_no_window_runs_over_pings(spark):
    pings, weather = some_rows(3)
    plan = plan_of(carry.weather_at_pings(spark.createDataFrame(pings, PINGS).withColumn("mark", F.lit(1)), spark.createDataFrame(weather, WEATHER), ["wave"]))
    windows = [line for line in plan.split("\n") if "Window" in line]
    assert windows and not any("mmsi" in line for line in windows) and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def plain_fill(rows, max_age):
    out, keys = [], {r[0] for r in rows if r[0] is not None and r[1] is not None}
    hour_of = lambda ts: (ts - at(0)) // timedelta(hours=1)
    for key in keys:
        own = [(hour_of(ts), ts, v) for k, ts, *v in rows if k == key and ts is not None]
        for hour in range(min(h for h, *_ in own), max(h for h, *_ in own) + 1):
            values = []
            for c in range(2):
                known = [(h, ts, v[c]) for h, ts, v in own if h <= hour and v[c] is not None]
                last = max(known, default=None)
                values.append(last[2] if last and hour - last[0] <= max_age else None)
            out.append((key, at(hour), *values))
    return out


@pytest.mark.parametrize("max_age", [0, 6, 24, 1000])
def test_fill_forward_by_brute_force(spark, max_age):
    rng = random.Random(6)
    rows = []
    for key, many in (("often", 60), ("seldom", 6), ("never", 5), ("once", 1)):
        for _ in range(many):
            hour = rng.uniform(-30, 120 if key == "often" else 400)
            rows.append((key, at(round(hour, 3)), None if key == "never" else rng.choice([None, 1.0, 2.0]), rng.choice([None, None, 5.0]) if hour > 40 else None))
    rows += [rows[0], (rows[1][0], rows[1][1], 7.0, 8.0), (None, at(1), 1.0, 1.0), ("gone", None, 1.0, 1.0)]
    table = spark.createDataFrame(rows, "zone string, ts timestamp, a double, b double").withColumn("hour", F.lit("taken"))
    got = carry.fill_forward(table, "zone", "ts", ["a", "b"], max_age)
    assert got.columns == ["zone", "hour", "a", "b"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain_fill(rows, max_age)))
    assert carry.fill_forward(table.limit(0), "zone", "ts", ["a", "b"]).count() == 0
