"""Geofence, events and calls."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import at, plan_of
from tidewatch.functions import planar_degrees
from tidewatch.operators import port_calls

PING = "mmsi string, position_ts timestamp, latitude double, longitude double, sog double"
PORT = "port_index int, port_name string, latitude double, longitude double"


def pings(spark, sogs, hours=None):
    hours = hours or range(len(sogs))
    return spark.createDataFrame([("a", at(h), 10.0, 20.0, s) for h, s in zip(hours, sogs)], PING)


def port(spark):
    return spark.createDataFrame([(1, "P", 10.05, 20.0)], PORT)


def calls_of(spark, sogs, hours=None, **kwargs):
    events = port_calls.port_events(port_calls.near_ports(pings(spark, sogs, hours), port(spark)))
    return port_calls.port_calls(events, **kwargs).orderBy("arrival_ts").collect()


def test_departure_is_the_next_arrival(spark):
    rows = calls_of(spark, [0.0, 5.0, 0.0], [0, 6, 10])
    assert [(r.arrival_ts, r.departure_ts, r.duration_hours) for r in rows] == [
        (at(0), at(10), 10.0),
        (at(10), None, None),
    ]


def test_departure_can_be_the_next_departure(spark):
    rows = calls_of(spark, [0.0, 5.0, 0.0], [0, 6, 10], departure="next_departure")
    assert [r.duration_hours for r in rows] == [6.0, None]


def test_unknown_departure_mode(spark):
    with pytest.raises(ValueError):
        calls_of(spark, [0.0], departure="never")


def events_of(spark, sogs):
    events = port_calls.port_events(port_calls.near_ports(pings(spark, sogs), port(spark)))
    return [r.event_type for r in events.orderBy("position_ts").collect()]


def test_first_pings_and_unknown_speeds(spark):
    assert events_of(spark, [0.5, 0.6, 2.0]) == ["arrival", None, "departure"]
    assert events_of(spark, [2.0, None, 0.5]) == ["departure", None, None]


def test_slow_return_after_days_is_no_arrival(spark):
    rows = calls_of(spark, [0.0, 0.0], [0, 100])
    assert len(rows) == 1


@pytest.mark.parametrize("salts", [1, 3])
@pytest.mark.parametrize("radius", [0.1, 0.37])
def test_grid_join_equals_cross_product(spark, radius, salts):
    rng = random.Random(3)
    spot = lambda: (rng.uniform(-2, 2), rng.uniform(-2, 2)) if rng.random() < 0.7 else (round(rng.uniform(-2, 2), 1), 0.3)
    p = spark.createDataFrame([(str(i % 7), at(i), *spot(), 1.0) for i in range(400)], PING)
    ports = spark.createDataFrame([(i, f"p{i}", *spot()) for i in range(80)] + [(99, "x", None, 1.0)], PORT)
    cross = p.crossJoin(ports.select("port_index", F.col("latitude").alias("a"), F.col("longitude").alias("b")))
    near = cross.filter(planar_degrees(F.col("latitude"), F.col("longitude"), F.col("a"), F.col("b")) < radius)
    expected = sorted((r.position_ts, r.port_index) for r in near.collect())
    got = port_calls.near_ports(p, ports, radius, salts)
    assert sorted((r.position_ts, r.port_id) for r in got.collect()) == expected and expected
    assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)


def test_grid_join_shuffles_when_ports_are_many(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = port_calls.near_ports(pings(spark, [0.0, 1.0]), port(spark))
        assert "SortMergeJoin" in plan_of(got) and got.count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def wandering(spark):
    """Vessels that jump between fences for weeks, with unknown speeds and a null vessel, and ports of which two share a number."""
    rng = random.Random(8)
    spots = [(10.0, 20.0), (10.06, 20.0), (10.12, 20.05), (30.0, 40.0), (10.5, 20.5)]
    rows = []
    for vessel in ("a", "b", None):
        for i in range(120):
            lat, lon = spots[rng.choice([0, 0, 0, 1, 2, 3, 4])]
            rows.append((vessel, at(i * 7 + rng.random()), lat + rng.random() / 100, lon, rng.choice([0.2, 0.9, 1.0, 5.0, None])))
    ports = [(1, "P", 10.05, 20.0), (2, "Q", 10.1, 20.0), (3, "R", 30.0, 40.0), (4, "S", 10.0, 19.95), (4, "S", 10.5, 20.5), (5, "T", None, 1.0)]
    return spark.createDataFrame(rows, PING), spark.createDataFrame(ports, PORT)


def test_stops_near_are_the_stops_of_all_pairs(spark):
    staged, ports = wandering(spark)
    rows = lambda df: sorted(map(str, df.select(*port_calls._NEAR, "event_type").collect()))
    want = rows(port_calls.stops(port_calls.near_ports(staged, ports)))
    assert rows(port_calls.stops_near(staged, ports)) == want and len(want) > 100


def test_pairs_known_by_the_last_pings_are_not_exchanged(spark):
    """A vessel that stays in its fences for a week sends only what is first or last there, and no pair between."""
    staged = pings(spark, [0.2, 5.0, 0.3] * 40)
    near = port_calls.near_ports(staged, port(spark))
    found = port_calls.stops_near(staged, port(spark))
    assert found.count() == 81 and near.count() == 120
    asked = []
    keep = port_calls.stops
    port_calls.stops = lambda near, *args: asked.append(near.count()) or keep(near, *args)
    try:
        port_calls.stops_near(staged, port(spark))
    finally:
        port_calls.stops = keep
    assert sum(asked) < 12


@pytest.mark.parametrize("departure", ["next_arrival", "next_departure"])
def test_calls_made_in_parts(spark, monkeypatch, departure):
    """Parts of vessels give the calls of all pairs, and what was stored on the way is gone."""
    from pathlib import Path

    from tidewatch.session import shared_dir

    staged, ports = wandering(spark)
    monkeypatch.setattr(port_calls, "_PINGS_OF_PART", 100)
    made = port_calls.stage_port_calls(staged, ports, departure)
    want = port_calls.port_calls(port_calls.stops(port_calls.near_ports(staged, ports)), departure)
    assert made.columns == want.columns
    assert sorted(map(str, made.collect())) == sorted(map(str, want.collect())) != []
    assert len({f.split("vessel_part=")[1].split("/")[0] for f in made.inputFiles()}) > 1
    kept = Path(shared_dir(spark).removeprefix("file:"))
    assert not list(kept.glob("port-events-*")) and not list(kept.glob("port-pings-*"))
