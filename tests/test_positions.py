"""Cleaning, deduplication, neighbours and the position facts."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import at, plan_of
from tidewatch import schemas
from tidewatch.operators import anomalies, positions
from tidewatch.operators.neighbours import with_neighbour


def raw(spark, rows):
    """Rows of (mmsi, hours, lat, lon) or dicts over the bronze columns."""
    names = schemas.AIS.names

    def full(row):
        if not isinstance(row, dict):
            row = dict(zip(["MMSI", "BaseDateTime", "LAT", "LON"], row))
        row = {**row, "BaseDateTime": None if row["BaseDateTime"] is None else at(row["BaseDateTime"])}
        return tuple(row.get(n) for n in names)

    return spark.createDataFrame([full(r) for r in rows], schemas.AIS)


def test_invalid_positions_are_dropped(spark):
    rows = [
        ("a", 0, 0.0, 5.0),
        ("b", 0, 5.0, 0.0),
        ("c", 0, None, 5.0),
        ("d", 0, 90.0, 180.0),
        ("e", None, 5.0, 5.0),
        ("f", 0, 90.1, 5.0),
        ("g", 0, float("nan"), 5.0),
    ]
    assert [r.MMSI for r in positions.valid_positions(raw(spark, rows)).collect()] == ["d"]


def test_dedup_prefers_length_and_is_idempotent(spark):
    ping = {"MMSI": "a", "BaseDateTime": 1, "LAT": 1.0, "LON": 1.0}
    rows = [{**ping, "Length": None, "IMO": "x"}, {**ping, "Length": 9.0, "IMO": "z"}, {**ping, "Length": 9.0, "IMO": "y"}]
    staged = positions.stage_positions(raw(spark, rows))
    assert [(r.length_m, r.imo) for r in staged.collect()] == [(9.0, "y")]
    assert sorted(map(str, positions.dedup_positions(staged).collect())) == sorted(map(str, staged.collect()))


def test_dedup_keeps_null_vessels_apart_by_time(spark):
    staged = positions.stage_positions(raw(spark, [(None, 0, 1.0, 1.0), (None, 0, 1.0, 1.0), (None, 1, 1.0, 1.0)]))
    assert staged.count() == 2


def test_two_pings_within_seconds_have_no_speed(spark):
    staged = positions.stage_positions(raw(spark, [("a", 0, 10.0, 10.0), ("a", 2 / 3600, 10.2, 10.0)]))
    fact = positions.fct_vessel_positions(staged)
    last = fact.orderBy(F.desc("position_ts")).first()
    assert last.time_gap_minutes == 0.0 and last.distance_nm > 10
    assert anomalies.fct_ais_anomalies(fact).count() == 0


def test_first_ping_has_no_leg(spark):
    fact = positions.fct_vessel_positions(positions.stage_positions(raw(spark, [("a", 0, 10.0, 10.0)])))
    row = fact.first()
    assert row.distance_nm is None and row.time_gap_minutes is None


def hot_series(spark, n=3000, seed=7):
    """A third of the rows belong to one key; keys and values may be null; one hour is crowded."""
    rng = random.Random(seed)
    seen, rows = set(), []
    while len(rows) < n:
        key = "hot" if rng.random() < 0.34 else rng.choice([None, *"abcdefgh"])
        sub = rng.choice([None, 1, 2])
        hour = 5 + rng.random() if rng.random() < 0.3 else rng.random() * 24 * 20
        ts = at(round(hour, 6))
        if (key, sub, ts) not in seen:
            seen.add((key, sub, ts))
            rows.append((key, sub, ts, rng.choice([None, rng.random()]), rng.random() < 0.2))
    return spark.createDataFrame(rows, "k string, s int, ts timestamp, v double, mark boolean").repartition(6)


@pytest.mark.parametrize("bucket", ["hour", "day"])
@pytest.mark.parametrize("direction", ["previous", "next"])
def test_neighbour_equals_plain_window(spark, direction, bucket):
    df = hot_series(spark)
    order = F.col("ts").asc() if direction == "previous" else F.col("ts").desc()
    w = Window.partitionBy("k", "s").orderBy(order)
    plain = df.withColumns({"n_ts": F.lag("ts").over(w), "n_v": F.lag("v").over(w)})
    got = with_neighbour(df, ["k", "s"], "ts", ["v"], prefix="n_", direction=direction, bucket=bucket)
    assert got.schema["k"].dataType == df.schema["k"].dataType and got.schema["s"].dataType == df.schema["s"].dataType
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("direction", ["previous", "next"])
def test_neighbour_among_marked_rows(spark, direction):
    df = hot_series(spark, 1500)
    order = F.col("ts").asc() if direction == "previous" else F.col("ts").desc()
    w = Window.partitionBy("k", "s").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    found = F.last(F.when(F.col("mark"), F.struct("ts", "v")), ignorenulls=True).over(w)
    plain = df.withColumns({"n_ts": found["ts"], "n_v": found["v"]})
    got = with_neighbour(df, ["k", "s"], "ts", ["v"], prefix="n_", direction=direction, only=F.col("mark"))
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def test_neighbour_direction_is_checked(spark):
    with pytest.raises(ValueError):
        with_neighbour(hot_series(spark, 10), ["k"], "ts", [], prefix="p", direction="sideways")


def test_copies_are_reduced_before_the_exchange(spark):
    plan = plan_of(positions.dedup_positions(positions.clean_positions(raw(spark, [("a", 0, 1.0, 1.0)]))))
    limit, exchange = plan.rindex("WindowGroupLimit"), plan.index("Exchange hashpartitioning")
    assert limit > exchange, "a group limit runs below the exchange"


def test_fact_windows_by_vessel_and_hour(spark, tmp_path):
    path = str(tmp_path / "staged")
    positions.stage_positions(raw(spark, [("a", i / 10, 1.0, 1.0 + i) for i in range(20)])).write.parquet(path)
    plan = plan_of(positions.fct_vessel_positions(spark.read.parquet(path)))
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(mmsi" in line]
    by_vessel_alone = [line for line in exchanges if "_bucket" not in line]
    assert len(exchanges) - len(by_vessel_alone) == 2, "rows and edges are both shuffled by vessel and hour"
    assert len(by_vessel_alone) == 1, "only the edge table is shuffled by vessel alone"
    below = plan[plan.index(by_vessel_alone[0]) :]
    assert "HashAggregate" in below.splitlines()[1]
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
