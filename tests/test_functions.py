"""Column expressions against hand-computed values."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch import functions as fn


def column(spark, rows, schema, *expressions):
    df = spark.createDataFrame(rows, schema).select(*[e.alias(f"c{i}") for i, e in enumerate(expressions)])
    out = [tuple(r) for r in df.collect()]
    return [r[0] for r in out] if len(expressions) == 1 else out


def test_rounding_scales_the_double(spark):
    values = [37.245, 1.005, 2.5, -2.5, 0.49999999999999994, -0.3, None, 1e15 + 0.5]
    rows = [(v,) for v in values]
    two = column(spark, rows, "x double", fn.parity_round(F.col("x"), 2))
    assert two[:2] == [37.24, 1.0]
    zero = column(spark, rows, "x double", fn.parity_round(F.col("x")))
    assert zero == [37, 1, 3, -3, 0, 0, None, 1e15 + 1]
    positive = column(spark, rows, "x double", fn.round_positive(F.col("x")))
    assert [positive[i] for i in (0, 1, 2, 4, 6, 7)] == [37, 1, 3, 0, None, 1e15 + 1]


def test_to_int_rounds_to_nearest(spark):
    assert column(spark, [(3.5,), (2.5,), (None,), (1e12,)], "x double", fn.to_int(F.col("x"))) == [4, 2, None, None]
    assert column(spark, [("70.0",), ("x",)], "x string", fn.to_int(F.col("x"))) == [70, None]


def test_beaufort_and_knots(spark):
    rows = [(None,), (1.9,), (2.0,), (116.9,), (117.0,)]
    assert column(spark, rows, "x double", fn.beaufort(F.col("x"))) == [12, 0, 1, 11, 12]
    assert column(spark, [(100.0,), (None,)], "x double", fn.kmh_to_kts(F.col("x"))) == [54.0, None]


def test_vessel_type(spark):
    rows = [(None,), (70,), (99,)]
    assert column(spark, rows, "x int", fn.vessel_type_desc(F.col("x"))) == [None, "Cargo", "Other (99)"]


def test_stay(spark):
    rows = [(None,), (5.99,), (6.0,), (24.0,), (48.0,), (48.01,), (72.0,)]
    got = column(spark, rows, "x double", fn.stay_category(F.col("x")), fn.is_extended_stay(F.col("x")))
    assert got == [
        ("in_port", 0),
        ("brief_stop", 0),
        ("day_call", 0),
        ("standard_call", 0),
        ("standard_call", 0),
        ("standard_call", 1),
        ("extended_stay", 1),
    ]


def test_port_tiers(spark):
    rows = [("Large", 14.0), ("Large", 13.9), ("Large", None), ("Medium", 20.0), ("Small", 1.0), ("Unknown", 30.0)]
    got = column(
        spark, rows, "s string, d double", fn.capacity_tier(F.col("s"), F.col("d")), fn.harbor_size_rank(F.col("s"))
    )
    assert [(t[5], r) for t, r in got] == [("1", 1), ("2", 1), ("2", 1), ("2", 2), ("3", 3), ("4", 5)]


def test_anomaly_labels(spark):
    rows = [
        (400.0, None, None),
        (180.0, 100.0, 33.3),
        (180.0, 50.0, 1.0),
        (10.0, 50.0, 300.0),
        (10.0, 1.0, 6.0),
        (5000.0, 5000.0, 60.0),
    ]
    evidence = [F.col(c) for c in "gds"]
    got = column(spark, rows, "g double, d double, s double", fn.anomaly_type(*evidence), fn.risk_score(*evidence))
    assert [t for t, _ in got] == [
        "extended_blackout",
        "blackout_with_movement",
        "blackout_stationary",
        "impossible_speed",
        None,
        "blackout_with_movement",
    ]
    assert got[1][1] == 41 and got[5][1] == 100


def test_blank_to_null(spark):
    assert column(spark, [("  ",), (" a ",), (None,)], "x string", fn.blank_to_null(F.col("x"))) == [None, "a", None]


def test_implied_speed_needs_a_gap(spark):
    rows = [(10.0, 0.0), (10.0, 60.0), (None, 60.0), (10.0, None)]
    assert column(spark, rows, "d double, g double", fn.implied_speed(F.col("d"), F.col("g"))) == [None, 10.0, None, None]


def test_haversine_fixed_points(spark):
    rows = [(0.0, 0.0, 0.0, 1.0), (10.0, 20.0, 10.0, 20.0), (0.0, 0.0, 0.0, 180.0), (None, 1.0, 2.0, 3.0)]
    got = column(spark, rows, "a double, b double, c double, d double", fn.haversine_nm(*[F.col(c) for c in "abcd"]))
    assert got == [60.04, 0.0, round(3440.065 * math.pi, 2), None]


points = st.lists(
    st.tuples(*[st.floats(-90, 90), st.floats(-180, 180)] * 2), min_size=20, max_size=60
)


@settings(max_examples=5, deadline=None)
@given(points)
def test_haversine_is_symmetric_and_bounded(spark, rows):
    a, b, c, d = (F.col(x) for x in "abcd")
    there, back = fn.haversine_nm(a, b, c, d), fn.haversine_nm(c, d, a, b)
    for x, y in column(spark, rows, "a double, b double, c double, d double", there, back):
        assert x == pytest.approx(y, abs=0.0101)
        assert 0 <= x <= 10807.29


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1e4), st.floats(0, 1e4), st.floats(0, 1e3)), min_size=20, max_size=60))
def test_risk_is_bounded_and_grows(spark, rows):
    g, d, s = (F.col(x) for x in "gds")
    scores = [fn.risk_score(g, d, s), fn.risk_score(g + 60, d, s), fn.risk_score(g, d + 50, s)]
    for base, longer, farther in column(spark, rows, "g double, d double, s double", *scores):
        assert 0 <= base <= 100 and longer >= base and farther >= base
