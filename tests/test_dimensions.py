"""Vessel, port and calendar dimensions and the wide table."""

from datetime import datetime

from pyspark.sql import functions as F

from conftest import at, plan_of
from test_positions import raw
from tidewatch.operators import dimensions, ports, positions
from tidewatch import schemas


def test_latest_known_attribute_wins(spark):
    base = {"MMSI": "a", "LAT": 1.0, "LON": 1.0}
    rows = [
        {**base, "BaseDateTime": 0, "VesselName": "OLD", "VesselType": 70, "Length": 10.04},
        {**base, "BaseDateTime": 1, "VesselName": "NEW", "Length": 10.06},
        {**base, "BaseDateTime": 2, "VesselName": "  "},
    ]
    row = dimensions.dim_vessels(positions.stage_positions(raw(spark, rows))).first()
    assert (row.vessel_name, row.vessel_type_desc, row.length_m, row.total_pings) == ("NEW", "Cargo", 10.1, 3)
    assert (row.first_seen, row.last_seen) == (at(0), at(2))


def test_vessel_without_type(spark):
    row = dimensions.dim_vessels(positions.stage_positions(raw(spark, [("a", 0, 1.0, 1.0)]))).first()
    assert row.vessel_type_desc is None


def test_calendar(spark):
    cal = dimensions.dim_time(spark)
    assert cal.count() == 17_520
    assert cal.agg(F.max("time_key")).first()[0] == datetime(2025, 12, 30, 23)
    sunday = cal.filter("date_key = '2024-01-07' and hour = 16").first()
    assert (sunday.day_of_week, sunday.is_weekend, sunday.season) == (0, 1, "Winter")
    assert sunday.watch_period == "First Dog/Second Dog" and sunday.is_peak_trade_season == 1
    watches = {r.hour: r.watch_period for r in cal.filter("date_key = '2024-06-03'").collect()}
    assert [watches[h] for h in (0, 3, 4, 8, 12, 20)] == [
        "Middle Watch",
        "Middle Watch",
        "Morning Watch",
        "Forenoon Watch",
        "Afternoon Watch",
        "First Watch",
    ]
    seasons = {r.month: (r.season, r.is_peak_trade_season) for r in cal.select("month", "season", "is_peak_trade_season").distinct().collect()}
    assert seasons[12] == ("Winter", 1) and seasons[5] == ("Spring", 0) and seasons[8] == ("Summer", 0)
    assert seasons[9] == ("Autumn", 1) and len(seasons) == 12


def test_zones(spark):
    zones = dimensions.dim_weather_zones(spark)
    assert zones.count() == 12 and zones.select("zone_code").distinct().count() == 12


def test_port_defaults(spark):
    rows = [(1, "P", "X", 1.0, 2.0) + (None,) * 12, (2, None) + (None,) * 15]
    got = ports.dim_ports(ports.clean_ports(spark.createDataFrame(rows, schemas.PORTS))).collect()
    assert len(got) == 1 and got[0].port_key == 1
    assert (got[0].harbor_size, got[0].has_railway, got[0].capacity_tier) == ("Unknown", "No", "Tier 4 - Minor")


def test_wide_table_broadcasts_only_the_calendar_by_hint(spark):
    staged = positions.stage_positions(raw(spark, [("a", i, 1.0, 1.0 + i) for i in range(4)]))
    wide = dimensions.obt_vessel_tracking(
        positions.fct_vessel_positions(staged), dimensions.dim_vessels(staged), dimensions.dim_time(spark)
    )
    assert len(wide.columns) == 26 and wide.count() == 4
    assert "BroadcastHashJoin" in plan_of(wide)
    assert wide.filter("season is null").count() == 0
