"""Landed files in, layer tables out, all in fresh temporary folders."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import at
from test_positions import raw
from tidewatch import schemas
from tidewatch.sources import ais, ports, tables, weather


def test_bulk_files_of_both_kinds_without_geometry(spark, tmp_path):
    day = raw(spark, [("a", 0, 1.0, 2.0), ("b", 1, 3.0, 4.0)])
    day.withColumn("geometry", F.lit("POINT").cast("binary")).write.parquet(str(tmp_path / "x"))
    part = next((tmp_path / "x").glob("*.parquet"))
    (tmp_path / "more").mkdir()
    (tmp_path / "more" / "day2.geoparquet").write_bytes(part.read_bytes())
    (tmp_path / "more" / "notes.txt").write_text("not data")
    (tmp_path / "more" / "deeper").mkdir()
    (tmp_path / "more" / "deeper" / "day3.parquet").write_bytes(part.read_bytes())
    one = spark.read.parquet(str(part)).count()
    df = ais.read_ais(spark, str(tmp_path / "more"))
    assert df.columns == schemas.AIS.names and df.count() == one
    assert ais.read_ais(spark, str(tmp_path / "x"), str(tmp_path / "more")).count() == day.count() + one
    assert ais.read_ais(spark, str(tmp_path / "more" / "deeper" / "*")).count() == one
    (tmp_path / "none").mkdir()
    assert ais.read_ais(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(FileNotFoundError):
        ais.read_ais(spark, str(tmp_path / "missing"))


def test_a_named_file_is_read_whatever_its_ending(spark, tmp_path):
    raw(spark, [("a", 0, 1.0, 2.0)]).coalesce(1).write.parquet(str(tmp_path / "x"))
    part = next((tmp_path / "x").glob("*.parquet"))
    (tmp_path / "day2.pq").write_bytes(part.read_bytes())
    assert ais.read_ais(spark, str(part), str(tmp_path / "day2.pq")).count() == 2


def test_files_of_different_types_are_cast_each_on_its_own(spark, tmp_path):
    day = raw(spark, [("7", 0, 1.0, 2.0)]).withColumn("VesselType", F.lit(70)).coalesce(1)
    path = str(tmp_path / "days")
    day.write.parquet(path)
    for column, kind in (("VesselType", "double"), ("MMSI", "long"), ("LAT", "string"), ("VesselType", "double")):
        day.withColumn(column, F.col(column).cast(kind)).write.mode("append").parquet(path)
    rows = ais.read_ais(spark, path).collect()
    assert [(r.MMSI, r.LAT, r.VesselType) for r in rows] == [("7", 1.0, 70)] * 5


def test_unparsable_text_becomes_null_and_is_reported(spark):
    text = raw(spark, [("a", 0, 1.0, 2.0)]).select(*[F.col(c).cast("string").alias(c) for c in schemas.AIS.names])
    text = text.withColumn("VesselType", F.lit("70.0")).withColumn("Status", F.lit("1.5"))
    mixed = text.unionByName(text.withColumn("LAT", F.lit("north")).withColumn("MMSI", F.lit("bad")))
    rows = ais.cast_ais(mixed).orderBy("MMSI").collect()
    assert [(r.LAT, r.VesselType, r.Status) for r in rows] == [(1.0, 70, 2), (None, 70, 2)]
    assert [r.MMSI for r in ais.bad_casts(mixed).collect()] == ["bad"]


def test_position_documents(spark, tmp_path):
    def feature(coordinates, **properties):
        return {"type": "Feature", "geometry": {"coordinates": coordinates}, "properties": properties}

    document = {
        "features": [
            feature([24.5, 60.1], mmsi=230, timestampExternal=1704067200123, timestamp=1, sog=3.5, shipType=70, navStat=0),
            feature([24.5], mmsi=231, timestamp=1704067200000, draught=4.5),
            feature([], sog=1.0),
        ]
    }
    (tmp_path / "poll.json").write_text(json.dumps(document, indent=2))
    (tmp_path / "broken.json").write_text("{ not json")
    documents = ais.read_position_documents(spark, str(tmp_path))
    broken = ais.broken_positions(documents).collect()
    assert [(r.text, r.path.rsplit("/", 1)[1]) for r in broken] == [("{ not json", "broken.json")]
    flat = ais.flatten_positions(documents)
    rows = {r.MMSI: r for r in flat.collect()}
    assert len(rows) == 3 and flat.schema == schemas.AIS
    assert (rows["230"].LON, rows["230"].LAT, rows["230"].VesselType) == (24.5, 60.1, 70)
    assert rows["230"].BaseDateTime == at(0).replace(microsecond=123000)
    assert (rows["231"].LON, rows["231"].LAT, rows["231"].Draft, rows["231"].BaseDateTime) == (24.5, None, 4.5, at(0))
    assert rows[None].BaseDateTime is None and rows[None].VesselName is None
    assert ais.incomplete_positions(flat).count() == 1


def test_ports_csv_by_header_name(spark, tmp_path):
    names = schemas.PORTS.names
    (tmp_path / "a.csv").write_text(",".join(names) + '\n1,"Port ""X"", North",Y,10.5,-70.25,Large' + "," * 11 + "\n")
    turned = ["longitude", "latitude", "port_name", "PORT_INDEX", "extra", "tide_range_m"]
    (tmp_path / "b.csv").write_text(",".join(turned) + "\n-71.5,11.5,Second,2.0,?,high\n")
    (tmp_path / "notes.txt").write_text("no ports")
    rows = {r.port_index: r for r in ports.read_ports(spark, str(tmp_path)).collect()}
    assert (rows[1].port_name, rows[1].country, rows[1].latitude, rows[1].longitude) == ('Port "X", North', "Y", 10.5, -70.25)
    assert (rows[2].latitude, rows[2].longitude, rows[2].country, rows[2].tide_range_m) == (11.5, -71.5, None, None)
    assert [(r.port_name, r.tide_range_m) for r in ports.bad_ports(spark, str(tmp_path)).collect()] == [("Second", "high")]
    assert ports.read_ports(spark, str(tmp_path / "a.csv"), infer=True).schema["latitude"].dataType.typeName() == "double"
    (tmp_path / "none").mkdir()
    assert ports.read_ports(spark, str(tmp_path / "none")).count() == 0


def hourly(zone, times, variables, value):
    return {
        "zone_name": zone,
        "latitude": 1.0,
        "longitude": 2.0,
        "hourly": {"time": times, **{v: [value + i for i in range(len(times))] for v in variables}},
    }


def test_weather_documents(spark, tmp_path):
    times = ["2024-01-01T00:00", "2024-01-01T01:00"]
    waves = [hourly("z1", times, schemas.WAVE_VARIABLES, 1.0), hourly("z2", times, schemas.WAVE_VARIABLES, 5.0)]
    winds = [hourly("z1", list(reversed(times)), schemas.WIND_VARIABLES, 10.0)]
    (tmp_path / "waves").mkdir()
    (tmp_path / "winds").mkdir()
    (tmp_path / "waves" / "w.json").write_text("\n".join(map(json.dumps, waves)) + '\n{"zone_name": "z3", "hourly"\n')
    (tmp_path / "winds" / "w.json").write_text("\n".join(map(json.dumps, winds)))
    df = weather.load_weather(spark, str(tmp_path / "waves"), str(tmp_path / "winds"))
    assert df.schema.names == schemas.WEATHER.names
    rows = {(r.zone_name, r.timestamp_utc): r for r in df.collect()}
    assert sorted(rows) == [("z1", at(0)), ("z1", at(1))]  # no wind for z2, no waves for z3
    assert rows["z1", at(0)].wind_speed_10m_kmh == 11.0 and rows["z1", at(1)].wave_height_m == 2.0
    assert [r.value[:18] for r in weather.broken_documents(spark, str(tmp_path / "waves")).collect()] == ['{"zone_name": "z3"']


def test_overlapping_polls_give_the_newest_value_once(spark, tmp_path):
    times = ["2024-01-01T00:00", "2024-01-01T01:00", "2024-01-01T02:00"]
    for name, variables in (("waves", schemas.WAVE_VARIABLES), ("winds", schemas.WIND_VARIABLES)):
        (tmp_path / name).mkdir()
        for n, (value, hours) in enumerate(((5.0, times[:2]), (1.0, times[1:]))):
            file = tmp_path / name / f"{9 - n}.json"
            file.write_text(json.dumps(hourly("z1", hours, variables, value)))
            os.utime(file, (1_700_000_000 + n * 60,) * 2)
    df = weather.load_weather(spark, str(tmp_path / "waves"), str(tmp_path / "winds"))
    rows = {r.timestamp_utc: (r.wave_height_m, r.wind_speed_10m_kmh) for r in df.collect()}
    assert rows == {at(0): (5.0, 5.0), at(1): (1.0, 1.0), at(2): (2.0, 2.0)} and df.count() == 3


def test_publish_replaces_and_prunes_days(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(i, at(i * 12)) for i in range(6)], "i int, ts timestamp")
    tables.publish(df.limit(1), path, date_of="ts")
    stored = tables.publish(df, path, date_of="ts")
    assert stored.count() == 6 and len(list((tmp_path / "t").glob("ts_day=*"))) == 3
    one = stored.filter(F.col("ts_day") == F.lit("2024-01-02").cast("date"))
    assert one.count() == 2
    assert "PartitionFilters: [isnotnull(ts_day" in one._jdf.queryExecution().executedPlan().toString()


def test_append_keeps_both_copies(spark, tmp_path):
    path = str(tmp_path / "bronze")
    day = raw(spark, [("a", 0, 1.0, 2.0)])
    tables.append(day, path)
    tables.append(day, path)
    assert spark.read.parquet(path).count() == 2


def test_catalog(spark, tmp_path):
    df = tables.publish(spark.createDataFrame([("a", 1)], "Name string, n int"), str(tmp_path / "Gold" / "ships"))
    tables.register(spark, "gold_t", "ships", str(tmp_path / "Gold" / "ships"), df)
    catalog = tables.schema_catalog(spark, "gold_t")
    assert sorted((r.column_name.lower(), r.data_type, r.ordinal) for r in catalog.collect()) == [("n", "int", 2), ("name", "string", 1)]
    line = tables.schema_text(catalog, "gold_t").first().line
    assert line.lower() == "- gold_t.ships: name (string), n (int)"
    assert sorted(r.name for r in tables.allowed_names(catalog, "gold_t").collect()) == ["gold_t.ships", "ships"]
    assert tables.table_or_empty(spark, "gold_t.ships", df.schema).count() == 1
    assert tables.table_or_empty(spark, "gold_t.none", df.schema).count() == 0


def test_records(spark):
    df = spark.createDataFrame([("1", None, at(1.5))], "k string, v double, t timestamp")
    value = tables.to_records(df, {"k": "mmsi", "v": "lat", "t": "ts"}).first().value
    assert json.loads(value) == {"mmsi": "1", "lat": None, "ts": "2024-01-01 01:30:00"}
    half = df.withColumn("t", F.col("t") + F.expr("interval 120 milliseconds"))
    nested = {"k": "mmsi", "place": {"v": "lat", "t": "ts"}, "none": {"v": "lat"}}
    assert json.loads(tables.to_records(half, nested).first().value) == {
        "mmsi": "1",
        "place": {"lat": None, "ts": "2024-01-01 01:30:00.120000"},
        "none": None,
    }
