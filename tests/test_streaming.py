"""Streams over several micro-batches equal the batch result."""

import json

from pyspark.sql import functions as F

from conftest import at
from test_positions import raw
from tidewatch import schemas
from tidewatch.operators import dimensions, positions, serving
from tidewatch.sources import ais
from tidewatch.streaming.ingest import ingest_stream
from tidewatch.streaming.live import live_tick_stream


def test_ingest_equals_batch_and_resumes(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()

    def poll(name, ids):
        features = [
            {"geometry": {"coordinates": [1.0, 2.0 + i]}, "properties": {"mmsi": i, "timestamp": 1704067200000 + i}} for i in ids
        ] + [{"properties": {"sog": 1.0}}]
        (landing / f"{name}.json").write_text(json.dumps({"features": features}, indent=1))

    args = [str(landing), str(tmp_path / "bronze"), str(tmp_path / "cp")]
    for n in range(3):
        poll(f"p{n}", range(n, n + 3))
    (landing / "broken.json").write_text("{")
    ingest_stream(spark, *args, once=True, files_per_batch=1).awaitTermination()
    poll("late", [50, 0])
    ingest_stream(spark, *args, once=True).awaitTermination()

    got = spark.read.schema(schemas.AIS).parquet(args[1])
    batch = ais.flatten_positions(ais.read_position_documents(spark, str(landing))).filter("MMSI is not null")
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect())) and got.count() == 11

    aside = [str(tmp_path / "aside"), str(tmp_path / "cp2")]
    ingest_stream(spark, str(landing), *aside, once=True, incomplete=True).awaitTermination()
    assert spark.read.parquet(aside[0]).count() == 4

    broken = [str(tmp_path / "broken"), str(tmp_path / "cp3")]
    ingest_stream(spark, str(landing), *broken, once=True, broken=True).awaitTermination()
    assert [r.text for r in spark.read.parquet(broken[0]).collect()] == ["{"]


def test_live_tick_equals_batch(spark, tmp_path):
    rows = [(str(i % 7), i * 1.5 if i % 3 else 60 - i, 10.0 + i / 100, 20.0 + i) for i in range(40)]
    pings = positions.stage_positions(raw(spark, rows))
    source = str(tmp_path / "pings")
    for n in range(3):
        pings.filter(F.pmod(F.xxhash64("mmsi", "position_ts"), F.lit(3)) == n).coalesce(1).write.mode("append").parquet(source)
    fact = positions.fct_vessel_positions(pings)
    vessels = dimensions.dim_vessels(pings)
    stream = spark.readStream.schema(pings.schema).option("maxFilesPerTrigger", 1).parquet(source)
    target = str(tmp_path / "ticks")
    live_tick_stream(stream, lambda: vessels, lambda: fact.limit(4), target, str(tmp_path / "cp"), once=True, n=5).awaitTermination()
    ticks = spark.read.parquet(target)
    assert ticks.select("tick").distinct().count() == 3
    last = ticks.filter(F.col("tick") == ticks.agg(F.max("tick")).scalar())
    columns = ["vessel_key", "position_ts", "latitude", "sog", "vessel_name"]
    batch = serving.latest_positions(fact, vessels, 5)
    assert sorted(map(str, last.select(columns).collect())) == sorted(map(str, batch.select(columns).collect()))
    assert {(r.total_vessels, r.anomaly_count) for r in last.collect()} == {(7, 4)}
    assert last.filter("emitted_at is null").count() == 0


def test_totals_follow_tables_that_grow(spark, tmp_path):
    pings = positions.stage_positions(raw(spark, [("a", 0, 1.0, 2.0), ("b", 1, 3.0, 4.0)]))
    source, kept, target = (str(tmp_path / n) for n in ("pings", "vessels", "ticks"))
    vessels = dimensions.dim_vessels(pings)
    args = [target, str(tmp_path / "cp")]
    for grown in (1, 3):
        for _ in range(grown):
            vessels.write.mode("append").parquet(kept)
        pings.write.mode("append").parquet(source)
        stream = spark.readStream.schema(pings.schema).parquet(source)
        again = lambda: spark.read.parquet(kept)
        live_tick_stream(stream, again, again, *args, once=True).awaitTermination()
    totals = {r.tick: r.total_vessels for r in spark.read.parquet(target).select("tick", "total_vessels").distinct().collect()}
    assert sorted(totals.values()) == [2, 8]
