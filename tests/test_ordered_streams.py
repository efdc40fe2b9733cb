"""Streams with state equal the batch results, whatever order the pings come in, across restarts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import at
from test_positions import raw
from tidewatch.operators import anomalies, port_calls, positions
from tidewatch.streaming import ordered, silver

PORTS = "port_index int, port_name string, latitude double, longitude double"


def some_pings(spark, seed, vessels=6, many=240):
    """Cleaned pings with repeats, nulls, jumps and silences, and the hour at which each arrives (up to two hours late)."""
    rng, rows = random.Random(seed), []
    for i in range(many):
        hour = i * 0.15 + (40 if i > many // 2 else 0)
        vessel = str(rng.randrange(vessels) // 2 * 2 if rng.random() < 0.3 else rng.randrange(vessels))
        rows.append((vessel, hour, 10 + rng.choice([0.0, 0.01, 0.02, 0.5]), 20 + rng.choice([0.0, 0.01, 7.0])))
    rows += [rows[k] for k in range(0, many, 9)]
    clean = positions.clean_positions(positions.valid_positions(raw(spark, rows)))
    # Speeds, lengths of repeats and arrival are functions of the row.
    mixed = F.pmod(F.xxhash64("mmsi", "position_ts"), F.lit(5))
    clean = clean.withColumn("sog", F.when(mixed < 2, 0.2).when(mixed < 4, 7.0)).withColumn("length_m", F.rand(seed) * 50)
    return clean.withColumn("arrives", F.unix_seconds("position_ts") + F.pmod(F.xxhash64("mmsi", "latitude", "longitude"), F.lit(7200)))


def played(spark, tmp_path, clean, job, parts=3, end=True):
    """What the job appends when the rows arrive in parts, the stream being stopped after each; and the streams."""
    clean = spark.createDataFrame(clean.collect(), clean.schema)
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    low, high = clean.agg(F.min("arrives"), F.max("arrives")).first()
    part = F.floor((F.col("arrives") - low) * parts / (high - low + 1))
    schema = clean.drop("arrives").schema
    frames = [clean.where(part == n).drop("arrives") for n in range(parts)]
    if end:
        frames.append(ordered.clock_row(spark, schema, at(10_000)))
    streams = []
    for frame in frames:
        frame.write.mode("append").parquet(source)
        stream = silver.append_stream(job(spark.readStream.schema(schema).parquet(source)), target, checkpoint, once=True)
        stream.awaitTermination()
        streams.append(stream)
    return spark.read.parquet(target), streams, clean.drop("arrives")


def same(got, want):
    return sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("parts", [1, 4])
def test_dedup_stream_equals_batch(spark, tmp_path, parts):
    got, streams, clean = played(spark, tmp_path, some_pings(spark, 1), lambda p: silver.dedup_stream(p, "3 hours"), parts)
    want = positions.dedup_positions(clean)
    assert same(got, want) and want.count() < clean.count()
    sizes = silver.state_rows(streams[-1])
    assert sizes[-1] == 1  # the clock alone; all pings have left the state
    assert silver.late_rows(streams[-1]) == 0
    assert same(silver.dedup_stream(clean), want)


def test_state_of_dedup_shrinks_and_late_rows_are_counted(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    clean = positions.clean_positions(positions.valid_positions(raw(spark, [("a", h / 10, 1.0, 2.0) for h in range(50)])))
    sizes, late = [], 0
    for rows in (clean, ordered.clock_row(spark, clean.schema, at(50)), clean.limit(7)):
        rows.write.mode("append").parquet(source)
        stream = silver.append_stream(silver.dedup_stream(spark.readStream.schema(clean.schema).parquet(source), "1 hour"), target, checkpoint, once=True)
        stream.awaitTermination()
        sizes.append(silver.state_rows(stream)[-1])
        late += silver.late_rows(stream)
    assert sizes[0] > 5 and sizes[1:] == [1, 1] and spark.read.parquet(target).count() == 50
    # Repeats are merged before the state is asked, here ten of a second each at most.
    assert 1 <= late <= 7


@pytest.mark.parametrize("parts", [1, 5])
def test_anomaly_stream_equals_batch(spark, tmp_path, parts):
    pings = some_pings(spark, 2)
    staged = positions.dedup_positions(pings)
    got, streams, clean = played(spark, tmp_path, staged, lambda p: ordered.anomaly_stream(p, "3 hours"), parts)
    want = anomalies.fct_ais_anomalies(positions.fct_vessel_positions(clean))
    assert want.count() > 20 and same(got, want)
    # One row per vessel (and the clock) stays.
    assert silver.state_rows(streams[-1])[-1] == clean.select("mmsi").distinct().count() + 1


def test_late_pings_are_left_out_of_legs(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    early = positions.stage_positions(raw(spark, [("a", 0, 1.0, 2.0), ("a", 10, 1.5, 2.0)]))
    late = positions.stage_positions(raw(spark, [("a", 5, 1.2, 2.0)]))
    dropped = 0
    for rows in (early, late, ordered.clock_row(spark, early.schema, at(500))):
        rows.write.mode("append").parquet(source)
        stream = silver.append_stream(ordered.legs_stream(spark.readStream.schema(early.schema).parquet(source), "1 hour"), target, checkpoint, once=True)
        stream.awaitTermination()
        dropped += silver.late_rows(stream)
    got = {r.position_ts: r.time_gap_minutes for r in spark.read.parquet(target).collect()}
    assert got == {at(0): None, at(10): 600.0} and dropped == 1


def test_port_call_stream_equals_batch(spark, tmp_path):
    fences = spark.createDataFrame([(1, "One", 10.0, 20.0), (2, None, 10.02, 20.01), (3, "Far", 60.0, 60.0), (4, "None", None, None)], PORTS)
    staged = positions.dedup_positions(some_pings(spark, 3))
    got, streams, clean = played(spark, tmp_path, staged, lambda p: ordered.port_call_stream(p, fences, "3 hours"), 4)
    want = port_calls.port_calls(port_calls.stops(port_calls.near_ports(clean, fences)))
    assert want.count() > 20 and want.where("departure_ts is null").count() > 2
    assert same(ordered.settled_calls(got), want) and got.count() > want.count()


def test_port_calls_of_a_state_for_many_vessels(spark, tmp_path, monkeypatch):
    """Two states hold all vessels and ports, null ones too, and give the calls of a batch."""
    monkeypatch.setattr(ordered, "_STATES", 2)
    fences = spark.createDataFrame([(1, "One", 10.0, 20.0), (None, "No number", 10.02, 20.01), (3, "Near", 10.01, 19.99)], PORTS)
    named = F.when(F.col("mmsi") != "1", F.col("mmsi"))
    staged = positions.dedup_positions(some_pings(spark, 6).withColumn("mmsi", named))
    got, streams, clean = played(spark, tmp_path, staged, lambda p: ordered.port_call_stream(p, fences, "3 hours"), 4)
    want = port_calls.port_calls(port_calls.stops(port_calls.near_ports(clean, fences)))
    assert want.where("port_id is null").count() > 5 and want.select("mmsi", "port_id").distinct().count() > 4
    assert same(ordered.settled_calls(got), want)
    assert 1 <= silver.state_rows(streams[-1])[-1] <= 2


def test_stop_events_by_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(300):
        sog = rng.choice([0.0, 0.5, 1.0, 9.0, np.nan], rng.integers(1, 8))
        before, seen = rng.choice([0.0, 5.0, np.nan]), bool(rng.integers(2))
        got = ordered.stop_events(sog, None if np.isnan(before) else before, seen, 1.0)
        want, last = [], before
        for i, s in enumerate(sog):
            first = i == 0 and not seen
            want.append(1 if s < 1 and (first or last >= 1) else -1 if s >= 1 and (first or last < 1) else 0)
            last = s
        assert got.tolist() == want


@pytest.mark.parametrize("parts", [1, 4])
def test_voyages_of_a_stream_equal_those_of_a_batch(spark, tmp_path, parts):
    staged = positions.dedup_positions(some_pings(spark, 4))
    got, _, clean = played(spark, tmp_path, staged, lambda p: silver.voyages(p, "2 hours", "3 hours"), parts)
    want = silver.voyages(clean, "2 hours")
    assert same(got, want)
    plain = {}
    for r in sorted(clean.collect(), key=lambda r: (r.mmsi, r.position_ts)):
        runs = plain.setdefault(r.mmsi, [])
        if runs and (r.position_ts - runs[-1][-1]).total_seconds() < 7200:
            runs[-1].append(r.position_ts)
        else:
            runs.append([r.position_ts])
    assert sorted((r.mmsi, r.start_ts, r.end_ts, r.n_pings) for r in want.collect()) == sorted((m, v[0], v[-1], len(v)) for m, runs in plain.items() for v in runs)


def test_voyages_with_late_pings(spark, tmp_path):
    """A ping before the watermark joins its voyage and merges two; one after it joins none."""
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    stage = lambda rows: positions.stage_positions(raw(spark, rows))
    frames = [stage([("a", 0, 1.0, 2.0), ("a", 3, 1.0, 2.0)]), stage([("a", 1.5, 1.0, 2.0)]), stage([("a", 30, 1.0, 2.0)]), stage([("a", 2, 1.0, 2.0)])]
    frames.append(ordered.clock_row(spark, frames[0].schema, at(500)))
    for rows in frames:
        rows.write.mode("append").parquet(source)
        job = silver.voyages(spark.readStream.schema(rows.schema).parquet(source), "2 hours", "4 hours")
        silver.append_stream(job, target, checkpoint, once=True).awaitTermination()
    got = sorted((r.start_ts, r.end_ts, r.n_pings) for r in spark.read.parquet(target).collect())
    assert got == [(at(0), at(3), 3), (at(30), at(30), 1)]


@pytest.mark.parametrize("job", [silver.dedup_stream, ordered.anomaly_stream, silver.voyages])
def test_streams_of_nothing(spark, tmp_path, job):
    staged = positions.stage_positions(raw(spark, [("a", 0, 1.0, 2.0)])).limit(0)
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    staged.write.parquet(source)
    silver.append_stream(job(spark.readStream.schema(staged.schema).parquet(source)), target, checkpoint, once=True).awaitTermination()
    schema = job(spark.readStream.schema(staged.schema).parquet(source)).schema
    assert spark.read.schema(schema).parquet(target).count() == 0
