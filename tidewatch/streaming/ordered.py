"""Streams that need a vessel's pings in order: gaps and jumps, port calls.

Pings arrive out of order within a delay. Per key a function holds those that
the watermark has not passed, and releases the others in order of time; what a
later ping needs to know of them is a few numbers. So the state of a key is
bounded by the pings within the delay (port calls: and a row per port that it was near). Input are pings without repeats, such as
the table that ``dedup_stream`` appends to.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import hours_between
from tidewatch.operators.anomalies import fct_ais_anomalies
from tidewatch.operators.port_calls import near_ports
from tidewatch.operators.positions import FACT_COLUMNS, position_legs
from tidewatch.session import ship_package

_US = "_tw_us"


def _pack(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(held: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(held).read_all().to_pandas()


def release(held: bytes | None, frames: Iterator[pd.DataFrame], state) -> tuple[pd.DataFrame | None, bytes | None]:
    """(rows that the watermark has passed, in order of time; the others, packed), with a timer set for the first of these."""
    parts = [f for f in ([_unpack(held)] if held else []) + list(frames) if len(f)]
    if not parts:
        return None, None
    rows = pd.concat(parts, ignore_index=True).sort_values(_US, kind="stable", ignore_index=True)
    mark = state.getCurrentWatermarkMs()
    ready = int(np.searchsorted(rows[_US].to_numpy(), mark * 1000, "right"))
    rest = rows.iloc[ready:]
    if not len(rest):
        return rows, None
    state.setTimeoutTimestamp(max(int(rest[_US].iloc[0]) // 1000, mark) + 1)
    return rows.iloc[:ready], _pack(rest)


def _with_micros(pings: DataFrame, delay: str) -> DataFrame:
    """Times travel as numbers, which no time zone of a worker can change."""
    return pings.withWatermark("position_ts", delay).withColumn(_US, F.unix_micros("position_ts"))


def _previous(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Released pings with the one before each; the state keeps the last."""
    ts, lat, lon, held = state.get if state.exists else (None, None, None, None)
    ready, held = release(held, frames, state)
    if ready is not None and len(ready):
        out = ready.drop(columns="position_ts")
        for name, column, before in (("prev_us", _US, ts), ("prev_lat", "latitude", lat), ("prev_lon", "longitude", lon)):
            moved = out[column].shift(1).astype(object)
            moved.iloc[0] = before
            out[name] = moved.where(moved.notna(), None)
        last = out.iloc[-1]
        ts, lat, lon = int(last[_US]), *(None if pd.isna(v) else float(v) for v in (last["latitude"], last["longitude"]))
        out["prev_us"] = out["prev_us"].astype("Int64")
        out[["prev_lat", "prev_lon"]] = out[["prev_lat", "prev_lon"]].astype("float64")
        yield out
    state.update((ts, lat, lon, held))


def legs_stream(pings: DataFrame, delay: str = "1 hour") -> DataFrame:
    """The position fact of a stream of pings without repeats: leg and gap since the vessel's previous ping."""
    ship_package(pings.sparkSession)
    rows = _with_micros(pings.select(*FACT_COLUMNS), delay)
    kept = [f for f in rows.schema.fields if f.name != "position_ts"]
    schema = T.StructType([*kept, *(T.StructField(n, k) for n, k in (("prev_us", T.LongType()), ("prev_lat", T.DoubleType()), ("prev_lon", T.DoubleType())))])
    state = "ts long, lat double, lon double, held binary"
    found = rows.groupBy("mmsi").applyInPandasWithState(_previous, schema, state, "append", "EventTimeTimeout")
    found = found.withColumns({"position_ts": F.timestamp_micros(_US), "prev_ts": F.timestamp_micros("prev_us")})
    return position_legs(found.select(*FACT_COLUMNS, "prev_ts", "prev_lat", "prev_lon"))


def anomaly_stream(pings: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Gaps and jumps as ``fct_ais_anomalies`` finds them, each once the watermark has passed its ping."""
    return fct_ais_anomalies(legs_stream(pings, delay))


_CALL = "mmsi string, port_id int, port_name string, arrival_us long, departure_us long, arrival_lat double, arrival_lon double"


#: No time, or no number of a port.
_NONE = -(2**63)
#: Vessels are dealt to so many states; a task works on the vessels of a state together.
_STATES = 512


def stop_events(sog: np.ndarray, before: float | None, seen: bool, slow_kts: float, starts: np.ndarray | None = None) -> np.ndarray:
    """1 where a stop begins, -1 where one ends, of speeds in order after a ping with speed ``before`` (nan: unknown).

    ``starts`` says where the speeds of another vessel or port begin, which has no ping before.
    """
    previous = np.concatenate([[np.nan if before is None else before], sog[:-1]])
    first = np.zeros(len(sog), bool) if starts is None else starts.copy()
    first[:1] |= not seen
    arrives = (sog < slow_kts) & (first | (previous >= slow_kts))
    departs = (sog >= slow_kts) & (first | (previous < slow_kts))
    return arrives.astype(int) - departs.astype(int)


def _calls(slow_kts: float):
    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        """Calls that begin (without an end) and calls that end, of some vessels in all ports; the state has a row per vessel and port."""
        held, known = state.get if state.exists else (None, None)
        ready, held = release(held, (f.drop(columns=["part", "position_ts"]) for f in frames), state)
        if ready is not None and len(ready):
            calls, known = _next_calls(_unpack(known) if known else None, ready, slow_kts)
            known = _pack(known)
            if len(calls):
                yield calls
        state.update((held, known))

    return step


def _next_calls(known: pd.DataFrame | None, ready: pd.DataFrame, slow_kts: float) -> tuple[pd.DataFrame, pd.DataFrame]:
    """(the calls that ``_CALL`` describes, what is known then) of pings in order of time.

    ``known`` has the last speed of every vessel in every port it was near, and where and since when
    its last call there lies (``_NONE``: there was none).
    """
    every = ready.assign(old=False) if known is None else pd.concat([known.assign(old=True), ready.assign(old=False)], ignore_index=True)
    vessel = pd.factorize(every["mmsi"], use_na_sentinel=False)[0]
    # The sort is stable: what is known of a vessel and port comes before its pings, which are in order.
    order = np.lexsort((vessel, every["port_id"].to_numpy()))
    every, vessel = every.iloc[order].reset_index(drop=True), vessel[order]
    port, old, at, sog = (every[c].to_numpy() for c in ("port_id", "old", _US, "sog"))
    first = np.ones(len(every), bool)
    first[1:] = (vessel[1:] != vessel[:-1]) | (port[1:] != port[:-1])
    last = np.append(first[1:], True)

    arrives = ~old & (stop_events(sog.astype(float), None, True, slow_kts, first) == 1)
    begins = np.flatnonzero(arrives | (old & (at != _NONE)))
    group = np.cumsum(first)
    follows = np.append(group[begins[1:]] == group[begins[:-1]], False)[: len(begins)]
    until = pd.array(np.append(at[begins[1:]], _NONE)[: len(begins)], "Int64")
    until[~follows] = pd.NA
    told = arrives[begins] | follows
    found = every.iloc[begins[told]]
    numbers = pd.array(found["port_id"].to_numpy(), "Int64")
    numbers[found["port_id"].to_numpy() == _NONE] = pd.NA
    calls = pd.DataFrame(
        {
            "mmsi": found["mmsi"].to_numpy(),
            "port_id": numbers.astype("Int32"),
            "port_name": found["port_name"].to_numpy(),
            "arrival_us": found[_US].to_numpy(),
            "departure_us": until[told],
            "arrival_lat": found["latitude"].to_numpy(),
            "arrival_lon": found["longitude"].to_numpy(),
        }
    )
    # The last speed of each, and its last call, if it has one.
    latest = np.full(len(every), -1)
    latest[begins] = begins
    latest = np.maximum.accumulate(latest)[last]
    some = latest >= np.flatnonzero(first)
    after = every.iloc[np.where(some, latest, np.flatnonzero(last))].reset_index(drop=True)
    after["sog"] = sog[last]
    after.loc[~some, _US] = _NONE
    return calls, after[["mmsi", "port_id", "port_name", "latitude", "longitude", "sog", _US]]


def port_call_stream(pings: DataFrame, ports: DataFrame, delay: str = "1 hour", slow_kts: float = 1.0, radius_deg: float = 0.1) -> DataFrame:
    """Port calls of a stream of pings without repeats; a call is a row when it begins and another when it ends.

    Pings meet the ports of their grid cell (``near_ports``), then each (vessel,
    port) goes through the states of ``port_events``. A vessel is near many ports, so
    vessels are dealt to ``_STATES`` groups that keep a row per vessel and port and work on their pings
    together. ``settled_calls`` of the appended rows are the calls as of now, those of ``port_calls``.
    """
    ship_package(pings.sparkSession)
    near = near_ports(pings.withWatermark("position_ts", delay), ports, radius_deg)
    number = F.coalesce(F.col("port_id").cast("int").cast("long"), F.lit(_NONE)).alias("port_id")
    part = F.pmod(F.xxhash64("mmsi"), F.lit(_STATES)).alias("part")
    rows = near.select(part, "mmsi", number, "port_name", "position_ts", "latitude", "longitude", "sog", F.unix_micros("position_ts").alias(_US))
    calls = rows.groupBy("part").applyInPandasWithState(_calls(slow_kts), _CALL, "held binary, known binary", "append", "EventTimeTimeout")
    return calls.select(
        "mmsi",
        "port_id",
        "port_name",
        F.timestamp_micros("arrival_us").alias("arrival_ts"),
        F.timestamp_micros("departure_us").alias("departure_ts"),
        "arrival_lat",
        "arrival_lon",
    )


def settled_calls(appended: DataFrame) -> DataFrame:
    """One row per call: its end where that is known by now."""
    keys = ["mmsi", "port_id", "arrival_ts"]
    found = appended.groupBy(*keys).agg(*[F.max(c).alias(c) for c in ("port_name", "departure_ts", "arrival_lat", "arrival_lon")])
    hours = hours_between(F.col("departure_ts"), F.col("arrival_ts")).alias("duration_hours")
    return found.select("mmsi", "port_id", "port_name", "arrival_ts", "departure_ts", "arrival_lat", "arrival_lon", hours)


def clock_row(spark: SparkSession, schema: T.StructType, at) -> DataFrame:
    """A ping of no vessel with a time: it moves the watermark on where nothing else arrives.

    It lies at the south pole, far from any port, because a ping without a place
    can be filtered out before the watermark sees it.
    """
    values = {"mmsi": "clock", "position_ts": at, "latitude": -90.0, "longitude": -180.0}
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    return spark.createDataFrame([tuple(values.get(f.name) for f in schema.fields)], nullable)
