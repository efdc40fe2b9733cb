"""Geofence, stop detection and port calls."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import hours_between, is_extended_stay, planar_degrees, stay_category, time_key
from tidewatch.operators.neighbours import with_neighbour
from tidewatch.session import delete_path, fresh_path
from tidewatch.sources.tables import PART, publish, publish_in_parts

# A cell is a little wider than the radius, so rounding in the division can
# never put two points closer than the radius more than one cell apart.
_CELL_MARGIN = 1.001

#: So many pings of the vessel before and after one are tried, within this span, before a fence's last ping is looked up.
_TRIED, _SPAN = 3, "week"
#: Stops are few: so much of one vessel's history in one port is a window's work.
STOPS_SPAN = "month"
#: Vessels are worked on in parts of about so many pings, one part after the other.
_PINGS_OF_PART, _PARTS = 2_000_000, 32

_NEAR = ["mmsi", "position_ts", "latitude", "longitude", "sog", "port_id", "port_name", "dist_deg"]


def _cell(degrees: Column, size: float) -> Column:
    return F.floor(degrees / F.lit(size))


def near_ports(positions: DataFrame, ports: DataFrame, radius_deg: float = 0.1, salts: int = 1) -> DataFrame:
    """Pairs of a ping and a port closer than ``radius_deg`` (planar degrees).

    Both sides are cut into cells; the small side, ports, is copied into its
    nine neighbouring cells and joined on equal cells, then the exact distance
    decides. Spark broadcasts the ports if they are under its size threshold
    (then pings are not shuffled) and otherwise shuffles both sides, where the
    adaptive skew join splits a crowded cell. ``salts`` > 1 splits every cell by
    hand as well, at the price of as many copies of the ports.
    """
    return _pairs(positions, ports, radius_deg, salts).select(*_NEAR)


def _pairs(positions: DataFrame, ports: DataFrame, radius_deg: float, salts: int = 1) -> DataFrame:
    """``near_ports`` with all columns of the pings, and of the ports those that start with an underscore."""
    size = radius_deg * _CELL_MARGIN
    around = F.array(*[F.lit(step) for step in (-1, 0, 1)])
    fences = (
        ports.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        .select(
            F.col("port_index").alias("port_id"),
            "port_name",
            F.col("latitude").alias("_port_lat"),
            F.col("longitude").alias("_port_lon"),
            *[c for c in ports.columns if c.startswith("_")],
        )
        .withColumn("_dx", F.explode(around))
        .withColumn("_dy", F.explode(around))
        .withColumn("_cell_x", _cell(F.col("_port_lat"), size) + F.col("_dx"))
        .withColumn("_cell_y", _cell(F.col("_port_lon"), size) + F.col("_dy"))
        .drop("_dx", "_dy")
    )
    pings = positions.withColumn("_cell_x", _cell(F.col("latitude"), size)).withColumn(
        "_cell_y", _cell(F.col("longitude"), size)
    )
    cells = ["_cell_x", "_cell_y"]
    if salts > 1:
        pings = pings.withColumn("_salt", F.pmod(F.xxhash64("mmsi", "position_ts"), F.lit(salts)).cast("int"))
        fences = fences.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        cells.append("_salt")
    distance = planar_degrees(F.col("latitude"), F.col("longitude"), F.col("_port_lat"), F.col("_port_lon"))
    return pings.join(fences, cells, "inner").withColumn("dist_deg", distance).filter(F.col("dist_deg") < radius_deg)


def port_events(near: DataFrame, slow_kts: float = 1.0, bucket: str = "hour") -> DataFrame:
    """Label pings that begin or end a stop inside a fence.

    The comparison is with the last ping inside the same fence, however old. A
    first ping counts as having been fast before (for an arrival) and slow
    before (for a departure); an unknown earlier speed gives no event.
    """
    seen = with_neighbour(near, ["mmsi", "port_id"], "position_ts", ["sog"], prefix="prev_", bucket=bucket)
    first = F.col("prev_position_ts").isNull()
    return seen.withColumn("event_type", _event(first, F.col("prev_sog"), slow_kts)).drop("prev_position_ts", "prev_sog")


def _event(first: Column, before: Column, slow_kts: float) -> Column:
    """What a ping with ``sog`` is after one with speed ``before`` in the same fence, or as the ``first`` there."""
    slow = F.col("sog") < slow_kts
    fast = F.col("sog") >= slow_kts
    was_fast = first | (before >= slow_kts)
    was_slow = first | (before < slow_kts)
    return F.when(slow & was_fast, "arrival").when(fast & was_slow, "departure")


def stops(near: DataFrame, slow_kts: float = 1.0, bucket: str = "hour") -> DataFrame:
    """Only the pings with an event."""
    return port_events(near, slow_kts, bucket).filter(F.col("event_type").isNotNull())


def _with_around(pings: DataFrame) -> DataFrame:
    """Pings with ``_around``: place and speed of the vessel's last pings, then places of its next ones, within a span of time."""
    history = Window.partitionBy("mmsi", F.date_trunc(_SPAN, "position_ts")).orderBy("position_ts")
    before = [F.lag(c, k).over(history) for k in range(1, _TRIED + 1) for c in ("latitude", "longitude", "sog")]
    after = [F.lead(c, k).over(history) for k in range(1, _TRIED + 1) for c in ("latitude", "longitude")]
    named = {f"_at_{i}": c for i, c in enumerate([*before, *after])}
    # One column, so that all readers of the pairs need the same ones and share their exchange.
    return pings.withColumns(named).select(*pings.columns, F.array(*named).alias("_around"))


def stops_near(staged: DataFrame, ports: DataFrame, radius_deg: float = 0.1, slow_kts: float = 1.0) -> DataFrame:
    """``stops`` of ``near_ports``, without moving all pairs of a ping and a port.

    The last ping in a fence mostly is one of the vessel's last pings: a ping
    brings those along, and the fence tells them. Only pairs whose fence has none of
    them, and those which no later ping knows in this way, are exchanged and
    looked up by ``port_events``. Ports that share their number share a fence, so their
    pairs are all looked up.
    """
    pings = _with_around(staged.select("mmsi", "position_ts", "latitude", "longitude", "sog"))
    alone = F.count(F.lit(1)).over(Window.partitionBy("port_index")) == 1
    pairs = _pairs(pings, ports.withColumn("_alone", alone), radius_deg)

    def at(i: int) -> Column:
        return F.get("_around", F.lit(i))

    def inside(i: int) -> Column:
        return planar_degrees(at(i), at(i + 1), F.col("_port_lat"), F.col("_port_lon")) < radius_deg

    before, after = range(0, 3 * _TRIED, 3), range(3 * _TRIED, 5 * _TRIED, 2)
    known = F.col("_alone") & reduce(Column.__or__, [F.coalesce(inside(i), F.lit(False)) for i in before])
    told = F.col("_alone") & reduce(Column.__or__, [F.coalesce(inside(i), F.lit(False)) for i in after])
    speed = F.coalesce(*[F.when(inside(i), F.struct(at(i + 2).alias("sog"))) for i in before])["sog"]

    event = _event(F.lit(False), speed, slow_kts)
    found = pairs.filter(known).select(*_NEAR, event.alias("event_type")).filter(F.col("event_type").isNotNull())
    asks = ~known & F.col("sog").isNotNull()
    rest = pairs.filter(asks | ~told).withColumn("_asks", asks)
    # Pairs that only tell others their speed keep little else.
    keys = ("mmsi", "position_ts", "sog", "port_id")
    rest = rest.select(*[F.col(c) if c in keys else F.when(F.col("_asks"), F.col(c)).alias(c) for c in _NEAR], "_asks")
    looked_up = stops(rest, slow_kts, STOPS_SPAN).filter("_asks").drop("_asks")
    return found.unionByName(looked_up)


def port_calls(events: DataFrame, departure: str = "next_arrival", bucket: str = "hour") -> DataFrame:
    """One row per arrival.

    ``next_arrival`` (the behaviour to match) ends a call at the vessel's next
    arrival in the same port; ``next_departure`` ends it at the next departure.
    """
    keys = ["mmsi", "port_id"]
    if departure == "next_arrival":
        candidates, only = events.filter(F.col("event_type") == "arrival"), None
    elif departure == "next_departure":
        candidates = events.filter(F.col("event_type").isNotNull())
        only = F.col("event_type") == "departure"
    else:
        raise ValueError(f"departure must be 'next_arrival' or 'next_departure', not {departure!r}")
    paired = with_neighbour(
        candidates, keys, "position_ts", [], prefix="end_", direction="next", only=only, bucket=bucket
    )
    return paired.filter(F.col("event_type") == "arrival").select(
        *keys,
        "port_name",
        F.col("position_ts").alias("arrival_ts"),
        F.col("end_position_ts").alias("departure_ts"),
        F.col("latitude").alias("arrival_lat"),
        F.col("longitude").alias("arrival_lon"),
        hours_between(F.col("end_position_ts"), F.col("position_ts")).alias("duration_hours"),
    )


def parts_of(staged: DataFrame) -> int:
    """How many parts a stored table of pings is worked on in."""
    return max(1, min(_PARTS, -(-staged.count() // _PINGS_OF_PART)))


def vessel_part(staged: DataFrame, part: int, parts: int) -> DataFrame:
    """The pings of the vessels of one part."""
    return staged.filter(F.pmod(F.xxhash64("mmsi"), F.lit(parts)) == part)


def stage_port_calls(staged: DataFrame, raw_ports: DataFrame, departure: str = "next_arrival") -> DataFrame:
    """Port calls from staged pings.

    The pairs of a ping and a port grow with both tables, so vessels are worked on
    part by part: events are stored, then the calls, and only these stay.
    """
    spark = staged.sparkSession
    pings_at, events_at, calls_at = (fresh_path(spark, n) for n in ("port-pings", "port-events", "port-calls"))
    pings = publish(staged.select("mmsi", "position_ts", "latitude", "longitude", "sog"), pings_at)
    n = parts_of(pings)
    events = publish_in_parts(spark, lambda k: stops_near(vessel_part(pings, k, n), raw_ports), n, events_at)
    delete_path(spark, pings_at)
    one = lambda k: events.filter(F.col(PART) == k).drop(PART)
    calls = publish_in_parts(spark, lambda k: port_calls(one(k), departure, STOPS_SPAN), n, calls_at)
    delete_path(spark, events_at)
    return calls.drop(PART)


def fct_port_calls(calls: DataFrame) -> DataFrame:
    hours = F.col("duration_hours")
    return calls.select(
        F.col("mmsi").alias("vessel_key"),
        F.col("port_id").alias("port_key"),
        "arrival_ts",
        "departure_ts",
        "duration_hours",
        time_key(F.col("arrival_ts")).alias("time_key"),
        "arrival_lat",
        "arrival_lon",
        is_extended_stay(hours).alias("is_extended_stay"),
        stay_category(hours).alias("stay_category"),
    )
