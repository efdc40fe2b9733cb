"""Values carried forward in time: weather as of a ping, and gaps filled with the last known reading.

Neither a zone nor a vessel meets in one task: time is cut into days, what a
day begins with comes from a small table of one row per zone and day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import planar_degrees
from tidewatch.functions.timing import seconds_between

_DAY = 86_400
# A cell is a little wider than the radius, as in the geofence.
_CELL_MARGIN = 1.001


def _day(ts: str) -> Column:
    return F.floor(F.unix_seconds(ts) / _DAY)


def nearest_zone(pings: DataFrame, zones: DataFrame, radius_deg: float) -> DataFrame:
    """Pings with ``zone_name``: the nearest zone within the radius (ties by name), null if there is none.

    Every grid cell knows the zones that can reach it as one list, so a ping is
    joined to one row at most and pings are not shuffled if that table is small.
    A ping without a place has no zone; zones without a place reach nothing.
    """
    size = radius_deg * _CELL_MARGIN
    around = F.array(*[F.lit(step) for step in (-1, 0, 1)])
    reach = (
        zones.filter("latitude IS NOT NULL AND longitude IS NOT NULL AND zone_name IS NOT NULL")
        .select("zone_name", "latitude", "longitude")
        .distinct()
        .withColumn("_dx", F.explode(around))
        .withColumn("_dy", F.explode(around))
        .groupBy((F.floor(F.col("latitude") / size) + F.col("_dx")).alias("_x"), (F.floor(F.col("longitude") / size) + F.col("_dy")).alias("_y"))
        .agg(F.collect_list(F.struct("zone_name", "latitude", "longitude")).alias("_zones"))
    )
    placed = pings.withColumns({"_x": F.floor(F.col("latitude") / size), "_y": F.floor(F.col("longitude") / size)})
    joined = placed.join(reach, ["_x", "_y"], "left")
    far = F.transform("_zones", lambda z: F.struct(planar_degrees(F.col("latitude"), F.col("longitude"), z["latitude"], z["longitude"]).alias("d"), z["zone_name"].alias("zone_name")))
    near = F.array_min(F.filter(far, lambda z: z["d"] < radius_deg))
    return joined.withColumn("zone_name", near["zone_name"]).drop("_x", "_y", "_zones")


def readings_by_day(weather: DataFrame, columns: list[str], max_age_hours: int) -> DataFrame:
    """(zone_name, day, readings): the readings of a zone's day in order, led by the last one before it if that can still count."""
    reading = F.struct("weather_ts", *columns)
    own = weather.filter("weather_ts IS NOT NULL AND zone_name IS NOT NULL").groupBy("zone_name", _day("weather_ts").alias("day")).agg(F.array_sort(F.collect_set(reading)).alias("own"))
    following = F.lead("day").over(Window.partitionBy("zone_name").orderBy("day"))
    until = F.least(F.coalesce(following, F.col("day") + max_age_hours // 24 + 1), F.col("day") + max_age_hours // 24 + 1)
    carried = own.withColumn("until", until).select("zone_name", F.explode(F.sequence(F.col("day") + 1, F.col("until"))).alias("day"), F.element_at("own", -1).alias("before"))
    both = own.join(carried, ["zone_name", "day"], "full")
    return both.select("zone_name", "day", F.filter(F.concat(F.array("before"), F.coalesce("own", F.array())), lambda r: r.isNotNull()).alias("readings"))


def weather_at_pings(pings: DataFrame, weather: DataFrame, columns: list[str], radius_deg: float = 3.0, max_age_hours: int = 72) -> DataFrame:
    """Pings with the last reading of their nearest zone at or before them: zone_name, weather_ts, the columns.

    Of several readings of one time the largest in all columns counts. All are
    null where no zone is near or its last reading is older than
    ``max_age_hours``. The pings may not have columns of these names. They are joined on (zone, day) with one row, so their
    side of a crowded zone can be split at will (adaptive skew join), and no
    window runs over them. A day's readings of a zone are one list.
    """
    if taken := {"zone_name", "weather_ts", *columns} & set(pings.columns):
        raise ValueError(f"the pings have columns of these names already: {sorted(taken)}")
    days = readings_by_day(weather, columns, max_age_hours).withColumnsRenamed({"day": "_day", "readings": "_readings"})
    zones = weather.select("zone_name", "latitude", "longitude")
    placed = nearest_zone(pings, zones, radius_deg).withColumn("_day", _day("position_ts"))
    joined = placed.join(days, ["zone_name", "_day"], "left")
    joined = joined.withColumn("_past", F.filter("_readings", lambda r: r["weather_ts"] <= F.col("position_ts")))
    joined = joined.withColumn("_last", F.when(F.size("_past") > 0, F.element_at("_past", -1)))
    fresh = F.when(seconds_between(F.col("position_ts"), F.col("_last.weather_ts")) <= max_age_hours * 3600, F.col("_last"))
    joined = joined.withColumn("_last", fresh)
    return joined.select(*[F.col(f"`{c}`") for c in pings.columns], "zone_name", *[F.col(f"_last.{c}").alias(c) for c in ("weather_ts", *columns)])


def fill_forward(df: DataFrame, key: str, ts: str, columns: list[str], max_age_hours: int = 24) -> DataFrame:
    """(key, hour, columns): a row for every hour from a key's first row to its last, each column with its last known value.

    Within an hour the latest known value counts (the larger of equal times);
    a value is carried for ``max_age_hours`` at most. Hours before the first
    known value of a column, and columns that are never known, stay null. Rows
    without a key or a time are left out. Windows run inside a key's day; what
    a day begins with comes from a window over one row per key and day.
    """
    rows = df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(F.col(key).alias("_key"), F.floor(F.unix_seconds(ts) / 3600).alias("_hour"), F.col(ts).alias("_ts"), *columns)
    best = [F.max(F.when(F.col(c).isNotNull(), F.struct("_ts", F.col(c).alias("v")))).alias(f"_{c}") for c in columns]
    hourly = rows.groupBy("_key", "_hour").agg(*best)
    ends = hourly.groupBy("_key").agg(F.min("_hour").alias("low"), F.max("_hour").alias("high"))
    # Days first, then the hours of a day, so that a key of very many hours is not one row's array.
    day = F.explode(F.sequence(F.floor(F.col("low") / 24), F.floor(F.col("high") / 24))).alias("_day")
    grid = ends.select("_key", "low", "high", day).select(
        "_key", "_day", F.explode(F.sequence(F.greatest("low", F.col("_day") * 24), F.least("high", F.col("_day") * 24 + 23))).alias("_hour")
    )
    full = grid.join(hourly, ["_key", "_hour"], "left").select(
        "_key", "_day", "_hour", *[F.when(F.col(f"_{c}").isNotNull(), F.struct(F.col("_hour").alias("h"), F.col(f"_{c}.v").alias("v"))).alias(f"_{c}") for c in columns]
    )
    inside = Window.partitionBy("_key", "_day").orderBy("_hour")
    edges = full.groupBy("_key", "_day").agg(*[F.max_by(f"_{c}", F.when(F.col(f"_{c}").isNotNull(), F.col("_hour"))).alias(f"_{c}") for c in columns])
    before = Window.partitionBy("_key").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select("_key", "_day", *[F.last(f"_{c}", ignorenulls=True).over(before).alias(f"_in_{c}") for c in columns])
    known = full.select("_key", "_day", "_hour", *[F.last(f"_{c}", ignorenulls=True).over(inside).alias(f"_{c}") for c in columns]).join(carried, ["_key", "_day"])

    def value(name: str) -> Column:
        found = F.coalesce(F.col(f"_{name}"), F.col(f"_in_{name}"))
        return F.when(F.col("_hour") - found["h"] <= max_age_hours, found["v"]).alias(name)

    return known.select(F.col("_key").alias(key), F.timestamp_seconds(F.col("_hour") * 3600).alias("hour"), *[value(c) for c in columns])
