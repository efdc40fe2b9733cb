"""Training sets and their preparation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.labels import BLACKOUT_MIN, EXTENDED_STAY_HOURS

# Model inputs in order.
DELAY_FEATURES = [
    "vessel_type_code",
    "avg_sog",
    "sog_variability",
    "max_leg_distance",
    "position_count",
    "avg_hour",
    "n_gaps_over_1h",
    "avg_port_duration",
    "port_call_count",
]
DURATION_FEATURES = [
    "vessel_type_code",
    "length_m",
    "width_m",
    "draft_m",
    "channel_depth_m",
    "harbor_size_rank",
    "port_lat",
    "port_lon",
]
TRANSITION_FEATURES = ["time_gap_minutes", "distance_nm", "sog", "vessel_type_code", "hour_of_day"]

LONGEST_STAY_HOURS = 720
LONG_GAP_MIN = 60


def port_stats(calls: DataFrame) -> DataFrame:
    return calls.groupBy("port_key").agg(
        F.avg("duration_hours").alias("avg_port_duration"), F.count(F.lit(1)).alias("port_call_count")
    )


def vessel_voyage(fact: DataFrame) -> DataFrame:
    """Movement profile per vessel and reported type."""
    return fact.groupBy("vessel_key", "vessel_type_code").agg(
        F.avg("sog").alias("avg_sog"),
        F.stddev_samp("sog").alias("sog_variability"),
        F.max("distance_nm").alias("max_leg_distance"),
        F.count(F.lit(1)).alias("position_count"),
        F.avg(F.hour("position_ts")).alias("avg_hour"),
        F.count_if(F.col("time_gap_minutes") > LONG_GAP_MIN).alias("n_gaps_over_1h"),
    )


def delay_features(calls: DataFrame, fact: DataFrame, identity: bool = False) -> DataFrame:
    """Finished calls with the profile of their vessel and port; the label is a stay over 48 hours.

    Profiles are per vessel and type but joined by vessel, so a vessel that
    reported two types gives two rows per call. ``identity`` keeps ``arrival_ts``,
    which tells calls of one vessel in one port apart.
    """
    finished = calls.filter(F.col("duration_hours").isNotNull()).select(
        "vessel_key", "port_key", "arrival_ts", "duration_hours"
    )
    return (
        finished.join(vessel_voyage(fact), "vessel_key", "left")
        .join(port_stats(calls), "port_key", "left")
        .filter(F.col("avg_sog").isNotNull())
        .select(
            "vessel_key",
            "port_key",
            *(["arrival_ts"] if identity else []),
            "duration_hours",
            *DELAY_FEATURES,
            F.when(F.col("duration_hours") > EXTENDED_STAY_HOURS, 1).otherwise(0).alias("is_delayed"),
        )
    )


def duration_features(calls: DataFrame, vessels: DataFrame, ports: DataFrame, identity: bool = False) -> DataFrame:
    """Finished calls under 30 days with vessel and port attributes."""
    hours = F.col("duration_hours")
    finished = calls.filter((hours > 0) & (hours < LONGEST_STAY_HOURS)).select(
        "vessel_key", "port_key", "arrival_ts", "duration_hours"
    )
    vessel_part = vessels.select("vessel_key", "vessel_type_code", "length_m", "width_m", "draft_m")
    port_part = ports.select(
        "port_key",
        "channel_depth_m",
        "harbor_size_rank",
        F.col("latitude").alias("port_lat"),
        F.col("longitude").alias("port_lon"),
    )
    return (
        finished.join(port_part, "port_key", "left")
        .join(vessel_part, "vessel_key", "left")
        .select(
            "vessel_key",
            "port_key",
            *(["arrival_ts"] if identity else []),
            "duration_hours",
            *DURATION_FEATURES,
        )
    )


def transition_features(fact: DataFrame) -> DataFrame:
    """Legs for the outlier detector, with long gaps as a stand-in label."""
    return fact.filter(F.col("time_gap_minutes").isNotNull() & F.col("distance_nm").isNotNull()).select(
        "vessel_key",
        "position_ts",
        "time_gap_minutes",
        "distance_nm",
        "sog",
        "vessel_type_code",
        F.hour("position_ts").cast("long").alias("hour_of_day"),
        F.when(F.col("time_gap_minutes") > BLACKOUT_MIN, 1).otherwise(0).alias("is_anomaly_proxy"),
    )


def impute_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.fill(0, subset=columns)


def _key_text(df: DataFrame, key: list[str]) -> Column:
    def text(name: str) -> Column:
        kind = df.schema[name].dataType
        column = F.unix_micros(name) if isinstance(kind, T.TimestampType) else F.col(name)
        return F.coalesce(column.cast("string"), F.lit(""))

    return F.concat_ws("|", *[text(k) for k in key])


def split(df: DataFrame, key: list[str], label: str | None = None, test_size: float = 0.25) -> DataFrame:
    """Add ``is_test``: exactly ``ceil(test_size * n)`` rows, per label where one is given.

    Rows are ranked by the md5 of ``key`` (which must identify a row), so the
    split is the same on any partitioning. The rank is found without sorting a
    label in one task: hashes are counted by prefix (65,536 prefixes at most),
    the prefix in which the cut falls is found from the running count, all other
    prefixes are wholly test or wholly train, and only the rows of that one
    prefix are ranked. The cuts are one row per label, so they are broadcast; a
    label has few values.
    """
    group = F.lit("all") if label is None else F.coalesce(F.col(label).cast("string"), F.lit(""))
    work = df.withColumn("_group", group).withColumn("_hash", F.md5(_key_text(df, key)))
    work = work.withColumn("_prefix", F.substring("_hash", 1, 4))

    in_order = Window.partitionBy("_group").orderBy("_prefix")
    whole = Window.partitionBy("_group")
    quota = F.ceil(F.lit(test_size) * F.sum("_n").over(whole))
    upto = F.sum("_n").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    cuts = (
        work.groupBy("_group", "_prefix")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_group", F.col("_prefix").alias("_cut"), (quota - (upto - F.col("_n"))).alias("_take"), "_n")
        .filter((F.col("_take") > 0) & (F.col("_take") <= F.col("_n")))
        .drop("_n")
    )
    if label is None:
        placed = work.withColumns({"_cut": cuts.select("_cut").scalar(), "_take": cuts.select("_take").scalar()})
    else:
        placed = work.join(F.broadcast(cuts), "_group", "left")
    decided = placed.filter(~F.col("_prefix").eqNullSafe(F.col("_cut"))).withColumn(
        "is_test", F.coalesce(F.col("_prefix") < F.col("_cut"), F.lit(False))
    )
    ranked = F.row_number().over(Window.partitionBy("_group", "_prefix").orderBy("_hash", *key))
    at_cut = placed.filter(F.col("_prefix") == F.col("_cut")).withColumn("is_test", ranked <= F.col("_take"))
    return decided.unionByName(at_cut).select(*df.columns, "is_test")


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Positive rate, accuracy of always guessing the majority, and the weight of a positive row."""
    rate = F.col("rate")
    return df.agg(F.avg(label).alias("rate"), F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        "rate",
        F.greatest(rate, 1 - rate).alias("baseline_accuracy"),
        ((1 - rate) / F.greatest(rate, F.lit(0.01))).alias("positive_weight"),
    )


def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each column minus its mean over its population deviation; a constant column is divided by 1."""
    stats = []
    for i, c in enumerate(columns):
        deviation = F.stddev_pop(c)
        stats += [
            F.avg(c).alias(f"mean_{i}"),
            F.when(deviation == 0, F.lit(1.0)).otherwise(deviation).alias(f"deviation_{i}"),
        ]
    known = F.col("_stats")
    return (
        df.withColumn("_stats", df.agg(F.struct(*stats).alias("s")).scalar())
        .withColumns({c: (F.col(c) - known[f"mean_{i}"]) / known[f"deviation_{i}"] for i, c in enumerate(columns)})
        .drop("_stats")
    )
