"""Registered queries: training sets, metrics and models (ML-*)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import labels, parity_round
from tidewatch.operators import features, metrics, models
from tidewatch.plans.oracles import check_sql
from tidewatch.plans.queries_serving import PREDICTED, predicted
from tidewatch.plans.registry import query, warehouse
from tidewatch.session import fresh_path

_EXPERIMENTS: dict[tuple[str, str, str], models.Experiment] = {}


def _once(spark, sf_dir: str, name: str, run: Callable[[], models.Experiment]) -> models.Experiment:
    """A fit is shared by the queries that look at it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _EXPERIMENTS:
        _EXPERIMENTS[key] = run()
    return _EXPERIMENTS[key]


def _tables(spark, sf_dir, *names: str) -> list[DataFrame]:
    w = warehouse(spark, sf_dir)
    return [w.table(n) for n in names]


def _delay(spark, sf_dir) -> models.Experiment:
    calls, fact = _tables(spark, sf_dir, "fct_port_calls", "fct_vessel_positions")
    return _once(spark, sf_dir, "delay", lambda: models.delay_experiment(calls, fact))


def _duration(spark, sf_dir) -> models.Experiment:
    inputs = _tables(spark, sf_dir, "fct_port_calls", "dim_vessels", "dim_ports")
    return _once(spark, sf_dir, "duration", lambda: models.duration_experiment(*inputs))


def _outliers(spark, sf_dir) -> models.Experiment:
    (fact,) = _tables(spark, sf_dir, "fct_vessel_positions")
    return _once(spark, sf_dir, "outliers", lambda: models.outlier_experiment(fact))


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Means depend on the order of addition in their last digits."""
    return df.withColumns({c: parity_round(F.col(c), digits) for c in columns})


# Checks that go by another way than the package: lists per vessel, windows over ports, one sub-select per looked-up value.
_STEPS = {
    "stats": """select distinct port_key, avg(duration_hours) over port as avg_port_duration, count(*) over port as port_call_count
 from fpc window port as (partition by port_key)""",
    "voyage": f"""select vessel_key, vessel_type_code, list_avg(speeds) as avg_sog, list_stddev_samp(speeds) as sog_variability,
 list_max(legs) as max_leg_distance, len(hours) as position_count, list_avg(hours) as avg_hour,
 len(list_filter(gaps, lambda g: g > {features.LONG_GAP_MIN})) as n_gaps_over_1h
 from (select vessel_key, vessel_type_code, list(sog) as speeds, list(distance_nm) as legs, list(time_gap_minutes) as gaps,
 list(date_part('hour', position_ts)) as hours from fct group by all)""",
    "delay": f"""select known.*, call.* exclude (caller) from (
 select port_key, arrival_ts, duration_hours, avg(duration_hours) over port as avg_port_duration, count(*) over port as port_call_count,
 vessel_key as caller, cast(duration_hours > {labels.EXTENDED_STAY_HOURS} as int) as is_delayed from fpc window port as (partition by port_key)) call,
 lateral (select * from voyage where vessel_key = caller and avg_sog is not null) known where duration_hours is not null""",
}
_MEANS = ["avg_sog", "sog_variability", "avg_hour", "avg_port_duration"]


def _replace(columns: list[str]) -> str:
    return "replace (" + ", ".join(f"round({c}, 6) as {c}" for c in columns) + ")"


@query("ml1_port_stats", check_sql(f"select * {_replace(['avg_port_duration'])} from stats", **_STEPS))
def _(spark, sf_dir):
    (calls,) = _tables(spark, sf_dir, "fct_port_calls")
    return _rounded(features.port_stats(calls), "avg_port_duration")


@query("ml2_vessel_voyage", check_sql(f"select * {_replace(_MEANS[:3])} from voyage", **_STEPS))
def _(spark, sf_dir):
    (fact,) = _tables(spark, sf_dir, "fct_vessel_positions")
    return _rounded(features.vessel_voyage(fact), *_MEANS[:3])


def _delay_set(spark, sf_dir) -> DataFrame:
    return features.delay_features(*_tables(spark, sf_dir, "fct_port_calls", "fct_vessel_positions"), identity=True)


@query("ml3_delay_features", check_sql(f"select * exclude (arrival_ts) {_replace(_MEANS)} from delay", **_STEPS))
def _(spark, sf_dir):
    return _rounded(_delay_set(spark, sf_dir).drop("arrival_ts"), *_MEANS)


_LOOKED_UP = [
    *[(c, c, "dv", "vessel_key") for c in ("vessel_type_code", "length_m", "width_m", "draft_m")],
    *[(c, n, "dp", "port_key") for c, n in (("channel_depth_m",) * 2, ("harbor_size_rank",) * 2, ("latitude", "port_lat"), ("longitude", "port_lon"))],
]
_DURATION = (
    "select vessel_key, port_key, duration_hours, "
    + ", ".join(f"(select {column} from {dim} where {dim}.{key} = fpc.{key}) as {name}" for column, name, dim, key in _LOOKED_UP)
    + f" from fpc where sign(duration_hours) = 1 and not duration_hours >= {features.LONGEST_STAY_HOURS}"
)


@query("ml4_duration_features", check_sql(_DURATION))
def _(spark, sf_dir):
    return features.duration_features(*_tables(spark, sf_dir, "fct_port_calls", "dim_vessels", "dim_ports"))


_LEGS = f"""select * exclude (over), coalesce(over, 0) as is_anomaly_proxy from (
 select vessel_key, position_ts, date_part('hour', position_ts) as hour_of_day, sog, distance_nm, time_gap_minutes, vessel_type_code,
 cast(time_gap_minutes > {labels.BLACKOUT_MIN} as int) as over from fct) where time_gap_minutes + distance_nm is not null"""


@query("ml5_transition_features", check_sql(_LEGS))
def _(spark, sf_dir):
    return features.transition_features(*_tables(spark, sf_dir, "fct_vessel_positions"))


@query(
    "ml6_impute_zero",
    check_sql(
        "select * replace (coalesce(vessel_type_code, 0) as vessel_type_code, coalesce(sog, 0) as sog) from legs", legs=_LEGS
    ),
)
def _(spark, sf_dir):
    legs = features.transition_features(*_tables(spark, sf_dir, "fct_vessel_positions"))
    return features.impute_zero(legs, features.TRANSITION_FEATURES)


@query(
    "ml7_split",
    check_sql(
        """select vessel_key, port_key, arrival_ts, vessel_type_code, is_delayed,
 row_number() over (partition by is_delayed order by md5(concat_ws('|', coalesce(vessel_key, ''), port_key, epoch_us(arrival_ts),
 coalesce(cast(vessel_type_code as varchar), '')))) <= ceil(0.25 * count(*) over (partition by is_delayed)) as is_test from delay""",
        **_STEPS,
    ),
)
def _(spark, sf_dir):
    parts = features.split(_delay_set(spark, sf_dir), models.CALL_KEY, "is_delayed")
    return parts.select(*models.CALL_KEY, "is_delayed", "is_test")


@query(
    "ml7_split_plain",
    check_sql(
        """select vessel_key, position_ts, row_number() over (order by md5(concat_ws('|', coalesce(vessel_key, ''),
 epoch_us(position_ts)))) <= ceil(0.25 * count(*) over ()) as is_test from legs""",
        legs=_LEGS,
    ),
)
def _(spark, sf_dir):
    legs = features.transition_features(*_tables(spark, sf_dir, "fct_vessel_positions"))
    return features.split(legs, models.LEG_KEY).select(*models.LEG_KEY, "is_test")


@query(
    "ml8_class_balance",
    check_sql(
        """select n as n_rows, round(r, 6) as rate, round(greatest(r, 1 - r), 6) as baseline_accuracy,
 round((1 - r) / greatest(r, 0.01), 6) as positive_weight from (select count(*) as n, avg(is_delayed) as r from delay)""",
        **_STEPS,
    ),
)
def _(spark, sf_dir):
    balance = features.class_balance(_delay_set(spark, sf_dir), "is_delayed")
    return _rounded(balance, "rate", "baseline_accuracy", "positive_weight")


_IS_TEST = """row_number() over ({by} order by md5(concat_ws('|', coalesce(vessel_key, ''), port_key, epoch_us(arrival_ts),
 coalesce(cast(vessel_type_code as varchar), '')))) <= ceil(0.25 * count(*) over ({by}))"""
_PROBABLE = "delay_proba BETWEEN 0 AND 1"


# A fit's numbers are no fixed values: these queries return what is determined, and whether the rest is in its range.
@query(
    "ml9_delay_classifier",
    check_sql(
        f"""select vessel_key, port_key, arrival_ts, is_delayed, true as probable, true as decided from (
 select *, {_IS_TEST.format(by="partition by is_delayed")} as is_test from delay) where is_test""",
        **_STEPS,
    ),
)
def _(spark, sf_dir):
    decided = F.col("predicted_delay").isin(0, 1)
    return _delay(spark, sf_dir).tested.select(
        "vessel_key", "port_key", "arrival_ts", "is_delayed", F.expr(_PROBABLE).alias("probable"), decided.alias("decided")
    )


@query("ml10_delay_predictions", check_sql(f"select * exclude (arrival_ts) {_replace(_MEANS)}, true as probable from delay", **_STEPS))
def _(spark, sf_dir):
    path = fresh_path(spark, "vessel_delay_predictions")
    published = models.publish_nonempty(models.delay_predictions(_delay(spark, sf_dir).scored), path)
    return _rounded(published.withColumn("probable", F.expr(_PROBABLE)).drop("delay_proba"), *_MEANS)


@query(
    "ml11_feature_importance",
    "select *, true as in_range, 1.0e0 as total from (values "
    + ", ".join(f"('{c}')" for c in features.DELAY_FEATURES)
    + ") as t(feature)",
)
def _(spark, sf_dir):
    weights = models.feature_importance(spark, _delay(spark, sf_dir).model, features.DELAY_FEATURES)
    total = parity_round(weights.agg(F.sum("importance").alias("s")).scalar(), 6)
    return weights.select("feature", F.col("importance").between(0, 1).alias("in_range"), total.alias("total"))


_GUESSED = {**PREDICTED, "guessed": "select *, case when delay_proba > 0.5 then 1 else 0 end as p from pred"}
_COUNTS = """select count(*) as n, count(*) filter (where y = 1 and p = 1) as tp, count(*) filter (where y = 0 and p = 1) as fp,
 count(*) filter (where y = 1 and p = 0) as fn, count(*) filter (where y = 0 and p = 0) as tn from guessed"""


def _guessed(spark, sf_dir) -> DataFrame:
    return predicted(spark, sf_dir).withColumn("p", F.when(F.col("delay_proba") > 0.5, 1).otherwise(0))


@query(
    "ml12_binary_metrics",
    check_sql(
        """select n, tp, fp, fn, tn, round((tp + tn) / n, 6) as accuracy, round(tp / (tp + fp), 6) as precision,
 round(tp / (tp + fn), 6) as recall, round(2 * tp / (2 * tp + fp + fn), 6) as f1,
 round((select (sum(r) filter (where y = 1) - count(*) filter (where y = 1) * (count(*) filter (where y = 1) + 1) / 2)
 / (count(*) filter (where y = 1) * count(*) filter (where y = 0)) from (
 select y, rank() over (order by delay_proba) + (count(*) over (partition by delay_proba) - 1) / 2 as r from guessed)), 6) as roc_auc,
 round(greatest((tp + fn) / n, 1 - (tp + fn) / n), 6) as baseline_accuracy,
 round((tp + tn) / n - greatest((tp + fn) / n, 1 - (tp + fn) / n), 6) as lift from counts""",
        **_GUESSED,
        counts=_COUNTS,
    ),
)
def _(spark, sf_dir):
    quality = metrics.binary_metrics(_guessed(spark, sf_dir), "y", "p", "delay_proba")
    return _rounded(quality, "accuracy", "precision", "recall", "f1", "roc_auc", "baseline_accuracy", "lift")


@query(
    "ml13_class_report",
    check_sql(
        """select class, round(precision, 3) as precision, round(recall, 3) as recall, round(f1, 3) as f1, support from (
 from per_class union all select 'macro avg', avg(precision), avg(recall), avg(f1), cast(sum(support) as bigint) from per_class
 union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
 sum(f1 * support) / sum(support), cast(sum(support) as bigint) from per_class)""",
        **_GUESSED,
        counts=_COUNTS,
        per_class="""select 'on_time' as class, tn / (tn + fn) as precision, tn / (tn + fp) as recall,
 2 * tn / (2 * tn + fp + fn) as f1, tn + fp as support from counts
 union all select 'delayed', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn from counts""",
    ),
)
def _(spark, sf_dir):
    return metrics.class_report(_guessed(spark, sf_dir), "y", "p")


@query(
    "ml14_duration_regressor",
    check_sql(
        f"""select vessel_key, port_key, arrival_ts, duration_hours, true as finite from (
 select *, {_IS_TEST.format(by="")} as is_test from stays) where is_test""",
        stays=_DURATION.replace("select c.vessel_key,", "select c.vessel_key, c.arrival_ts,"),
    ),
)
def _(spark, sf_dir):
    finite = F.abs("predicted_hours") < float("inf")
    return _duration(spark, sf_dir).tested.select("vessel_key", "port_key", "arrival_ts", "duration_hours", finite.alias("finite"))


@query(
    "ml15_regression_metrics",
    check_sql(
        """select count(*) as n, round(avg(abs(y - p)), 6) as mae, round(sqrt(avg((y - p) * (y - p))), 6) as rmse,
 round(1 - sum((y - p) * (y - p)) / sum((y - m) * (y - m)), 6) as r2, round(avg(abs((y - p) / greatest(y, 0.1))) * 100, 6) as mape,
 round(avg(abs(y - med)), 6) as baseline_mae, round(avg(abs(y - med)) - avg(abs(y - p)), 6) as lift from (
 select duration_hours as y, duration_hours * 0.9e0 + 1e0 as p, avg(duration_hours) over () as m, median(duration_hours) over () as med
 from stays)""",
        stays=_DURATION,
    ),
)
def _(spark, sf_dir):
    stays = features.duration_features(*_tables(spark, sf_dir, "fct_port_calls", "dim_vessels", "dim_ports"))
    guess = stays.withColumn("p", F.col("duration_hours") * F.lit(0.9) + F.lit(1.0))
    baseline = metrics.median(stays, "duration_hours").scalar()
    quality = metrics.regression_metrics(guess, "duration_hours", "p", baseline)
    return _rounded(quality, "mae", "rmse", "r2", "mape", "baseline_mae", "lift")


@query(
    "ml16_standardise",
    check_sql(
        "select vessel_key, position_ts, "
        + ", ".join(
            f"round((coalesce({c}, 0) - avg(coalesce({c}, 0)) over ()) / stddev_pop(coalesce({c}, 0)) over (), 6) as {c}"
            for c in features.TRANSITION_FEATURES
        )
        + " from legs",
        legs=_LEGS,
    ),
)
def _(spark, sf_dir):
    legs = features.transition_features(*_tables(spark, sf_dir, "fct_vessel_positions"))
    ready = features.impute_zero(legs, features.TRANSITION_FEATURES).drop("is_anomaly_proxy")
    return _rounded(features.standardise(ready, features.TRANSITION_FEATURES), *features.TRANSITION_FEATURES)


@query("ml17_isolation_forest", check_sql("select vessel_key, position_ts, true as in_range from legs", legs=_LEGS))
def _(spark, sf_dir):
    in_range = (F.col("iso_score") > 0) & (F.col("iso_score") <= 1)
    return _outliers(spark, sf_dir).scored.select("vessel_key", "position_ts", in_range.alias("in_range"))


@query(
    "ml18_anomaly_scores",
    check_sql("select count(*) as n_legs, true as some, true as within_bound, true as above_the_rest from legs", legs=_LEGS),
)
def _(spark, sf_dir):
    """The flagged share is at most the expected one, and every flagged score is above every other."""
    scored = _outliers(spark, sf_dir).scored
    flagged = models.publish_nonempty(models.anomaly_scores(scored), fresh_path(spark, "ml_anomaly_scores"))
    found = flagged.agg(F.count(F.lit(1)).alias("n"), F.min("ml_risk_score").alias("least"))
    rest = scored.agg(
        F.count(F.lit(1)).alias("n_legs"),
        F.avg("is_anomaly_proxy").alias("rate"),
        F.max(F.when(F.col("iso_anomaly") == 0, F.col("iso_score"))).alias("most"),
    )
    n, least = found.select("n").scalar(), found.select("least").scalar()
    share = F.least(F.col("rate") * 1.5, F.lit(0.1))
    return rest.select(
        "n_legs", (n > 0).alias("some"), (n <= F.ceil(share * F.col("n_legs"))).alias("within_bound"), (least > F.col("most")).alias("above_the_rest")
    )


_MEASURES = {
    "delay_classifier": ["accuracy", "f1", "auc", "baseline"],
    "voyage_regressor": ["mae", "rmse", "r2", "mape", "baseline_mae"],
    "anomaly_detector": ["precision", "recall", "f1", "detected", "total"],
}


@query(
    "ml19_model_summary",
    "select *, 'fitted' as status, cast(null as varchar) as reason, true as known from (values "
    + ", ".join(f"('{model}', '{measure}')" for model, names in _MEASURES.items() for measure in names)
    + ") as t(model, measure)",
)
def _(spark, sf_dir):
    summary = models.model_summary(spark, _delay(spark, sf_dir), _duration(spark, sf_dir), _outliers(spark, sf_dir))
    return summary.select("model", "measure", "status", "reason", F.col("value").isNotNull().alias("known"))
