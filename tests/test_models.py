"""Features, split, metrics, boosted models and the isolation forest."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import at, plan_of
from tidewatch.operators import features, isolation, metrics, models, serving


def test_profiles_fan_out_over_types(spark):
    calls = spark.createDataFrame(
        [("a", 1, at(0), 50.0), ("a", 1, at(60), None), ("z", 1, at(0), 5.0)],
        "vessel_key string, port_key int, arrival_ts timestamp, duration_hours double",
    )
    fact = spark.createDataFrame(
        [("a", 70, 1.0, 2.0, at(1), 61.0), ("a", 80, 3.0, None, at(2), None)],
        "vessel_key string, vessel_type_code int, sog double, distance_nm double, position_ts timestamp, time_gap_minutes double",
    )
    rows = features.delay_features(calls, fact).orderBy("vessel_type_code").collect()
    assert [(r.vessel_type_code, r.n_gaps_over_1h, r.is_delayed, r.port_call_count) for r in rows] == [(70, 1, 1, 3), (80, 0, 1, 3)]
    assert rows[0].sog_variability is None and rows[0].avg_port_duration == 27.5


@pytest.mark.parametrize("label", [None, "y"])
@pytest.mark.parametrize("n", [1, 7, 1000])
def test_split_is_exact_and_stable(spark, n, label):
    df = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(n)], "id int, y int")
    parts = features.split(df, ["id"], label)
    groups = {r[0]: (r.n, r.t) for r in parts.groupBy("y" if label else F.lit("all")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert sum(total for total, _ in groups.values()) == n
    assert all(t == -(-total // 4) for total, t in groups.values())
    again = features.split(df.repartition(5), ["id"], label)
    assert sorted(parts.collect()) == sorted(again.collect())


def test_standardise_handles_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert sorted(map(tuple, features.standardise(df, ["a", "b"]).collect())) == [(-1.0, 0.0), (1.0, 0.0)]


def test_class_balance_floor(spark):
    row = features.class_balance(spark.createDataFrame([(0,)] * 4, "y int"), "y").first()
    assert (row.rate, row.baseline_accuracy, row.positive_weight) == (0.0, 1.0, 100.0)


def brute_auc(rows):
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    return sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg)) if pos and neg else 0.0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_auc_equals_pair_count(spark, seed):
    rng = random.Random(seed)
    rows = [(int(rng.random() < 0.4), rng.choice([0.0, 1.0, 0.25, rng.random(), rng.random() / 1e6])) for _ in range(300)]
    got = metrics.roc_auc(spark.createDataFrame(rows, "y int, s double"), "y", "s").first().auc
    assert got == pytest.approx(brute_auc(rows), abs=1e-12)


def test_metrics_without_positives(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.2)], "y int, p int, s double")
    row = metrics.binary_metrics(df, "y", "p", "s").first()
    assert (row.accuracy, row.precision, row.recall, row.f1, row.roc_auc) == (1.0, 0.0, 0.0, 0.0, 0.0)


def test_median_and_regression(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (9.0, 8.0), (4.0, None)], "y double, p double")
    assert metrics.median(df, "y").first().median == 3.0
    row = metrics.regression_metrics(df.filter("p is not null"), "y", "p", F.lit(2.0)).first()
    assert row.mae == pytest.approx(2 / 3) and row.baseline_mae == pytest.approx(8 / 3)
    assert row.r2 == pytest.approx(1 - 2 / 38) and row.mape == pytest.approx((1 + 0 + 1 / 9) / 3 * 100)


def test_auc_of_scores_that_pile_up(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 1), 1 - rng.random() * 10 ** -rng.randint(0, 12)) for _ in range(300)] + [(1, 1.0), (0, 1.0), (0, 0.0)]
    got = metrics.roc_auc(spark.createDataFrame(rows, "y int, s double"), "y", "s").first().auc
    assert got == pytest.approx(brute_auc(rows), abs=1e-12)


def planted(spark, n=600):
    rng = random.Random(5)
    rows = [(i, rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(n)] + [(n + i, 9.0 + i, -9.0) for i in range(3)]
    return spark.createDataFrame(rows, "id int, a double, b double")


@pytest.mark.parametrize("rows", [117, 997, 199_997])
def test_planted_outliers_rank_first(spark, rows):
    """One rule at every size: a tree has 256 rows, or all of a smaller table, and the norm says so."""
    df = planted(spark, rows)
    forest = isolation.iforest_fit(df, ["a", "b"], ["id"], trees=100, sample=256)
    assert forest.feature.shape[0] == 100
    psi = min(256, rows + 3)
    assert min(forest.samples) >= 0.9 * psi and max(forest.samples) <= psi
    by_hand = 2 * (math.log(psi - 1) + 0.5772156649015329) - 2 * (psi - 1) / psi
    assert isolation.path_norm(forest) == pytest.approx(by_hand, rel=1e-2)
    if rows < 256:
        assert set(forest.samples) == {psi} and isolation.path_norm(forest) == pytest.approx(by_hand)
    scored = isolation.iforest_score(df, ["a", "b"], forest)
    top = [r.id for r in scored.orderBy(F.desc("iso_score")).limit(8).collect()]
    assert len({rows, rows + 1, rows + 2} & set(top)) == 3
    assert scored.filter("iso_score <= 0 or iso_score > 1").count() == 0
    flagged = isolation.flag_outliers(scored, 0.01).agg(F.sum("iso_anomaly")).first()[0]
    assert 0 < flagged <= 0.01 * (rows + 3) + 1
    assert isolation.flag_outliers(scored, 0.0).agg(F.sum("iso_anomaly")).first()[0] == 0


def call_tables(spark, n=60):
    calls = spark.createDataFrame(
        [(str(i % 9), i % 4, at(i), float(20 + (i % 9) * 10), 0) for i in range(n)],
        "vessel_key string, port_key int, arrival_ts timestamp, duration_hours double, is_extended_stay int",
    )
    fact = spark.createDataFrame(
        [(str(i % 9), 70 + i % 9, float(i % 9), float(i % 5), at(i), float(30 * (i % 9)), 1.0, 2.0) for i in range(200)],
        "vessel_key string, vessel_type_code int, sog double, distance_nm double, position_ts timestamp,"
        " time_gap_minutes double, latitude double, longitude double",
    )
    return calls, fact


def test_delay_experiment_learns(spark, tmp_path):
    calls, fact = call_tables(spark)
    run = models.delay_experiment(calls, fact, maxIter=5)
    assert run.measures["accuracy"] == 1.0 and run.measures["auc"] == 1.0
    assert run.scored.filter("delay_proba < 0 or delay_proba > 1").count() == 0
    published = models.delay_predictions(run.scored)
    assert serving.delayed_vessels(published).count() == min(20, published.filter("delay_proba > 0.5").count())
    assert len(published.columns) == 14 and published.count() == 60
    weights = models.feature_importance(spark, run.model, features.DELAY_FEATURES).collect()
    assert sum(w.importance for w in weights) == pytest.approx(1.0) and len(weights) == 9
    assert models.publish_nonempty(published, str(tmp_path / "p")).count() == 60
    assert models.publish_nonempty(published.filter("false"), str(tmp_path / "none")) is None
    assert not (tmp_path / "none").exists()


def test_training_set_is_stored_once(spark):
    """Of the tables of an experiment one stays, without the imputed copies; they are null nowhere."""
    from pathlib import Path

    from tidewatch.session import shared_dir

    kept = Path(shared_dir(spark).removeprefix("file:"))
    calls, fact = call_tables(spark)
    no_types = fact.withColumn("vessel_type_code", F.when(F.col("vessel_key") != "3", F.col("vessel_type_code")))
    before = set(kept.iterdir())
    run = models.delay_experiment(calls, no_types, maxIter=2)
    made = {p.name.rsplit("-", 1)[0]: p for p in set(kept.iterdir()) - before}
    assert "training" in made and "delay-features" not in made
    stored = spark.read.parquet(str(made["training"]))
    assert stored.count() == 60 and not [c for c in stored.columns if c.startswith("ready_")]
    assert run.scored.count() == 60 and run.scored.where("vessel_type_code is null").count() > 0


def test_duration_experiment_beats_the_median(spark):
    calls, _ = call_tables(spark)
    vessels = spark.createDataFrame([(str(i), 70 + i, 10.0 * i, 1.0, 1.0) for i in range(9)],
        "vessel_key string, vessel_type_code int, length_m double, width_m double, draft_m double")
    ports = spark.createDataFrame([(i, 9.0, 1, 1.0, 2.0) for i in range(4)],
        "port_key int, channel_depth_m double, harbor_size_rank int, latitude double, longitude double")
    run = models.duration_experiment(calls, vessels, ports, maxIter=5)
    assert run.measures["mae"] < run.measures["baseline_mae"]


def test_small_inputs_are_skipped(spark):
    calls, fact = call_tables(spark, 8)
    skipped = [
        models.delay_experiment(calls, fact),
        models.outlier_experiment(fact.limit(50)),
        models.outlier_experiment(fact.withColumn("time_gap_minutes", F.lit(5.0))),
    ]
    assert all(e.skipped for e in skipped)
    rows = models.model_summary(spark, *skipped).collect()
    assert [r.status for r in rows] == ["skipped"] * 3


def test_predictions_keep_nulls_that_the_model_fills(spark):
    calls, fact = call_tables(spark)
    unknown = fact.withColumn("vessel_type_code", F.when(F.col("vessel_key") == "3", None).otherwise(F.col("vessel_type_code")))
    published = models.delay_predictions(models.delay_experiment(calls, unknown, maxIter=2).scored)
    assert published.filter("vessel_type_code is null").count() == calls.filter("vessel_key = '3'").count() > 0
    assert published.filter("vessel_type_code = 0").count() == 0 and not [c for c in published.columns if c.startswith("ready_")]


def test_a_skipped_model_reports_how_many_rows_it_had(spark):
    calls, fact = call_tables(spark, n=4)
    run = models.delay_experiment(calls, fact)
    assert run.skipped.startswith("4 rows") and models.model_summary(spark, run).first().reason == run.skipped


@pytest.mark.parametrize("label", ["y", None])
def test_split_joins_no_rows_by_shuffle_on_the_label(spark, label):
    df = spark.createDataFrame([(i, i % 2) for i in range(400)], "i int, y int")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = features.split(df, ["i"], label)
        plan = plan_of(parts)
        assert parts.filter("is_test").count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "NestedLoop" not in plan and "SortMergeJoin" not in plan
