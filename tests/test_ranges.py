"""Whole-table ranks, rolling sums, daily sketches and build changes: against plain Python, on ties and hot keys."""

import random
from collections import Counter, defaultdict
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import at, plan_of
from tidewatch.operators import changes, ranks, rolling, sketches

ROWS = "a int, b string, id long"


def ranked_rows(seed, n=600):
    """A third of all rows share one value; some values and ids are null."""
    rng = random.Random(seed)
    return [(5 if i % 3 == 0 else rng.choice([None, *range(40)]), rng.choice([None, "x", "y"]), i) for i in range(n)]


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("order", [["a"], ["b", "a"], ["a", "id"]])
def test_ranks_by_brute_force(spark, order, descending):
    rows = ranked_rows(3)
    got = ranks.global_ranks(spark.createDataFrame(rows, ROWS), order, descending, parts=7, tiles=11).collect()
    places = {"a": 0, "b": 1, "id": 2}

    def place(row):
        flat = []
        for c in order:
            v = row[places[c]]
            number = v if not isinstance(v, str) else ord(v)
            flat.append((v is None, 0 if v is None else -number if descending else number))
        return tuple(flat)

    every = sorted(place(r) for r in rows)
    first = {}
    for i, key in enumerate(every):
        first.setdefault(key, i + 1)
    dense = {key: i + 1 for i, key in enumerate(sorted(first))}
    size, larger = divmod(len(rows), 11)
    tile_of = [t + 1 for t in range(11) for _ in range(size + (t < larger))]
    want = {r[2]: (first[place(r)], dense[place(r)], tile_of[first[place(r)] - 1]) for r in rows}
    assert len(got) == len(rows) and {r.id: (r["rank"], r.dense_rank, r.tile) for r in got} == want


def test_ranks_of_few_rows_and_none(spark):
    rows = spark.createDataFrame([(1, None, 1), (1, None, 1), (2, None, 2)], ROWS)
    got = ranks.global_ranks(rows, ["a"], tiles=5).select("a", "rank", "dense_rank", "tile").collect()
    assert sorted(map(tuple, got)) == [(1, 1, 1, 1), (1, 1, 1, 1), (2, 3, 2, 3)]
    assert ranks.global_ranks(rows.limit(0), ["a"]).count() == 0
    with pytest.raises(ValueError):
        ranks.global_ranks(rows.withColumnRenamed("b", "Rank"), ["a"])


def test_ranks_never_meet_in_one_task(spark):
    plan = plan_of(ranks.global_ranks(spark.createDataFrame(ranked_rows(4), ROWS), ["a"]))
    assert "SinglePartition" not in plan and "Window" in plan


PINGS = "mmsi string, ts timestamp, v long, w decimal(12,2)"


def hot_pings(seed):
    """Over a third of the pings on one vessel, some at one time, some exactly a day apart, some days apart, some before 1970."""
    rng = random.Random(seed)
    rows = [("hot", at(i / 10), rng.choice([None, 1, 5]), None) for i in range(400)]
    rows += [(f"v{rng.randrange(4)}", at(rng.choice([rng.uniform(0, 60), rng.uniform(300, 340), rng.randrange(0, 80), -600_000 + rng.randrange(30)])), rng.randrange(9), rng.choice([None, Decimal(1)])) for _ in range(500)]
    rows += [(None, at(1), 3, Decimal(1)), ("v1", None, 3, Decimal(1)), rows[450], rows[450]]
    return rows


@pytest.mark.parametrize("hours, bucket", [(24, 1), (24, 24), (6, 2), (24, 8)])
def test_rolling_sums_by_brute_force(spark, hours, bucket):
    rows = hot_pings(5)
    got = rolling.rolling_sums(spark.createDataFrame(rows, PINGS), ["mmsi"], "ts", {"v_sum": "v", "w_sum": "w"}, hours, bucket)
    assert got.columns == ["mmsi", "ts", "v", "w", "v_sum", "w_sum"]
    of = defaultdict(list)
    for r in rows:
        of[r[0]].append(r)

    def total(row, column):
        if row[0] is None or row[1] is None:
            return None
        inside = [r[column] for r in of[row[0]] if r[1] is not None and timedelta(0) <= row[1] - r[1] <= timedelta(hours=hours)]
        known = [v for v in inside if v is not None]
        return sum(known) if known else None

    want = Counter((r[0], r[1], r[2], total(r, 2), total(r, 3)) for r in rows)
    assert Counter((r.mmsi, r.ts, r.v, r.v_sum, r.w_sum) for r in got.collect()) == want


def test_rolling_sums_cut_a_vessel_by_time(spark):
    plan = plan_of(rolling.rolling_sums(spark.createDataFrame(hot_pings(6), PINGS), ["mmsi"], "ts", {"v_sum": "v"}))
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # Rows are only ever in windows of (vessel, bucket); the one by vessel runs over a row per bucket.
    alone = [line for line in windows if "_own" not in line and "_old" not in line]
    assert len(windows) == 3 and len(alone) == 1 and "_mid" in alone[0]
    with pytest.raises(ValueError):
        rolling.rolling_sums(spark.createDataFrame([], PINGS), ["mmsi"], "ts", {"x": "v"}, 24, 7)
    assert rolling.rolling_sums(spark.createDataFrame([], PINGS), ["mmsi"], "ts", {"x": "v"}).count() == 0


FACTS = "ts timestamp, vessel string, speed double"


def sketch_rows(seed, n=20_000):
    rng = random.Random(seed)
    rows = [(at(rng.choice([5.0, rng.uniform(0, 24 * 20)])), f"v{rng.randrange(9000)}", rng.choice([None, rng.lognormvariate(1, 1)])) for _ in range(n)]
    return rows + [(None, "v1", 1.0), (at(24 * 30), None, None), (at(24 * 30), None, None)]


def test_merged_sketches_are_near_the_exact_figures(spark):
    rows = sketch_rows(1)
    days = sketches.daily_sketches(spark.createDataFrame(rows, FACTS), "ts", "vessel", "speed")
    whole = sketches.estimates(sketches.merge_days(days), {"q10": 0.1, "q50": 0.5, "q99": 0.99}).first()
    vessels = {r[1] for r in rows if r[0] and r[1]}
    speeds = sorted(r[2] for r in rows if r[0] and r[2] is not None)
    assert whole.n_rows == len(rows) - 1 and abs(whole.n_distinct - len(vessels)) <= 0.025 * len(vessels)
    for q, found in ((0.1, whole.q10), (0.5, whole.q50), (0.99, whole.q99)):
        assert abs(sum(s <= found for s in speeds) / len(speeds) - q) <= 0.02
    blank = sketches.estimates(days, {"q50": 0.5}).orderBy(F.desc("day")).first()
    assert (blank.n_rows, blank.n_distinct, blank.q50) == (2, 0, None)


def test_every_order_of_merging_keeps_the_bound(spark):
    rows = sketch_rows(2, 6000)
    days = sketches.daily_sketches(spark.createDataFrame(rows, FACTS), "ts", "vessel", "speed").cache()
    by_two = sketches.merge_days(sketches.merge_days(days, {"day": F.expr("date_add(day, -(day(day) % 2))")}))
    at_once, turned = sketches.merge_days(days), sketches.merge_days(days.orderBy(F.desc("day")))
    vessels, speeds = {r[1] for r in rows if r[0] and r[1]}, sorted(r[2] for r in rows if r[0] and r[2] is not None)
    for merged in (by_two, at_once, turned):
        found = sketches.estimates(merged, {"q50": 0.5}).first()
        assert found.n_rows == len(rows) - 1 and abs(found.n_distinct - len(vessels)) <= 0.025 * len(vessels)
        assert abs(sum(s <= found.q50 for s in speeds) / len(speeds) - 0.5) <= 0.02
    days.unpersist()


def test_last_days_of_sketches(spark):
    rows = [(at(24 * d + 1), v, 1.0) for d, v in ((0, "a"), (0, "b"), (1, "a"), (3, "c"), (9, "d"))]
    days = sketches.daily_sketches(spark.createDataFrame(rows, FACTS), "ts", "vessel", "speed")
    got = sketches.estimates(sketches.last_days(days, 3), {"q50": 0.5}).orderBy("day").collect()
    assert [(r.day.day, r.n_rows, r.n_distinct, r.q50) for r in got] == [(1, 2, 2, 1.0), (2, 3, 2, 1.0), (4, 2, 2, 1.0), (10, 1, 1, 1.0)]
    assert sketches.last_days(sketches.daily_sketches(spark.createDataFrame([], FACTS), "ts", "vessel", "speed"), 3).count() == 0


def test_changes_by_multiplicity(spark):
    rng = random.Random(8)
    before = [(rng.choice([None, *range(30)]), rng.choice([None, "x", "y"]), 7) for _ in range(300)]
    after = [*before[20:], (1, "new", None), (1, "new", None), *[before[40]] * 500]
    got = changes.build_changes(spark.createDataFrame(before, ROWS), spark.createDataFrame(after, ROWS).select("id", "b", "a"), ["a"], ranges=16)
    want = Counter(after)
    want.subtract(Counter(before))
    assert {(r.a, r.b, r.id): r.change for r in got.collect()} == {k: n for k, n in want.items() if n}


def test_equal_builds_are_read_once(spark):
    rows = [(i % 9, None if i % 2 else "x", i) for i in range(100)]
    one, two = spark.createDataFrame(rows, ROWS), spark.createDataFrame(rows[::-1], ROWS)
    got = changes.build_changes(one, two, ["id"])
    assert got.count() == 0 and "Exchange" not in plan_of(got) and "Aggregate" not in plan_of(got)
    assert changes.differing_ranges(changes.range_hashes(one, ["id"], 8), changes.range_hashes(two.filter("id <> 3"), ["id"], 8)) != []
    # A null moved from one column to the next changes the hash.
    left, right = spark.createDataFrame([(None, "x")], "p string, q string"), spark.createDataFrame([("x", None)], "p string, q string")
    assert {tuple(r) for r in changes.build_changes(left, right, ["p"]).collect()} == {(None, "x", -1), ("x", None, 1)}
    with pytest.raises(ValueError):
        changes.build_changes(one, two.drop("b"), ["id"])
