"""Checks, grade and type-2 history."""

import pytest
from pyspark.sql import functions as F

from conftest import at
from tidewatch.operators import history, quality


def test_range_is_inclusive_and_ignores_nulls(spark):
    df = spark.createDataFrame([(-90.0,), (90.0,), (None,), (90.5,)], "x double")
    assert [r.x for r in quality.check_range(df, "x", -90, 90).collect()] == [90.5]
    assert quality.check_range(df, "x", lo=0).count() == 1
    with pytest.raises(ValueError):
        quality.check_range(df, "x")


def test_unique_ignores_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "x int")
    assert [tuple(r) for r in quality.check_unique(df, "x").collect()] == [(1, 2)]


def test_foreign_key(spark):
    child = spark.createDataFrame([(1,), (None,), (3,), (3,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert [r.k for r in quality.check_fk(child, "k", parent, "id").collect()] == [3, 3]


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([], (0, 0, 0, None, 0)),
        ([("a", 1), ("a", 1)], (2, 1, 0, 0.0, 1)),
        ([("a", None), ("b", 1)], (2, 0, 1, 50.0, 2)),
        ([("a", 1), ("b", 1)], (2, 0, 0, 0.0, 3)),
        ([(None, 1), ("b", 1)], (2, 1, 0, 0.0, 1)),
    ],
)
def test_grade(spark, rows, expected):
    df = spark.createDataFrame(rows, "k string, v int")
    assert tuple(quality.quality_score(df, "k", ["v"]).first()) == expected


def test_suite_reports_each_check(spark):
    tables = {
        "child": spark.createDataFrame([(1, 5.0), (None, -1.0), (9, 2.0), (9, 2.0)], "k int, v double"),
        "parent": spark.createDataFrame([(1,), (1,), (2,)], "k int"),
    }
    suite = [
        quality.Check("child", "k", "not_null"),
        quality.Check("child", "k", "relationships", parent="parent", parent_column="k"),
        quality.Check("child", "v", "accepted_range", lo=0),
        quality.Check("parent", "k", "unique"),
        quality.Check("parent", "k", "not_null"),
    ]
    got = {(r.table_name, r.column_name, r.check_name): (r.failures, r.status) for r in quality.run_checks(tables, suite).collect()}
    assert got == {
        ("child", "k", "not_null"): (1, "fail"),
        ("child", "k", "relationships"): (2, "fail"),
        ("child", "v", "accepted_range"): (1, "fail"),
        ("parent", "k", "unique"): (1, "fail"),
        ("parent", "k", "not_null"): (0, "pass"),
    }


def test_gold_suite_is_complete():
    kinds = [c.kind for c in quality.GOLD_SUITE]
    assert len(kinds) == 47 and kinds.count("relationships") == 4 and kinds.count("unique") == 5


def snapshot(spark, rows):
    return spark.createDataFrame(rows, "mmsi string, vessel_name string, vessel_type_code int")


def stamp(hours):
    return F.lit(at(hours))


def test_history_of_changes(spark):
    first = history.first_snapshot(
        snapshot(spark, [("renamed", "A", 1), ("same", "B", 2), ("gone", "C", 3), ("filled", "D", None)]), as_of=stamp(0)
    )
    incoming = snapshot(spark, [("renamed", "A2", 1), ("same", "B", 2), ("new", "E", 5), ("filled", "D", 4)])
    merged = history.scd2_merge(first, incoming, as_of=stamp(1))
    versions = {}
    for r in merged.collect():
        versions.setdefault(r.mmsi, []).append((r.valid_from, r.valid_to))
    assert sorted(versions["renamed"]) == [(at(0), at(1)), (at(1), None)]
    assert versions["same"] == [(at(0), None)]
    assert versions["gone"] == [(at(0), at(1))]
    assert versions["new"] == [(at(1), None)]
    assert len(versions["filled"]) == 2
    assert merged.select("version_id").distinct().count() == merged.count()

    again = history.scd2_merge(merged, incoming, as_of=stamp(2))
    assert sorted(map(str, again.collect())) == sorted(map(str, merged.collect()))
    open_per_key = again.filter("valid_to is null").groupBy("mmsi").count()
    assert open_per_key.filter("count > 1").count() == 0

    back = history.scd2_merge(again, incoming.unionByName(snapshot(spark, [("gone", "C", 3)])), as_of=stamp(3))
    assert back.filter("mmsi = 'gone'").count() == 2
