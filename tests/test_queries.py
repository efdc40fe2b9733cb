"""Every registered query against its check SQL, on the smallest driver tables."""

import importlib.util
import os

import duckdb
import pytest

from conftest import TINY

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(_ROOT, "__spark_entry__.py"))
entry_module = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(entry_module)

QUERIES, CHECKS = entry_module.queries(), entry_module.oracle_sql()
TEXT = {name for name in QUERIES if name.startswith("op") or name == "pipeline"}


@pytest.fixture(scope="module")
def checker():
    con = duckdb.connect()
    for name in os.listdir(TINY):
        con.execute(f"create view {name.removesuffix('.parquet')} as from '{TINY}/{name}'")
    yield con
    con.close()


def normal(rows):
    return sorted(rows, key=lambda r: [(v is None, str(type(v)), v) for v in r])


@pytest.mark.parametrize("name", sorted(set(CHECKS) - TEXT))
def test_query_matches_check(spark, checker, name):
    got = QUERIES[name](spark, TINY)
    want = checker.execute(CHECKS[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    order = [columns.index(c) for c in sorted(columns)]
    expected = [tuple(r[i] for i in order) for r in want.fetchall()]
    assert normal(tuple(r) for r in got.select(sorted(columns)).collect()) == normal(expected)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS) - TEXT))
def test_unchecked_query_has_rows(spark, name):
    assert QUERIES[name](spark, TINY).count() > 0


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() == 850 and "risk_score" in df.columns


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)
