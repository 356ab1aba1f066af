"""Every SQL-checkable query equals its DuckDB oracle on the smoke tables."""

import pytest

import __spark_entry__ as entry
from citypulse.plans.catalog import ORACLES, QUERIES, load_all
from conftest import SMOKE
from oracle import compare, duck

load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    rep = compare(spark, name, QUERIES[name], ORACLES[name], SMOKE, con)
    assert rep["ok"], rep


def test_every_query_has_a_callable():
    assert len(QUERIES) == 99
    assert set(ORACLES) <= set(QUERIES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema] == ["date", "area_id", "area_name", "crimes", "violent",
                                           "arrests", "violent_ratio", "arrest_ratio"]
