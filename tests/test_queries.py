"""Every query with an oracle against DuckDB, and the rest for their shape."""

import pytest

import __spark_entry__ as entry
from roadloom.plans import ORACLES, QUERIES

from .conftest import canonical


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, data, oracle, name):
    got = QUERIES[name](spark, data)
    found = oracle.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(got.columns) == sorted(columns)
    assert canonical(got.collect(), got.columns) == canonical(found.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, data, name):
    assert QUERIES[name](spark, data).count() >= 0


def test_entry(spark):
    assert entry.entry(spark).columns


def test_registry_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
