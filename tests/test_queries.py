"""Every registered query beside its SQL twin, on whole tables."""

import pytest

import __spark_entry__ as entry
from compare import difference, oracle
from distaff.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_twin(spark, con, name):
    assert difference(spark, con, SF, QUERIES[name]) is None


def test_contract():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.queries()) - set(QUERIES) == set(entry.LLM)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert [r.n for r in rows] == [795] * 4
