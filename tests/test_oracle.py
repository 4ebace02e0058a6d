"""Every registered query against its SQL, on whole tables."""

import compare
import pytest

import __spark_entry__ as entry
from skyledger.checks import oracles

SF = "/root/testdata/sf0.001"
# Too few rows at this scale for one origin's carrier-routes to qualify; checked at the next one.
DENSER = {"yoy_momentum": "/root/testdata/sf0.01"}


@pytest.fixture(scope="module")
def connections():
    return {sf: compare.connect(sf) for sf in {SF, *DENSER.values()}}


def test_names_match():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query(spark, connections, name):
    sf = DENSER.get(name, SF)
    assert compare.difference(spark, connections[sf], sf, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
