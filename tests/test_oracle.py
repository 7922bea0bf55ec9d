import pytest

from starglean.plans.catalog import ORACLES, QUERIES
from tests import oracle


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, sf, con):
    difference = oracle.compare(QUERIES[name](spark, sf), con, ORACLES[name])
    assert difference is None, difference
