"""Queries that SQL can say, against DuckDB on whole tables; the others at least as whole results."""

import pytest

from starglean.llm.queries import ORACLES, QUERIES
from tests import oracle


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, sf):
    difference = oracle.compare(QUERIES[name](spark, sf), oracle.connect(sf), ORACLES[name])
    assert difference is None, difference


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES
