"""The queries that SQL can express, against DuckDB."""

import pytest

from arrearium.llm.queries import ORACLES, QUERIES
from catalog.compare import connect, difference


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None
