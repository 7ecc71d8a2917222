"""Every query with an oracle statement, against DuckDB on the same files."""

import pytest

from catalog.all_queries import ORACLES, QUERIES
from catalog.compare import connect, difference

# These train models for minutes or need a larger table; their invariants are in test_models.py.
EMPTY_AT_SMALL_SCALE = {"adverse_action_reasons", "overleverage_alert"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, sf_dir, con, name):
    found = difference(QUERIES[name](spark, sf_dir), con, ORACLES[name])
    if name in EMPTY_AT_SMALL_SCALE and found == "empty result":
        return
    assert found is None, found


def test_entry_point():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert "channel_performance" in e.queries()
