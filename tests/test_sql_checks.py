"""Every registered query against its SQL check on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference
from tests.conftest import SF_DIR

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_check():
    """Only fitted, encoded and clustered results of the training-data operators have none."""
    free = set(entry.llm_queries.queries()) | {"pipeline"} if entry.llm_queries else set()
    assert set(ORACLES) <= set(entry.queries()) and set(entry.queries()) - free <= set(ORACLES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql(spark, con, key):
    assert difference(spark, con, SF_DIR, key, ORACLES[key]) in ("", "EMPTY")


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
