"""Every registered query against its SQL statement, values and types."""

import pytest

import __spark_entry__ as entry
from tarmac.plans import catalog, oracle
from tests.compare import differences, oracle_connection
from tests.conftest import SF_DIR

ORACLES = oracle.oracle_statements()
QUERIES = {name: query for name, query in entry.queries().items() if name in catalog.CATALOG}


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_every_query_has_an_oracle():
    # estimates of sketches are held against exact values in test_statistics
    assert set(QUERIES) - {"table_sketches"} == set(ORACLES) and set(QUERIES) == set(catalog.CATALOG)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_the_ten_airlines(spark):
    assert entry.entry(spark).count() == 10


MAY_BE_EMPTY = {
    # too few flights per group at this scale, or nothing to find in clean data
    "w3_delay_surge", "g3_airports_within", "g5_short_route_delay", "q2_duplicate_keys",
}


@pytest.mark.parametrize("name", sorted(set(ORACLES) - MAY_BE_EMPTY))
def test_oracle_result_is_not_empty(con, name):
    assert con.execute(f"SELECT count(*) FROM ({ORACLES[name]})").fetchone()[0] > 0
