"""The queries that SQL can express, against their statements."""

import pytest

from tarmac.llm.queries import ORACLES, QUERIES
from tests.compare import differences, oracle_connection
from tests.conftest import SF_DIR


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), oracle_connection(SF_DIR), ORACLES[name]) is None


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert {"pipeline", *QUERIES} <= set(entry.queries())
