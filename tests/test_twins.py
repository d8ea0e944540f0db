"""Every registered query against its SQL twin, all rows and columns."""

import pytest
from compare import check, connect
from conftest import SF

from __spark_entry__ import entry, oracle_sql, queries
from ledgerlake.plans.registry import QUERIES
from oracle_twins import TWINS


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_twin(spark, con, name):
    result = check(spark, con, name, SF)
    assert result["ok"], result
    assert result["twin"] and result["rows"] > 0


def test_every_twin_has_a_query():
    assert set(TWINS) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries()) and set(QUERIES) <= set(queries())


def test_entry(spark):
    rows = entry(spark).collect()
    assert [r.payment_method for r in rows] == [0, 1, 2]
    assert {r.gross_variance_usd for r in rows} == {"0.00"}
