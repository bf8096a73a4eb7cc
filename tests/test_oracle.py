"""Every query that SQL can express, against an independent engine."""

import pytest

from tests.check_oracle import compare, connect
from wardenlake.plans.catalog import QUERIES
from wardenlake.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, con, name):
    rows, difference = compare(spark, con, SF, name)
    assert difference is None
    assert rows > 0


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
