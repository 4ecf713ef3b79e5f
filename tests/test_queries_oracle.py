"""Every registered engine query against its SQL."""

import pytest

from lexivane.plans.oracle import ORACLE_SQL
from lexivane.plans.queries import QUERIES
from tests.oracle import connect, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLE_SQL:
        assert len(got) > 0
        return
    want = duck.sql(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)
