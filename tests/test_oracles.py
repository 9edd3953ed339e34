"""Every registered query against its SQL on the smallest data."""

import pytest

from checks.compare import connect, differences
from checks.oracles import ORACLES
from checks.runs import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert differences(spark, duck, SF, name) == ""
