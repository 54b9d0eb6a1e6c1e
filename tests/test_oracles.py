"""Every registered query against its SQL on the smallest generated tables."""

import pytest

from checks import compare
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.oracle(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    _, problem = compare.differences(spark, duck, name, SF)
    assert not problem, problem
