"""Every registered query against its SQL on the smallest tables."""

import pytest

from catalog import ORACLES, QUERIES
from oracle_check import compare, duck

FOLDER = "/root/testdata/sf0.001"
# Too few events at this scale to repeat an hour with the same value.
MAY_BE_EMPTY = {"c05_duplicate_report"}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    problem = compare(spark, con, FOLDER, name, QUERIES[name], ORACLES.get(name))
    if name in MAY_BE_EMPTY and problem == "no rows":
        problem = None
    assert problem is None, problem


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
