"""The driver contract: every query agrees with its SQL twin at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from checks.base import ORACLES, QUERIES
from checks.compare import database, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.keys() <= E.queries().keys() and set(E.oracle_sql()) <= set(E.queries())


def test_flagship(spark):
    assert E.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, SF, name) is None
