"""Queries with a SQL form, against it."""

from __future__ import annotations

import pytest

from checks.compare import database, normalised
from tidewire.llm.oracles import ORACLES
from tidewire.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    found = QUERIES[name](spark, SF)
    twin = database(SF).execute(ORACLES[name])
    columns = [d[0] for d in twin.description]
    assert sorted(columns) == sorted(found.columns)
    assert normalised(found.columns, [tuple(r) for r in found.collect()]) == normalised(columns, twin.fetchall())
