from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidewire.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.default.parallelism": "2",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def rows(spark):
    """Frame from tuples and a DDL schema."""

    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return make


@pytest.fixture
def column(spark):
    """Values of one expression over text inputs, in input order."""

    def run(inputs, expression, data_type="string"):
        df = spark.createDataFrame(list(enumerate(inputs)), f"i int, x {data_type}")
        return [r.y for r in df.select("i", expression.alias("y")).orderBy("i").collect()]

    return run
