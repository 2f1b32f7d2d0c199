from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from caseload.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """The value of a column expression, over one row of named values."""
    from pyspark.sql import functions as F

    def evaluate(expression, **values):
        names = list(values) or ["unused"]
        types = {int: "BIGINT", float: "DOUBLE", str: "STRING", bool: "BOOLEAN"}
        schema = ", ".join(f"{n} {types.get(type(values.get(n)), 'DOUBLE')}" for n in names)
        row = [tuple(values.get(n) for n in names)]
        return spark.createDataFrame(row, schema).select(expression.alias("x")).first()["x"]

    return evaluate
