import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerlens.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", master="local[8]", spark__sql__shuffle__partitions="4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of an expression over a single literal row."""

    def evaluate(make, value, kind="string"):
        return spark.createDataFrame([(value,)], f"v {kind}").select(make("v")).first()[0]

    return evaluate


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
