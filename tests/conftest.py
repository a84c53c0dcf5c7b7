import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pulsegrid.session import local_session

    session = local_session("8")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Builds ``points`` from {series: [(t, y), ...]}."""
    def build(data):
        rows = [(s, float(t), None if y is None else float(y)) for s, pts in data.items() for t, y in pts]
        return spark.createDataFrame(rows, "series string, t double, y double")

    return build
