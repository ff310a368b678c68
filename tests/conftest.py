import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

import plumbline as pl  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = pl.build_session("tests", cpus=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def points(spark):
    """Labelled points from ``(row_id, features, label)`` tuples."""

    def make(rows):
        return spark.createDataFrame(rows, "row_id long, features array<float>, label int")

    return make
