import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from lexflume.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def frame(spark):
    """Literal rows as a frame of several partitions."""

    def make(rows, schema, partitions=3):
        return spark.createDataFrame(rows, schema).repartition(partitions)

    return make
