from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shopmart.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("checkpoint")
    session = get_session(
        "local[4]",
        "tests",
        shuffle_partitions=4,
        **{"spark.checkpoint.dir": str(shared), "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Build a DataFrame from rows and a schema string."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
