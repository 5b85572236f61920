import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from starflow.session import create, prepare  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = create("starflow-tests", master="local[8]",
                     spark__sql__shuffle__partitions="8",
                     spark__driver__memory="8g",
                     spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture
def many_parts(spark):
    """Keep small shuffles in all their partitions, as large ones would be."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, "true")
