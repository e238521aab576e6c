import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from adit.session import build_session

    session = build_session(
        "tests", "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def docs(spark):
    """Documents from (file name, text) pairs."""

    def make(*pairs, incident="INC-1"):
        return spark.createDataFrame([(incident, n, t) for n, t in pairs], "incident_id string, source_file string, text string")

    return make
