import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session

    session = build_session(
        "local[8]",
        "tests",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tidemark-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
