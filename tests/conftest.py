import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martwright.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        {
            "spark.master": "local[8]",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
