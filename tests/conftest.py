import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from matchwright.session import build_session

    session = build_session(
        "tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("driver tables are not here")
    return path
