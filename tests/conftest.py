import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from placerank.session import get_spark

    session = get_spark(
        "tests", driver_memory="8g", spark__master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
