import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("STORYLOOM_DRIVER_MEMORY", "4g")


@pytest.fixture(scope="session")
def spark():
    from storyloom.session import get_spark

    s = get_spark(4, 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    return path
