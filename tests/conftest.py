import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corpuslathe.runtime import ship  # noqa: E402
from corpuslathe.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("tests", master="local[4]", shuffle_partitions=4, spark__driver__memory="4g", spark__ui__showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()
