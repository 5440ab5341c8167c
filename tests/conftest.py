import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ratelens.session import get_session

    s = get_session("tests", "local[8]", 8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
