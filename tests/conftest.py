import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session.build("local[8]", "tidewater-tests", spark__driver__memory="6g",
                      spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
