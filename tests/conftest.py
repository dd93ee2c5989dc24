import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark():
    from gridloom.session import session

    s = session("local[8]", 8, spark__ui__enabled="false", spark__driver__memory="6g", spark__ui__showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
