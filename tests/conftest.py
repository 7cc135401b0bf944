import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [os.path.dirname(HERE), os.environ.get("PYTHONPATH")]))  # for Python workers


@pytest.fixture(scope="session")
def spark():
    from memberlytics.session import build_session

    s = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g"
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
