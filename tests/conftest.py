"""One session for all tests, with a shared folder of its own."""

import os
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (HERE, os.environ.get("PYTHONPATH", "")) if x)


@pytest.fixture(scope="session")
def spark():
    from docketflow.session import session

    s = session("tests", "8")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
