import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DATA = os.environ.get("SIGNALBOOK_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from signalbook.session import local_session

    session = local_session("tests", "8")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.01"
