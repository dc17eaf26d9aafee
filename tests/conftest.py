import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from cadenza.session import build_session
    session = build_session("tests", "8", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
