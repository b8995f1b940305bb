import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
for folder in (HERE, os.path.join(HERE, "llm")):  # the latter may be absent
    sys.path.insert(0, folder)


@pytest.fixture(scope="session")
def spark():
    from cartloom.session import build_session, release

    session = build_session("tests", 8)
    yield session
    release(session)
    session.stop()
