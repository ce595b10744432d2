import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quillsieve.session import build_session, ship_package


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", 4, "3g")
    ship_package(session)
    yield session
    session.stop()
