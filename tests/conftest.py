import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from textloom.session import build

    session = build("local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
