import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from lightloom.session import local_session

    session = local_session(4, "4g", 4)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    if not DATA.exists():
        pytest.skip("no test tables here")
    return str(DATA)
