import datetime as dt

import pytest

from wayfare.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4)
    yield session
    session.stop()


@pytest.fixture
def ts():
    return dt.datetime.fromisoformat
