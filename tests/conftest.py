import pytest

from candlewick.session import configure
from tests.parity import local_session


@pytest.fixture(scope="session")
def spark():
    session = configure(local_session(4))
    yield session
    session.stop()
