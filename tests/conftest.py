import pytest

from tidemark.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
