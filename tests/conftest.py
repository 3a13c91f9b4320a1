import pytest

from kinmatch.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
