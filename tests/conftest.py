import pytest

from panelmill.session import get_session, shared_dir


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", 4)
    session.sparkContext.setLogLevel("ERROR")
    shared_dir(session)
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
